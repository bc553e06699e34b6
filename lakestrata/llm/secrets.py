"""Secret scan: fixed patterns, and strings that a token vocabulary spells badly.

Text that people write splits into few tokens of a public vocabulary; random strings need about one token for every two
characters. A run of key characters that holds a digit and a letter is reported as ``random`` if it has fewer than ``ratio``
characters a token, unless it is a known digest, lies in a base match, or more than half of its letters and digits are in words of
three letters or more that the vocabulary has as one token.

Base kinds, leftmost and non-overlapping for each: ``assign`` (a named assignment whose value has 6 characters or more),
``access`` (``AKIA`` keys of 20 or more), ``hex`` (24 or more). Spans are code points, end exclusive.

Defined results: bytes that are no UTF-8 count as U+FFFD; null or empty text has no spans; every row is scanned for itself, so repeated rows and identifiers need no rule;
other columns do not matter. The vocabulary file is a parameter that every node has.
"""

from __future__ import annotations

import base64
import hashlib
import re

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import blocks, prepare, strings

# Kinds in the order of reports, names that announce a secret, the patterns of the base kinds.
KINDS = ("assign", "access", "hex", "random")
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

RUN = re.compile("[A-Za-z0-9+/_=-]{20,}")
# Not secrets: digests of usual lengths, UUIDs.
DIGEST = re.compile("(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}"
                    "|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})")
# The parts of a name, as separators, changes of case and digits divide it; found one after the other, in linear time.
PART = re.compile("[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
WORD = re.compile(rb"\x20[A-Za-z]{3,}")
MIXED = re.compile("(?=.*[0-9])(?=.*[A-Za-z])")

RATIO = 2.2
REMEMBER = 100_000


class Vocabulary:
    """Counts the tokens of a string; remembers the strings counted lately. ``words`` are the tokens that are a whole word, in lower case."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.words = {token[1:].decode().lower() for token in ranks if WORD.fullmatch(token)}
        self.known: dict[str, float] = {}

    def chars_per_token(self, run: str) -> float:
        got = self.known.get(run)
        if got is None:
            if len(self.known) >= REMEMBER:
                self.known.clear()
            got = self.known[run] = len(run) / len(self.encoding.encode_ordinary(run))
        return got


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def is_identifier(run: str, words: set[str]) -> bool:
    """Mostly known words: more than half of the letters and digits."""
    parts = PART.findall(run)
    return 2 * sum(len(p) for p in parts if p.lower() in words) > sum(map(len, parts))


def base_spans(text: str, runs: list[re.Match]) -> list[tuple[int, int, int, str]]:
    """(start, place of the kind, end, value) of the base matches."""
    out = []
    low = text.lower()
    if any(name in low for name in NAMES):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for run in runs:  # access and hex matches are whole runs of some of these characters, so they lie within one
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text, run.start(), run.end()) if m.end() - m.start() >= LEAST["access"]]
        out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text, run.start(), run.end()) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(out)


def find(text: str, known: Vocabulary, ratio: float = RATIO) -> tuple[list, list]:
    """Base spans, and all spans with those of random strings."""
    runs = list(RUN.finditer(text))
    base = base_spans(text, runs)
    extra = []
    for run in runs:
        value = run[0].strip("=-_/+")
        start = run.start() + run[0].find(value)
        end = start + len(value)
        if (len(value) >= 20 and MIXED.match(value) and not DIGEST.fullmatch(value)
                and known.chars_per_token(value) < ratio and not is_identifier(value, known.words) and not any(a < end and start < b for a, _, b, _ in base)):
            extra.append((start, 3, end, value))
    return base, sorted(base + extra)


def joined(spans: list) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, _ in spans)


def scan(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", ratio: float = RATIO,
         values: bool = False) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` and, if asked for, the matched ``values``."""
    prepare(docs.sparkSession)
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        known = vocabulary(path)
        for batch in (b for part in batches for b in blocks([part], "text")):
            rows = [find(t, known, ratio) if t else ([], []) for t in strings(batch, "text")]
            counts = {f"n_{kind}": pa.array([sum(s[1] == k for s in every) for _, every in rows], pa.int64()) for k, kind in enumerate(KINDS)}
            columns = {"doc_id": batch.column("doc_id"), **counts,
                       "base_sha256": pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows], pa.string()),
                       "spans": pa.array([joined(every) for _, every in rows], pa.string())}
            if values:
                columns["values"] = pa.array([[s[3] for s in every] for _, every in rows], pa.list_(pa.string()))
            yield pa.record_batch(columns)

    schema = (f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, " + "".join(f"n_{k} long, " for k in KINDS)
              + "base_sha256 string, spans string")
    return narrow.mapInArrow(run, schema + (", values array<string>" if values else ""))
