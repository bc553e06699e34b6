"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a word there is exactly one token that its encoding ends with. An automaton of the
vocabulary yields all tokens that end at a place; the one whose seam with the last token of the prefix
before it survives all merges is stored, and the ids follow from the stored back-pointers. No merge is
ever simulated on a text.

The tokenizer file is a parameter and is read by each worker; every Spark node has it, as it has Python.
A worker remembers the words it encoded lately,
and chunks between spaces (twice ``Tokenizer.REMEMBER`` of each at most).

Defined results: bytes that are no UTF-8 count as U+FFFD; null and empty texts have no ids and decode to the empty text. Special tokens of the file that stand
in a text are their own ids. A symbol that the vocabulary lacks raises an error, as no file with a full byte
alphabet has one. Rows pass through one by one, so repeated rows and identifiers need no rule.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from lakestrata.llm.common import blocks, prepare, strings

# How the file's pre-tokenizer cuts a chunk between white space: for ASCII, up to U+024F, and for any text. The last goes to the library's
# own normalizer and cutter, as which characters are letters, numbers or cased depends on the Unicode version.
SUFFIX = "'s|'t|'re|'ve|'m|'ll|'d"
CUT_ASCII = re.compile(SUFFIX + "|[a-z]+|[0-9]|[^a-z0-9]+")
LATIN, LATIN_DIGIT = "a-z\\u00aa\\u00b5\\u00ba\\u00df-\\u00f6\\u00f8-\\u024f", "0-9\\u00b2\\u00b3\\u00b9\\u00bc-\\u00be"
CUT_LATIN = re.compile(f"{SUFFIX}|[{LATIN}]+|[{LATIN_DIGIT}]|[^{LATIN}{LATIN_DIGIT}]+")
NORMAL = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
CUT_ANY = pre_tokenizers.Split(Regex(SUFFIX + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), "removed", invert=True)
BEYOND_LATIN = re.compile("[^\\x00-\\u024f]")
# Python also splits at four control characters that are not white space to the file's normalizer.
CONTROL = re.compile("[\x1c-\x1f]")
SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")


def byte_alphabet() -> list[str]:
    """The printable letter that stands for each byte: itself if visible, else the next from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in visible}
    hidden = [b for b in range(256) if b not in letters]
    letters |= {b: chr(0x100 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Tokenizer:
    """A word-level BPE file: lower case, white space dropped, the last symbol of a word marked."""

    REMEMBER = 100_000  # new words, and as many before them; words in use move to the new ones
    SEAMS = 300_000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model.get("byte_fallback") or not model.get("end_of_word_suffix") or model.get("dropout"):
            raise ValueError("only files of whole words with an end mark are supported")
        self.end = model["end_of_word_suffix"]
        self.names = {i: name for name, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: name for name, i in self.special.items()}
        self.at_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # Inside, a word is a string of one letter per symbol: byte b is chr(b), the last byte chr(256 + b).
        letters = {letter: b for b, letter in enumerate(byte_alphabet())}
        inner = {}
        for name, i in model["vocab"].items():
            body = name.removesuffix(self.end)
            if body and all(c in letters for c in body):
                codes = [letters[c] for c in body]
                if name.endswith(self.end):
                    codes[-1] += 256
                inner["".join(map(chr, codes))] = i
        self.born: dict[int, int] = {}                 # rank of the merge that makes a token
        self.halves: dict[int, tuple[int, int]] = {}   # and what it merges
        self.rank: dict[tuple[int, int], int] = {}
        for k, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pair = model["vocab"][a], model["vocab"][b]
            whole = model["vocab"][a + b]
            self.rank[pair], self.born[whole], self.halves[whole] = k, k, pair
        self.fits: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for text, i in inner.items():
            if i not in self.halves or self.seam_holds(*self.halves[i], self.born[i]):
                self.automaton.add_word(text, (len(text), i))
        self.automaton.make_automaton()
        self.words: dict[str, tuple[bytes, int, str]] = {}
        self.chunks: dict[str, tuple[bytes, int, str]] = {}
        self.old_words, self.old_chunks = self.words, self.chunks

    def seam_holds(self, left: int, right: int, before: int | None = None) -> bool:
        """Whether no merge ever crosses the seam of two tokens that stand side by side (with rank under ``before``).

        Undoes the merges of both in reverse. The symbols at the seam exist together until the next undone
        merge consumes one of them; their own merge must not come earlier. Equal ranks go from left to right.
        """
        limit = before if before is not None else len(self.born) + 1
        while True:
            own = self.rank.get((left, right))
            if own is not None and own < limit:
                return False
            a, b = self.born.get(left, -1), self.born.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, self.halves[left][1]
            else:
                limit, right = b + 1, self.halves[right][0]

    def word(self, word: str) -> tuple[bytes, int, str]:
        """Ids of one word as little-endian 32-bit numbers, how many, and its decoded text."""
        if len(self.words) >= self.REMEMBER:
            self.old_words, self.words = self.words, {}
        got = self.old_words.get(word) or self.spelled(word)
        self.words[word] = got
        return got

    def spelled(self, word: str) -> tuple[bytes, int, str]:
        """The same, found by filling in the last token of every prefix."""
        raw = word.encode("utf-8")
        text = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
        n = len(text)
        last: list[int] = [-1] * (n + 1)   # the last token of each prefix
        back = [0] * (n + 1)               # and where it starts
        fits = self.fits
        for end, (size, token) in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                before = last[start]
                if before < 0:
                    continue
                key = before << 32 | token
                ok = fits.get(key)
                if ok is None:
                    if len(fits) >= self.SEAMS:
                        fits.clear()
                    ok = fits[key] = self.seam_holds(before, token)
                if not ok:
                    continue
            last[end], back[end] = token, start
        ids = []
        while n:
            if last[n] < 0:
                raise ValueError(f"the vocabulary cannot spell {word!r}")
            ids.append(last[n])
            n = back[n]
        ids.reverse()
        return np.array(ids, "<u4").tobytes(), len(ids), " ".join([self.names[i] for i in ids])

    def cut(self, chunk: str) -> list[str]:
        """Words of a chunk without white space, after normalization."""
        if chunk.isascii():
            return CUT_ASCII.findall(chunk.lower())
        latin = unicodedata.normalize("NFC", chunk).lower()
        if BEYOND_LATIN.search(chunk) or BEYOND_LATIN.search(latin):
            return [word for word, _ in CUT_ANY.pre_tokenize_str(NORMAL.normalize_str(chunk))]
        return CUT_LATIN.findall(latin)

    def chunk(self, chunk: str) -> tuple[bytes, int, str]:
        """The same for a chunk between white space, which is what most texts repeat."""
        if len(self.chunks) >= self.REMEMBER:
            self.old_chunks, self.chunks = self.chunks, {}
        got = self.chunks.get(chunk) or self.old_chunks.get(chunk)
        if got is None:
            parts = [self.words.get(w) or self.word(w) for w in self.cut(chunk)]
            got = parts[0] if len(parts) == 1 else (b"".join([p[0] for p in parts]), sum([p[1] for p in parts]), " ".join([p[2] for p in parts]))
        self.chunks[chunk] = got
        return got

    def plain(self, text: str) -> list[tuple[bytes, int, str]]:
        known = self.chunks
        split = [c for c in SPACE.split(text) if c] if CONTROL.search(text) else text.split()
        return [known.get(c) or self.chunk(c) for c in split]

    def pieces(self, text: str) -> list[tuple[bytes, int, str]]:
        """Ids, their number and decoded text of each chunk and special token, in order."""
        if not self.at_special or not self.at_special.search(text):
            return self.plain(text)
        out, done = [], 0
        for m in self.at_special.finditer(text):
            out += self.plain(text[done:m.start()])
            out.append((np.array([self.special[m[0]]], "<u4").tobytes(), 1, m[0]))
            done = m.end()
        return out + self.plain(text[done:])

    def decode(self, ids) -> str:
        return " ".join([self.names[int(i)] for i in ids])


_loaded: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, read once in a worker."""
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids``. The digests are of the ids as
    little-endian 32-bit numbers and of their decoded text."""
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        bpe = tokenizer(path)
        for batch in (b for part in batches for b in blocks([part], "text")):
            packed, counts, decoded = [], [], []
            for text in strings(batch, "text"):
                got = bpe.pieces(text) if text else []
                packed.append(b"".join([g[0] for g in got]))
                counts.append(sum([g[1] for g in got]))
                decoded.append(hashlib.sha256(" ".join([g[2] for g in got]).encode("utf-8")).hexdigest())
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                       "ids_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                       "decoded_sha256": pa.array(decoded, pa.string())}
            if ids:
                flat = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.record_batch(columns)

    schema = f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return narrow.mapInArrow(run, schema + (", ids array<int>" if ids else ""))


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids; null ids decode to the empty text."""
    prepare(encoded.sparkSession)
    fields = [f for f in encoded.schema.fields if f.name != text_col]
    schema = T.StructType([*fields, T.StructField(text_col, T.StringType())])
    rest = [c for c in encoded.columns if c != text_col]

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = pa.array([bpe.decode(x or ()) for x in batch.column(ids_col).to_pylist()], pa.string())
            columns = {c: batch.column(c) for c in rest}
            yield pa.record_batch({f.name: texts if f.name == text_col else columns[f.name] for f in schema.fields})

    return encoded.mapInArrow(run, schema)
