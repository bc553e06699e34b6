"""Importance resampling towards a target corpus, with hashed features counted through a head-tail vocabulary.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; features are all runs of 1 to 3 consecutive words, joined by one space, repeats
counted. A feature's bucket is the CRC-32 of its UTF-8 bytes modulo ``BUCKETS``.

* Head. One pass over the texts counts words and pairs of words in summaries of bounded size (Misra-Gries: every word or pair that makes up
  more than 2 / ``SUMMARY`` of a task's is in its summary). Words with more than the ``HEAD_WORDS``-th part of all counts, and pairs with more than the
  ``HEAD_PAIRS``-th part, travel to the tasks with their exact CRC states. There can be no more of them than these fixed numbers, and head words have at most
  ``HEAD_BYTES`` bytes, so what comes to the driver has at most ``HEAD_WORDS`` * ``HEAD_BYTES`` + ``HEAD_PAIRS`` * (2 * ``HEAD_BYTES`` + 1) bytes (12.6 MB),
  and what is broadcast ``HEAD_WORDS`` * (``HEAD_BYTES`` + 16) + ``SLOTS`` * 12 (8.4 MB), at any size of the corpus.
* Tail. Any other word takes its CRC directly. A feature that is not in the head takes it from the state of its beginning: the CRC of
  ``a b`` follows from the CRC of ``a``, that of `` b`` and the length of b, as CRC-32 is linear; words longer than ``LONG`` bytes run through it byte by byte.

Both give the same exact CRC, so the head only saves time, and results do not depend on what is in it. Bucket totals are summed over all texts, ``BUCKETS``
numbers for each corpus. A bucket's gain is the logarithm of its smoothed share in the target over its smoothed share in the corpus, in
thousandths, rounded down; a document's weight is the sum of its features' gains. Gumbel noise, keyed by the identifier, makes the largest scores a
draw without replacement in proportion to exp(weight / 1000).

Defined results: null and wordless texts have no features and weight 0; rows without identifier get a weight but no score and are never drawn; rows
with equal identifiers are documents of their own, of which the one of larger weight ranks first; an empty target or corpus has totals of
zero, which smoothing covers. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import blocks, mix, prepare, texts, unused
from lakestrata.llm.decontam import FOLD
from lakestrata.operators.keys import number_rows
from lakestrata.session import materialize

BUCKETS = 10_000
HEAD_WORDS, HEAD_PAIRS = 1 << 16, 1 << 16
HEAD_BYTES = 64
SUMMARY = 1 << 16      # entries that a task's summary keeps
LONG = 255             # bytes of a word up to which CRC states are joined by table
SLOTS = 1 << 18        # of the pair table
MIN_WORDS, PERCENT, SEED = 20, 5, 42


def _zero_bytes(states: np.ndarray) -> np.ndarray:
    """CRC states (without the final inversion) after one zero byte more."""
    for _ in range(8):
        states = np.where(states & np.uint32(1), (states >> np.uint32(1)) ^ np.uint32(0xEDB88320), states >> np.uint32(1))
    return states


def _shift_tables() -> np.ndarray:
    """[n, k, byte]: what byte k of a state becomes after n zero bytes."""
    now = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
    out = [now]
    for _ in range(LONG + 1):
        now = _zero_bytes(now)
        out.append(now)
    return np.stack(out)


SHIFT = _shift_tables()


def joined(states: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC of each text with state ``states`` followed by one with CRC ``ends`` and that many bytes (``LONG`` + 1 at most)."""
    low = np.uint32(0xFF)
    out = ends ^ SHIFT[lengths, 0, states & low]
    for k in range(1, 4):
        out = out ^ SHIFT[lengths, k, states >> np.uint32(8 * k) & low]
    return out


class Head:
    """Frequent words with their CRC states, and a table of frequent pairs of them."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]]):
        self.words = words
        self.number = {w: k for k, w in enumerate(words)}
        self.crc = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.spaced = np.array([zlib.crc32(b" " + w) for w in words], np.uint32)
        self.size = np.array([len(w) for w in words], np.int64)
        self.key, self.state = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, np.uint32)
        able = [(a, b) for a, b in reversed(pairs) if a in self.number and b in self.number]
        keys = np.array([self.number[a] * HEAD_WORDS + self.number[b] for a, b in able], np.int64)
        slots = self.slot(keys)  # of pairs that share a slot the most frequent comes last and stays; the others count as tail
        self.key[slots] = keys
        self.state[slots] = np.array([zlib.crc32(a + b" " + b) for a, b in able], np.uint32)

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return mix(keys.view(np.uint64)) & np.uint64(SLOTS - 1)

    def crcs(self, words: list[bytes], number: np.ndarray, owner: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """CRC of every word, pair and triple, each with the document it belongs to. ``number`` are places in ``words``, ``owner`` rises."""
        tail: list[bytes] = []
        known, n = self.number, len(self.words)
        place = np.empty(len(words), np.int64)
        for k, w in enumerate(words):
            if (at := known.get(w)) is None:
                at = n + len(tail)
                tail.append(w)
            place[k] = at
        crc = np.concatenate([self.crc, np.fromiter(map(zlib.crc32, tail), np.uint32, len(tail))])[place]
        spaced = np.concatenate([self.spaced, np.fromiter((zlib.crc32(b" " + w) for w in tail), np.uint32, len(tail))])[place]
        size = np.concatenate([self.size, np.fromiter(map(len, tail), np.int64, len(tail))])[place]

        def longer(states, at):
            """The CRC of a feature that goes on with the word at each of the places."""
            own = number[at]
            length = size[own]
            out = joined(states, spaced[own], np.minimum(length, LONG) + 1)
            for k in np.flatnonzero(length > LONG):
                out[k] = zlib.crc32(b" " + words[own[k]], int(states[k]))
            return out

        one = crc[number]
        second = np.flatnonzero(owner[1:] == owner[:-1]) + 1
        a, b = place[number[second - 1]], place[number[second]]
        two = np.zeros(len(number), np.uint32)  # by the place of the last word
        key = a * HEAD_WORDS + b
        slot = self.slot(key)
        frequent = (a < n) & (b < n) & (self.key[slot] == key)
        two[second[frequent]] = self.state[slot[frequent]]
        rare = second[~frequent]
        two[rare] = longer(one[rare - 1], rare)
        third = second[1:][second[1:] == second[:-1] + 1]
        return [(one, owner), (two[second], owner[second]), (longer(two[third - 1], third), owner[third])]


def _narrow(docs: DataFrame, text_col: str, id_col: str | None = None) -> DataFrame:
    text = F.col(text_col).cast("binary").alias("text")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text) if id_col else docs.select(text)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], np.ndarray, np.ndarray]]:
    """Blocks of rows with their distinct words, the number of each word in turn, and the row it is in. Arrow splits and numbers the words."""
    for batch in (b for part in batches for b in blocks([part], "text", 4 << 20)):
        folded = pa.array([t.translate(FOLD).strip() for t in texts(batch, "text")], pa.binary())
        lists = pc.ascii_split_whitespace(folded.view(pa.string()))
        flat = lists.flatten()
        owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        is_word = pc.binary_length(flat).to_numpy() > 0  # a text without words splits into one empty part
        coded = flat.dictionary_encode()
        words = coded.dictionary.view(pa.binary()).to_pylist()
        yield batch, words, coded.indices.to_numpy().astype(np.int64)[is_word], owner[is_word]


def trimmed(counts: Counter, size: int) -> Counter:
    """The summary with at most ``size`` entries: what the next entry has is taken from all (Misra-Gries)."""
    if len(counts) <= size:
        return counts
    less = np.partition(np.fromiter(counts.values(), np.int64, len(counts)), len(counts) - size - 1)[len(counts) - size - 1]
    return Counter({k: n - int(less) for k, n in counts.items() if n > less})


def summaries(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``feature, n``: each task's summary of its words (without a space) and pairs of words (with one).

    What makes up no more than 1 / ``SUMMARY`` of a block is left out of the block's counts, and a summary that grows over twice its size is trimmed. Each
    takes at most the ``SUMMARY``-th part of all from a count.
    """
    def run(batches):
        held = [Counter(), Counter()]
        for _, words, number, owner in _tokens(batches):
            times = np.bincount(number, minlength=len(words))
            size = np.fromiter(map(len, words), np.int64, len(words))
            often = (times * SUMMARY > len(number)) & (size <= HEAD_BYTES) & (size > 0)  # a pair is no more frequent than its words
            at = np.flatnonzero(often)
            for k, n in zip(at.tolist(), times[at].tolist()):
                held[0][words[k]] += n
            both = (owner[1:] == owner[:-1]) & often[number[1:]] & often[number[:-1]]
            pairs, n = np.unique(number[:-1][both] * len(words) + number[1:][both], return_counts=True)
            keep = n * SUMMARY > len(number)
            for p, k in zip(pairs[keep].tolist(), n[keep].tolist()):
                held[1][words[p // len(words)] + b" " + words[p % len(words)]] += k
            held = [trimmed(c, SUMMARY) if len(c) > 2 * SUMMARY else c for c in held]
        for c in held:
            found = list(trimmed(c, SUMMARY).items())
            for at in range(0, len(found), 1 << 14):
                names, counts = zip(*found[at:at + (1 << 14)])
                yield pa.record_batch({"feature": pa.array(names, pa.binary()), "n": pa.array(counts, pa.int64())})

    return _narrow(docs, text_col).mapInArrow(run, "feature binary, n long")


def frequent_head(docs: DataFrame, text_col: str = "text") -> Head:
    """The head of all texts: words with more than 1 / ``HEAD_WORDS`` of the counts of all words, so fewer than ``HEAD_WORDS``, and pairs likewise."""
    sums = materialize(summaries(docs, text_col).groupBy("feature").agg(F.sum("n").alias("n")).withColumn(
        "is_pair", F.instr(F.col("feature").cast("string"), " ") > 0), "resample-head")
    total = {r["is_pair"]: r["n"] for r in sums.groupBy("is_pair").agg(F.sum("n").alias("n")).collect()}
    most = {False: HEAD_WORDS, True: HEAD_PAIRS}

    def frequent(kind: bool) -> list[bytes]:
        rows = sums.where((F.col("is_pair") == kind) & (F.col("n") * most[kind] > total.get(kind, 0))).select("n", "feature").collect()
        return [bytes(r["feature"]) for r in sorted(rows, key=lambda r: (-r["n"], bytes(r["feature"])))]
    return Head(frequent(False), [tuple(p.split(b" ")) for p in frequent(True)])


def bucket_totals(docs: DataFrame, head, text_col: str = "text") -> DataFrame:
    """``bucket, n``: features of all texts in each bucket. ``head`` is a broadcast ``Head``."""
    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for _, *tokens in _tokens(batches):
            for crc, _ in head.value.crcs(*tokens):
                total += np.bincount(crc % np.uint32(BUCKETS), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(at, pa.int64()), "n": pa.array(total[at])})

    return _narrow(docs, text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the logarithm of the smoothed share in the target over that in the corpus, rounded down."""
    t_all, s_all = float(target.sum()), float(corpus.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + BUCKETS) / ((s + 1.0) * (t_all + BUCKETS))))
                     for t, s in zip(target.tolist(), corpus.tolist())], np.int64)


def noise(doc_id: int, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, head, gain, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row; ``head`` and ``gain`` are broadcast."""
    def run(batches):
        for batch, words, number, owner in _tokens(batches):
            rows = batch.num_rows
            weight, features = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            for crc, own in head.value.crcs(words, number, owner):
                if len(own):
                    start = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1))
                    weight[own[start]] += np.add.reduceat(gain.value[crc % np.uint32(BUCKETS)], start)
                    features += np.bincount(own, minlength=rows)
            score = [None if i is None else int(w) + noise(i, seed) for i, w in zip(batch.column("doc_id").to_pylist(), weight)]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(np.bincount(owner, minlength=rows).astype(np.int64)),
                "n_features": pa.array(features), "weight": pa.array(weight), "score": pa.array(score, pa.int64())})

    return _narrow(docs, text_col, id_col).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def importance(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
               min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """One row per input row: ``doc_id, n_features, weight, score, rank``.

    Of the N rows with an identifier and ``min_words`` words or more, the floor(``percent`` * N / 100) largest scores are drawn and ranked from 1,
    ties by the smaller identifier; other rows have no rank. Counts, and writes its work tables, while building.
    """
    spark = prepare(docs.sparkSession)
    context = spark.sparkContext
    head = context.broadcast(frequent_head(docs, text_col))

    def totals(df, column):
        out = np.zeros(BUCKETS, np.int64)
        for bucket, n in bucket_totals(df, head, column).collect():  # BUCKETS rows at most
            out[bucket] = n
        return out
    gain = context.broadcast(gains(totals(target, target_text), totals(docs, text_col)))
    scored = materialize(weigh(docs, head, gain, id_col, text_col, seed), "resample-scores")
    able = scored.where((F.col("n_words") >= min_words) & F.col("doc_id").isNotNull())
    drawn = able.count() * percent // 100
    order = able.select("doc_id", "n_features", "weight", "score", (-F.col("score")).alias("worst"), (-F.col("weight")).alias("lightest"))
    ranked = (number_rows(order, "rank", ["worst", "doc_id", "lightest", "n_features"])
              .select("doc_id", "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")))
    rest = scored.where((F.col("n_words") < min_words) | F.col("doc_id").isNull())
    return ranked.union(rest.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The drawn documents with their own columns; rows that share a drawn identifier come together."""
    own, stays = unused(docs, "own_id"), unused(docs, "stays")
    drawn = importance(docs, target, id_col, text_col, **options).where("rank is not null").select(F.col("doc_id").alias(stays)).distinct()
    return docs.withColumn(own, F.col(id_col).cast("bigint")).join(drawn, F.col(own) == F.col(stays), "left_semi").select(*docs.columns)
