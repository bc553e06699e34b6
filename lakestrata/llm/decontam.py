"""Benchmark decontamination by suffix arrays over the training text.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window is ``window`` consecutive
words of an item (all words of a shorter one). Each block of documents is a shard: its words become
numbers of the benchmark's vocabulary, stretches of known words too short to hold a window are left
out (no window can start there), and the rest gets a suffix array by prefix doubling. Every suffix of
every item is binary-searched in it. The range that shares its window gives all places of the window,
the neighbours in the array give the longest verbatim match of the suffix and where it is.

The benchmark travels to the tasks, so its size is checked: beyond ``BLOCK_WORDS`` words it is searched
block by block, and the found word ranges of a document are united.

Defined results: null or wordless documents have no hits; items without text or words are ignored; an item without
identifier hits words like any other, but has no name to be counted or listed by; rows with equal identifiers are scanned each for itself; a
repeated item counts once.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import UPPER, blocks, prepare, texts

WINDOW = 10
BLOCK_WORDS = 2_000_000  # benchmark words that travel to a task at once: about 100 MB there

# Bytes of a text after lower-casing; separators become spaces. UTF-8 bytes of other letters stay.
FOLD = bytes(ord(chr(b).lower()) if chr(b) in UPPER else b if b > 0x7F or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
             for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Needles:
    """The words of benchmark items as numbers from 1, one row per suffix that starts a window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.items = [name for name, _ in items]
        known, first, item, width, left = self.vocabulary, [], [], [], []
        numbers: list[int] = []
        for k, (_, words) in enumerate(items):
            w = min(window, len(words))
            for i in range(len(words) - w + 1):
                first.append(len(numbers) + i)
                item.append(k)
                width.append(w)
                left.append(len(words) - i)
            numbers.extend(known.setdefault(x, len(known) + 1) for x in words)
        self.numbers = np.array(numbers, np.int32)
        self.first, self.item, self.width, self.left = (np.array(x, np.int64) for x in (first, item, width, left))
        self.shortest, self.longest = (int(self.width.min()), int(self.left.max())) if len(first) else (1, 1)


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Start places ordered by what follows, exact for the first ``depth`` words, by prefix doubling."""
    rank, n = words.astype(np.int64), len(words)
    done = 1
    order = np.argsort(rank, kind="stable")
    while done < depth:
        after = np.zeros(n, np.int64)
        after[: max(0, n - done)] = rank[done:] + 1
        key = rank * (int(after.max(initial=0)) + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
        done *= 2
        if n and rank[order[-1]] == n - 1:
            break
    return order


def compare(shard: np.ndarray, at: np.ndarray, needle: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign of (shard suffix - needle suffix) over ``size`` words, and the number of leading words they share."""
    sign, shared, open_ = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), np.arange(len(at))
    for step in range(int(size.max(initial=0))):
        open_ = open_[size[open_] > step]
        if not len(open_):
            break
        place = at[open_] + step
        a = np.where(place < len(shard), shard[np.minimum(place, len(shard) - 1)], -1)
        b = needle[first[open_] + step]
        sign[open_] = np.sign(a.astype(np.int64) - b)
        same = a == b
        open_ = open_[same]
        shared[open_] += 1
    return sign, shared


def bound(shard, order, needles: Needles, which: np.ndarray, size: np.ndarray, past: bool) -> np.ndarray:
    """Binary search of all suffixes ``which`` at once: the first place not below them, or with ``past`` above them."""
    low, high = np.zeros(len(which), np.int64), np.full(len(which), len(order), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) // 2
        sign, _ = compare(shard, order[mid], needles.numbers, needles.first[which[open_]], size[open_])
        right = sign <= 0 if past else sign < 0
        low[open_[right]] = mid[right] + 1
        high[open_[~right]] = mid[~right]


def scan(documents: list[bytes], needles: Needles) -> tuple[list[int], dict[int, dict]]:
    """Number of words of each document, and for those with hits: word ranges, items, longest match and its place."""
    counts, parts = [], []
    get = needles.vocabulary.get
    for text in documents:
        words = words_of(text)
        counts.append(len(words))
        parts.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
        parts.append(np.zeros(1, np.int32))
    found: dict[int, dict] = {}
    if not len(needles.first):
        return counts, found
    whole = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    known = whole > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
    begins, ends = edges[::2], edges[1::2]
    long = ends - begins >= needles.shortest
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return counts, found
    lengths = ends - begins + 1  # with one 0 after each stretch
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    places = np.arange(lengths.sum()) - np.repeat(starts - begins, lengths)
    shard = whole[np.minimum(places, len(whole) - 1)]
    shard[starts + lengths - 1] = 0
    order = suffix_array(shard, needles.longest)

    every = np.arange(len(needles.first))
    low = bound(shard, order, needles, every, needles.width, past=False)
    high = bound(shard, order, needles, every, needles.width, past=True)
    hit = np.flatnonzero(high > low)
    if not len(hit):
        return counts, found
    offsets = np.concatenate(([0], np.cumsum(np.array(counts) + 1)))
    near = bound(shard, order, needles, hit, needles.left[hit], past=False)
    best, where = np.zeros(len(hit), np.int64), np.zeros(len(hit), np.int64)
    for neighbour in (near - 1, near):
        ok = (neighbour >= 0) & (neighbour < len(order))
        at = order[np.clip(neighbour, 0, len(order) - 1)]
        _, shared = compare(shard, at, needles.numbers, needles.first[hit], np.where(ok, needles.left[hit], 0))
        better = shared > best
        best[better], where[better] = shared[better], at[better]
    for k, suffix in enumerate(hit):
        spots = places[order[low[suffix]:high[suffix]]]
        width, item = int(needles.width[suffix]), int(needles.item[suffix])
        owners = np.searchsorted(offsets, spots, side="right") - 1
        for spot, owner in zip((spots - offsets[owners]).tolist(), owners.tolist()):
            got = found.setdefault(owner, {"ranges": set(), "items": set(), "longest": 0, "at": -1})
            got["ranges"].add((spot, spot + width))
            got["items"].add(item)
        owner = int(np.searchsorted(offsets, places[where[k]], side="right") - 1)
        got, start = found[owner], int(places[where[k]] - offsets[owner])
        if (best[k], -start) > (got["longest"], -got["at"]):
            got["longest"], got["at"] = int(best[k]), start
    return counts, found


def covered(ranges) -> int:
    total, end = 0, 0
    for a, b in sorted(ranges):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def needle_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> list[Needles]:
    """The benchmark in blocks of bounded size, read one partition at a time."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))
    out, held, size, seen = [], [], 0, set()
    for item, text in rows.where("text is not null").distinct().orderBy("item", "text").toLocalIterator():
        words = words_of(bytes(text))
        if words and (item, tuple(words)) not in seen:
            seen.add((item, tuple(words)))
            if held and size + len(words) > BLOCK_WORDS:
                out.append(Needles(held, window))
                held, size, seen = [], 0, set()
            held.append((item, words))
            size += len(words)
    return [*out, Needles(held, window)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match, longest_start``.

    ``longest_match`` is the longest verbatim match that ends the search of some suffix in this document; of a
    suffix that matches equally long in several documents of a block, one of them has it. 0 and -1 without a hit.
    """
    spark = prepare(docs.sparkSession)
    sets = needle_blocks(benchmark, item_col, item_text_col, window)
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    if len(sets) == 1:
        sent = spark.sparkContext.broadcast(sets[0])

        def report(batches):
            for batch in (b for part in batches for b in blocks([part], "text")):
                counts, found = scan(texts(batch, "text"), sent.value)
                none = {"ranges": (), "items": (), "longest": 0, "at": -1}
                rows = [found.get(i, none) for i in range(len(counts))]
                hits = [covered(r["ranges"]) for r in rows]
                names = [sorted({sent.value.items[k] for k in r["items"]} - {None}) for r in rows]
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id"), "n_words": pa.array(counts, pa.int64()),
                    "n_hit": pa.array(hits, pa.int64()), "n_items": pa.array(map(len, names), pa.int64()),
                    "items_sha256": pa.array([hashlib.sha256(",".join(n).encode()).hexdigest() for n in names], pa.string()),
                    "contaminated": pa.array([h > 0 for h in hits], pa.bool_()),
                    "longest_match": pa.array([r["longest"] for r in rows], pa.int64()),
                    "longest_start": pa.array([r["at"] for r in rows], pa.int64())})

        return narrow.mapInArrow(report, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
                                         "contaminated boolean, longest_match long, longest_start long")
    return united(narrow, sets)


def united(narrow: DataFrame, sets: list[Needles]) -> DataFrame:
    """Search a benchmark of several blocks and unite the word ranges of each row."""
    spark = narrow.sparkSession
    schema = "row long, doc_id long, n_words long, ranges array<array<long>>, items array<string>, longest long, at long"
    numbered = narrow.withColumn("row", F.xxhash64("doc_id", "text"))
    found = None
    for needles in sets:
        sent = spark.sparkContext.broadcast(needles)

        def spans(batches, sent=sent):
            for batch in (b for part in batches for b in blocks([part], "text")):
                counts, hits = scan(texts(batch, "text"), sent.value)
                rows = [hits.get(i, defaultdict(tuple, longest=0, at=-1)) for i in range(len(counts))]
                yield pa.record_batch({
                    "row": batch.column("row"), "doc_id": batch.column("doc_id"), "n_words": pa.array(counts, pa.int64()),
                    "ranges": pa.array([[list(x) for x in r["ranges"]] for r in rows], pa.list_(pa.list_(pa.int64()))),
                    "items": pa.array([sorted({sent.value.items[k] for k in r["items"]} - {None}) for r in rows], pa.list_(pa.string())),
                    "longest": pa.array([r["longest"] for r in rows], pa.int64()),
                    "at": pa.array([r["at"] for r in rows], pa.int64())})

        part = numbered.mapInArrow(spans, schema)
        found = part if found is None else found.unionAll(part)
    copies = F.count(F.lit(1)) / F.lit(len(sets))
    rows = found.groupBy("row", "doc_id").agg(
        copies.cast("int").alias("copies"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_set("ranges"))).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.max(F.struct("longest", (-F.col("at")).alias("at"))).alias("best"))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    hit = F.aggregate("ranges", zero, lambda acc, r: F.struct(
        (acc["n"] + F.greatest(F.lit(0), r[1] - F.greatest(r[0], acc["end"]))).cast("bigint").alias("n"),
        F.greatest(acc["end"], r[1]).alias("end")))["n"]
    return (rows.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
                        F.col("best.longest").alias("longest_match"),
                        (-F.col("best.at")).alias("longest_start"), F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
            .drop("copy"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any hit, with all their columns; rows pass through the scan, nothing is shuffled."""
    spark = prepare(docs.sparkSession)
    clean = docs
    for needles in needle_blocks(benchmark, item_col, item_text_col, window):
        sent = spark.sparkContext.broadcast(needles)

        def keep(batches, sent=sent):
            for batch in (b for part in batches for b in blocks([part], text_col)):
                _, found = scan(texts(batch, text_col), sent.value)
                yield batch.filter(pa.array([i not in found for i in range(batch.num_rows)], pa.bool_()))

        clean = clean.mapInArrow(keep, docs.schema)
    return clean
