"""Near duplicates by SimHash fingerprints and pigeonhole blocks.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a shingle is ``words`` consecutive words, space-joined, repeats included (all words of a
shorter text). A fingerprint bit is 1 if set in over half of the shingles' XXH64 values (UTF-8, seed 42). Fingerprints link at ``DISTANCE`` or
fewer differing bits.

1. One pass over the texts gives the fingerprints. Equal ones form a class; only its smallest identifier travels on.
2. The bits are split into ``DISTANCE + 1`` blocks. Two fingerprints that differ in at most ``DISTANCE`` bits agree in all bits of some block, so each
   class is entered under its value of every block, and the members of one value meet.
3. The sizes are counted before anything meets. The classes of a value that more than ``limit`` of them share are split again by the same principle:
   the bits not yet agreed on form the next blocks, whose values go into the key as well. This ends, because members that agree in all but
   ``DISTANCE`` bits are all linked, and a value agreed on in 64 - f bits has at most 2^f members. With the default limit a class is entered at most
   4^6 times, and that only where more than ``limit`` different fingerprints agree at every level before; other classes are entered four times.
4. Within a value all distances are computed, in a task that holds at most ``limit`` fingerprints of it, and only links that join two parts of it come
   out: fewer than it has members. Components of these links are the groups.

Nothing is collected to the driver but whether a level is empty.

Defined results: null, empty and wordless texts have fingerprint zero, which is linked like any other; rows without identifier keep their
fingerprint, have no component and link nothing; rows with equal identifiers are one document, linked by any of its texts; a component takes its
smallest identifier. Other columns do not matter.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import blocks, prepare, texts, unused
from lakestrata.llm.neardup import components, with_end
from lakestrata.session import materialize

BITS = 64
DISTANCE = 3
SEED = 42
LIMIT = 4096           # different fingerprints that meet in one task under one key
HASHES = 1 << 16       # hashes whose bits are counted at once
ROWS = 1 << 16         # fingerprints that are compared at once, and at most one key's more


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of every shingle of a text."""
    found = text.lower().split()
    if not found:
        return []
    joined = b" ".join(found)
    width = min(words, len(found))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts[:len(found) - width + 1].tolist(), ends[width - 1:].tolist())]


def majorities(lists: list[list[int]]) -> np.ndarray:
    """The fingerprint of each list of hashes: bits set in over half of them."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    counts = np.zeros((len(lists), BITS), np.int64)
    held: list[tuple[int, list[int]]] = []
    waiting = 0

    def count():
        every = np.fromiter((h for _, part in held for h in part), np.uint64, waiting)
        bits = np.unpackbits(every.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        places = np.cumsum([0] + [len(part) for _, part in held])[:-1]
        counts[[k for k, _ in held]] += np.add.reduceat(bits, places, axis=0, dtype=np.int64)

    for k, own in enumerate(lists):
        for at in range(0, len(own), HASHES):
            held.append((k, own[at:at + HASHES]))
            waiting += len(held[-1][1])
            if waiting >= HASHES:
                count()
                held, waiting = [], 0
    if held:
        count()
    weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    return ((counts * 2 > sizes[:, None]) * weights).sum(axis=1, dtype=np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``doc_id, fp`` of every row, the 64 bits as a long."""
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        for batch in (b for part in batches for b in blocks([part], "text", 2 << 20)):
            found = majorities([shingle_hashes(t, words) for t in texts(batch, "text")])
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fp": pa.array(found.view(np.int64))})

    return narrow.mapInArrow(run, "doc_id long, fp long")


@lru_cache(maxsize=None)
def agreed(path: int) -> int:
    """The bits that the members of a key of this path agree on. Path 0 has none; path p has the children 4p + 1 to 4p + 4, one for each block."""
    if not path:
        return 0
    parent, block = (path - 1) // (DISTANCE + 1), (path - 1) % (DISTANCE + 1)
    free = [b for b in range(BITS) if not agreed(parent) >> b & 1]
    low, high = (len(free) * k // (DISTANCE + 1) for k in (block, block + 1))
    return agreed(parent) | sum(1 << b for b in free[low:high])


def free_bits(path: int) -> int:
    return BITS - agreed(path).bit_count()


def entered(classes: DataFrame) -> DataFrame:
    """``path, fp, member`` entered under the keys one level down: ``path, value, fp, member``."""
    def run(batches):
        for batch in batches:
            path, fp = batch.column("path").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
            for p in np.unique(path).tolist():
                at = np.flatnonzero(path == p)
                for child in range((DISTANCE + 1) * p + 1, (DISTANCE + 1) * (p + 1) + 1):
                    yield pa.record_batch({
                        "path": pa.array(np.full(len(at), child)), "value": pa.array((fp[at] & np.uint64(agreed(child))).view(np.int64)),
                        "fp": pa.array(fp[at].view(np.int64)), "member": batch.column("member").take(pa.array(at))})

    return classes.select("path", "fp", "member").mapInArrow(run, "path long, value long, fp long, member long")


def joining(group: np.ndarray, fp: np.ndarray, within: int = DISTANCE) -> list[tuple[int, int]]:
    """Pairs of rows of one group within the distance that join two parts of it. Rows of a group are neighbours."""
    n = len(fp)
    last = np.concatenate((np.flatnonzero(group[1:] != group[:-1]), [n - 1]))
    end = last[np.searchsorted(last, np.arange(n))]
    part, out = np.arange(n), []

    def root(x: int) -> int:
        while part[x] != x:
            x = part[x]
        return int(x)

    step, rows = 1, np.arange(n)
    while True:
        rows = rows[rows + step <= end[rows]]
        if not len(rows):
            return out
        other = rows + step
        close = (np.bitwise_count(fp[rows] ^ fp[other]) <= within) & (part[rows] != part[other])
        for x, y in zip(rows[close].tolist(), other[close].tolist()):
            a, b = root(x), root(y)
            if a != b:
                part[max(a, b)] = min(a, b)
                out.append((x, y))
        if close.any():
            while (part[part] != part).any():
                part = part[part]
        step += 1


def links(keyed: DataFrame) -> DataFrame:
    """``a, b``: links between the members of each key, fewer than members."""
    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in with_end(batches):
            if batch is not None:
                held.append(batch)
                if sum(b.num_rows for b in held) < ROWS:
                    continue
            if not sum(b.num_rows for b in held):
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            path, value, fp, member = (rows[c].to_numpy() for c in ("path", "value", "fp", "member"))
            new = np.concatenate(([True], (path[1:] != path[:-1]) | (value[1:] != value[:-1])))
            cut = len(new) if batch is None else int(np.flatnonzero(new)[-1])
            if cut:
                pairs = joining(np.cumsum(new)[:cut], fp[:cut].view(np.uint64))
                if pairs:
                    a, b = (member[np.array(side)] for side in zip(*pairs))
                    yield pa.record_batch({"a": pa.array(a), "b": pa.array(b)})
            held = [] if batch is None else rows.slice(cut).combine_chunks().to_batches()

    return (keyed.repartition("path", "value").sortWithinPartitions("path", "value", "fp").select("path", "value", "fp", "member")
            .mapInArrow(run, "a long, b long"))


def near_links(classes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``a, b``: links that connect all classes (``fp, member``) within the distance."""
    if limit < 1 << DISTANCE:
        raise ValueError(f"limit must be {1 << DISTANCE} at least")
    found, level = [], classes.withColumn("path", F.lit(0).cast("long"))
    while True:
        keyed = materialize(entered(level), "simhash-keys")
        sizes = keyed.groupBy("path", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        met = materialize(keyed.join(sizes, ["path", "value"]), "simhash-met")
        found.append(materialize(links(met.where(F.col("n") <= limit)), "simhash-links"))
        crowded = met.where(F.col("n") > limit)
        if crowded.isEmpty():
            break
        level = crowded.select("path", "fp", "member")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, limit: int = LIMIT) -> DataFrame:
    """One row per input row: ``doc_id, fp, component_id, kept``. Runs its rounds, which write to the work folder, while building."""
    seen = materialize(fingerprints(docs, id_col, text_col, words), "simhash-prints")
    known = seen.where("doc_id is not null")
    classes = materialize(known.groupBy("fp").agg(F.min("doc_id").alias("member")), "simhash-classes")
    repeated = known.groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high").select("doc_id")
    members = classes.select("fp", F.col("member"))
    same = known.join(repeated, "doc_id").join(members, "fp").select(F.col("doc_id").alias("a"), F.col("member").alias("b"))
    labels = components(near_links(classes, limit).union(same))
    named = (classes.join(labels, classes["member"] == labels["node"], "left")
             .select("fp", F.coalesce("component", "member").alias("component_id")))
    full = known.join(named, "fp").select("doc_id", "fp", "component_id")
    alone = seen.where("doc_id is null").select("doc_id", "fp", F.col("doc_id").alias("component_id"))
    return full.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, limit: int = LIMIT) -> DataFrame:
    """The rows of ``docs`` whose document stays, one document per component; rows without identifier all stay."""
    own, stays = unused(docs, "own_id"), unused(docs, "stays")
    kept = near_groups(docs, id_col, text_col, words, limit).where("kept and doc_id is not null").select(F.col("doc_id").alias(stays)).distinct()
    typed = docs.withColumn(own, F.col(id_col).cast("bigint"))
    stay = typed.where(F.col(own).isNotNull()).join(kept.hint("merge"), F.col(own) == F.col(stays), "left_semi")
    return stay.union(typed.where(F.col(own).isNull())).select(*docs.columns)
