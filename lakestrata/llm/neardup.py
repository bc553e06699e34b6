"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures, confirmed on full shingle sets.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a document's set holds its distinct shingles of ``words`` words, one shingle of
all words if it has fewer, nothing if it has none. Two documents are linked if 100 * intersection >= ``percent`` * union.

1. One pass over the texts gives each document its set's size and digest, and a signature of ``CHUNKS * SYMBOLS`` MinHash values cut to 16 bits.
   Equal sets form a class; from here on only the smallest document of a class travels.
2. The signature is split into ``CHUNKS`` chunks. By the pigeonhole principle two signatures that differ in at most ``2 * CHUNKS - 1`` places
   have a chunk with at most one difference, so each chunk is entered under ``SYMBOLS`` keys that leave out one place each. All pairs
   under that distance share a key. With 12 chunks of 6, a pair at similarity 0.8 shares none with a chance of 3e-6 (0.345 ** 12).
3. The smallest member of a key's bucket is its center; all members of the buckets with one center are a group. Each member is compared with its
   centers on the full sets: as many pairs as members. Links give components.
4. A group that still holds several components may hide links between them. If it is larger than a block, members leave whose rarest shingles nobody
   of another component shares, which by the prefix principle have no link there: of pages that only share a passage, all. The others are dealt out in
   blocks of bounded size, every two of which meet in some task, together with the full sets. There signatures rule out pairs beyond ``DISTANCE``
   and full sets decide the others. Only links that merge components come out, so no candidate is lost and no pair that is none is written.
   (What still grows with the square of a group, at one row for ``BLOCK`` pairs, are members that do share rare shingles across components.)

The new links complete the components. Nothing is collected to the driver but counts.

Defined results: null and wordless texts are empty sets, linked with nothing; rows without identifier are linked with nothing (no component) and
stay; rows with equal identifiers are one document, linked by any of its texts; components take their smallest identifier. Other
columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import WordHashes, blocks, mix, prepare, texts, unused
from lakestrata.session import materialize

CHUNKS, SYMBOLS = 12, 6
PLACES = CHUNKS * SYMBOLS
DISTANCE = 31          # of 72 places; a pair at similarity 0.8 differs in 14.4 of them, with a deviation of 3.4
BLOCK = 256            # bucket members compared at once

_rng = np.random.default_rng(20240229)
ODD = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SEEDS = _rng.integers(0, 1 << 63, PLACES, dtype=np.uint64)
FACTORS = _rng.integers(0, 1 << 63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """The sorted set of a document's shingles as 64-bit hashes."""
    n = len(hashes)
    width = min(words, n)
    if not n:
        return hashes
    total = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        total += hashes[j:n - width + 1 + j] * ODD[j]
    return np.unique(mix(total))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 16-bit symbols for each set; zeros for an empty one."""
    sizes = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), PLACES), np.uint16)
    full = np.flatnonzero(sizes)
    if len(full):
        every = np.concatenate([sets[i] for i in full])
        starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
        for k in range(PLACES):
            least = np.minimum.reduceat((every ^ SEEDS[k]) * FACTORS[k], starts)
            out[full, k] = (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def features(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``doc_id, n_shingles, digest, signature`` of every row."""
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        known = WordHashes()
        for batch in (b for part in batches for b in blocks([part], "text", 2 << 20)):
            sets = [shingles(known.of(t.lower().split()), words) for t in texts(batch, "text")]
            rows = signatures(sets)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                "signature": pa.array([r.tobytes() for r in rows], pa.binary())})

    return narrow.mapInArrow(run, "doc_id long, n_shingles long, digest binary, signature binary")


def keyed(members: DataFrame) -> DataFrame:
    """Every member under its keys: a chunk without one of its places."""
    def run(batches):
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, CHUNKS, SYMBOLS).astype(np.uint64)
            weighted = (rows + np.uint64(1)) * ODD[:SYMBOLS]
            left_out = weighted.sum(axis=2, dtype=np.uint64)[:, :, None] - weighted
            name = (np.arange(CHUNKS * SYMBOLS, dtype=np.uint64) + np.uint64(1)).reshape(CHUNKS, SYMBOLS) * ODD[40]
            keys = mix(mix(left_out) + name).reshape(-1).view(np.int64)
            yield pa.record_batch({"key": pa.array(keys), "member": pa.array(np.repeat(batch.column("member").to_numpy(), PLACES))})

    return members.select("member", "signature").mapInArrow(run, "key long, member long")


def shingle_sets(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``member, set`` of the documents in ``members``, whose texts are read again."""
    narrow = (docs.select(F.col(id_col).cast("bigint").alias("member"), F.col(text_col).cast("binary").alias("text"))
              .join(members.hint("merge"), "member", "left_semi"))  # the list grows with the corpus: never broadcast

    def run(batches):
        known = WordHashes()
        for batch in (x for part in batches for x in blocks([part], "text")):
            sets = [shingles(known.of(t.lower().split()), words).view(np.int64) for t in texts(batch, "text")]
            yield pa.record_batch({"member": batch.column("member"), "set": pa.array(sets, pa.list_(pa.int64()))})

    return narrow.mapInArrow(run, "member long, set array<long>")


def star_links(groups: DataFrame, sets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The members (b) of each group that are linked with its center (a), decided on full sets."""
    a, b = sizes.toDF("a", "size_a"), sizes.toDF("b", "size_b")
    able = (groups.where("member <> center").toDF("a", "b").join(a, "a").join(b, "b")
            .where(100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")).select("a", "b"))
    both = able.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return (both.withColumn("shared", shared).where(F.col("shared") * 100 >= percent * (F.size("set_a") + F.size("set_b") - F.col("shared")))
            .select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of some link, by alternating large and small stars."""
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())


def with_end(batches):
    """The batches and then None."""
    yield from batches
    yield None


def linked(ids, label, own, signs, starts, values, percent: int) -> list[tuple[int, int]]:
    """Links between rows of different labels, within one block or from one block to the other; a link merges its labels.

    ``values[starts[k]:starts[k + 1]]`` is the set of row k. Signatures rule out most pairs, full sets decide the others.
    """
    one = own == own[0]
    first, second = (np.flatnonzero(one), np.flatnonzero(~one)) if not one.all() else (np.arange(len(ids)),) * 2
    size, label, out = np.diff(starts), label.copy(), []
    for x in first:
        y = second[(label[second] != label[x]) & ((ids[second] > ids[x]) | (own[second] != own[x]))]
        y = y[100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x])]
        y = y[np.count_nonzero(signs[y] != signs[x], axis=1) <= DISTANCE]
        if not len(y):
            continue
        mine = values[starts[x]:starts[x + 1]]
        theirs = np.concatenate([values[starts[k]:starts[k + 1]] for k in y])
        place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
        shared = np.add.reduceat((mine[place] == theirs).astype(np.int64), np.concatenate(([0], np.cumsum(size[y])[:-1])))
        for k in y[100 * shared >= percent * (size[y] + size[x] - shared)]:
            if label[k] != label[x]:
                out.append((int(min(ids[x], ids[k])), int(max(ids[x], ids[k]))))
                label[label == label[k]] = label[x]
    return out


def contenders(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those members (``center, member, label``) that can be linked with one of another label in their group.

    Sets ordered by how often their shingles occur in the group, rarest first, can only reach ``percent`` if their first
    size - ceil(size * percent / 100) + 1 shingles have one in common. Shingles that nobody else in the group has take their places in front and drop out.
    """
    each = members.join(sets, "member").select("center", "member", "label", F.size("set").alias("size"), F.explode("set").alias("shingle"))
    often = each.groupBy("center", "shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = (each.join(often, ["center", "shingle"]).groupBy("center", "member", "label", "size")
           .agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("rare")))
    places = F.expr(f"size(rare) - cast(ceil(size * {percent} / 100) as int) + 1")
    first = materialize(own.withColumn("places", places).where("places > 0")
                        .select("center", "member", "label", F.explode(F.slice("rare", F.lit(1), F.col("places"))).alias("r"))
                        .select("center", "member", "label", "r.shingle"), "prefixes")
    across = first.groupBy("center", "shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return first.join(across, ["center", "shingle"], "left_semi").select("center", "member", "label").distinct()


def dealt(named: DataFrame, parts: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """The members of each group in every pair of blocks that theirs is in, with signature and set."""
    return (named.join(parts, "center").join(classes.select("member", "signature"), "member").join(sets, "member")
            .withColumn("own", F.expr("cast(pmod(xxhash64(member, 7), parts) as int)"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("center", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "member", "label", "signature", "set"))


def open_groups(named: DataFrame) -> DataFrame:
    """``center, parts`` of the groups that hold several labels: into how many blocks they go."""
    return (named.groupBy("center").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"))
            .where("low <> high").select("center", F.expr(f"cast((n + {BLOCK - 1}) div {BLOCK} as int)").alias("parts")))


def links_across(groups: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components of one group. At most as many rows come out of a block as it has members."""
    named = (groups.join(labels, groups["member"] == labels["node"], "left")
             .select("center", "member", F.coalesce("component", "member").alias("label")))
    parts = materialize(open_groups(named), "open-groups")
    rows = dealt(named, parts.where("parts = 1"), classes, sets)
    wide = parts.where("parts > 1")
    if not wide.isEmpty():
        left = materialize(contenders(named.join(wide.select("center"), "center"), sets, percent), "contenders")
        rows = rows.union(dealt(left, open_groups(left), classes, sets))

    def run(batches):
        held = None
        for batch in with_end(batches):
            parts = [b for b in (held, batch) if b is not None and b.num_rows]
            if not parts:
                continue
            part = pa.Table.from_batches(parts).combine_chunks()
            group = np.stack([part[c].to_numpy().astype(np.int64) for c in ("center", "i", "j")])
            cuts = np.concatenate(([0], np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1, [part.num_rows]))
            done = len(cuts) - 1 if batch is None else len(cuts) - 2
            ids, label, own = (part[c].to_numpy() for c in ("member", "label", "own"))
            signs = np.frombuffer(b"".join(part["signature"].to_pylist()), np.uint16).reshape(-1, PLACES)
            lists = part["set"].combine_chunks()
            starts, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
            pairs = {p for k in range(done) if cuts[k + 1] - cuts[k] > 1 for at in [slice(cuts[k], cuts[k + 1])]
                     for p in linked(ids[at], label[at], own[at], signs[at], starts[cuts[k]:cuts[k + 1] + 1], values, percent)}
            held = None if batch is None else part.slice(cuts[done]).combine_chunks().to_batches()[0]
            if pairs:
                a, b = zip(*sorted(pairs))
                yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return (rows.repartition("center", "i", "j").sortWithinPartitions("center", "i", "j").mapInArrow(run, "a long, b long").distinct())


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``. Runs its rounds, which write to the work folder, while building."""
    prepare(docs.sparkSession)
    seen = materialize(features(docs, id_col, text_col, words), "signatures")
    classes = materialize(seen.where("doc_id is not null and n_shingles > 0").groupBy("digest")
                          .agg(F.min(F.struct("doc_id", "n_shingles", "signature")).alias("m"))
                          .select("digest", F.col("m.doc_id").alias("member"), "m.n_shingles", "m.signature"), "classes")
    keys = keyed(classes)
    shared = keys.groupBy("key").agg(F.min("member").alias("center"), F.max("member").alias("last")).where("center <> last").select("key", "center")
    groups = materialize(keys.join(shared.hint("shuffle_hash"), "key").select("center", "member").distinct(), "groups")
    sets = materialize(shingle_sets(docs, groups.select("member").distinct(), id_col, text_col, words), "shingles")

    links = materialize(star_links(groups, sets, classes.select("member", "n_shingles"), percent), "links")
    more = materialize(links_across(groups, components(links), classes, sets, percent), "links")
    # Rows with one identifier are one document, so the classes of its texts belong together.
    known = seen.where("doc_id is not null and n_shingles > 0")
    repeated = known.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high").select("doc_id")
    same = known.join(repeated, "doc_id").join(classes, "digest").select(F.col("doc_id").alias("a"), F.col("member").alias("b"))
    labels = components(links.union(more).union(same))
    named = (classes.join(labels, classes["member"] == labels["node"], "left")
             .select("digest", F.coalesce("component", "member").alias("component_id")))
    full = known.join(named, "digest").select("doc_id", "n_shingles", "component_id")
    alone = seen.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, one document per component; rows without identifier all stay.

    Of a document that stays, rows that repeat its identifier and text are one, and every distinct text of it stays.
    """
    own, stays, digest = unused(docs, "own_id"), unused(docs, "stays"), unused(docs, "text_digest")
    kept = near_groups(docs, id_col, text_col, words, percent).where("kept and doc_id is not null").select(F.col("doc_id").alias(stays)).distinct()
    typed = docs.withColumn(own, F.col(id_col).cast("bigint")).withColumn(digest, F.sha2(F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")), 256))
    stay = typed.where(F.col(own).isNotNull()).join(kept.hint("merge"), F.col(own) == F.col(stays), "left_semi").dropDuplicates([own, digest])
    return stay.union(typed.where(F.col(own).isNull())).select(*docs.columns)
