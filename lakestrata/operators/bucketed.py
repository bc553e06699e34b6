"""Upsert into a table stored in buckets of its key, so that the load moves and the stored rows stay where they are.

The rows of such a table carry a 64-bit hash of the key; the table is bucketed and sorted by it. Spark reads a bucketed table as already
partitioned, and a load dealt out by the same hash into the same number of parts meets it without an exchange of the stored side. The keys
themselves are compared in the join condition, so equal hashes of different keys do no harm. NULLs in the key cannot be bucketed by null-safe equality
itself, which the planner rewrites; the hash stands for it.

The bucketing (keys, number, kind of equality) is kept in the metadata of the hash column, in the footers of the files: the table is known by
its folder alone and needs no lasting catalog. An upsert writes the new table beside the old one and renames. One writer at a time is assumed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestrata.operators.keys import number_rows
from lakestrata.operators.upsert import HIT, SRC, align_to, inserted_rows, picked_columns, require_unique_keys, upsert, upsert_keyed
from lakestrata.operators.writes import replace_path
from lakestrata.session import materialize, new_beside, swap_path

HASH = "key_hash"
MARK = "bucketed_by"
BUCKET_ROWS = 250_000  # some 100 MB of wide rows, which a task sorts and joins with its part of the load


class Bucketing(NamedTuple):
    keys: tuple[str, ...]
    buckets: int
    null_safe: bool


def bucketing_of(df: DataFrame) -> Bucketing | None:
    """How a stored table is bucketed, or None if it is not."""
    mark = df.schema[HASH].metadata.get(MARK) if HASH in df.columns else None
    return Bucketing(tuple(mark["keys"]), mark["buckets"], mark["null_safe"]) if mark else None


def _hashed(df: DataFrame, spec: Bucketing, prefix: str = "") -> Column:
    """The hash of the key. Under plain equality a key with a NULL matches nothing, so its rows are spread by all their values."""
    keys = [F.col(prefix + k) for k in spec.keys]
    whole = F.xxhash64(*keys)
    if spec.null_safe:
        return whole
    missing = F.lit(False)
    for k in keys:
        missing = missing | k.isNull()
    return F.when(missing, F.xxhash64(*[F.col(c) for c in df.columns if c != HASH])).otherwise(whole)


def _same_key(spec: Bucketing) -> Column:
    """Equality of the keys, worded so that the planner leaves it in the join condition and joins on the hash alone."""
    same = F.lit(True)
    for k in spec.keys:
        own, other = F.col(k), F.col(SRC + k)
        same = same & F.coalesce(own == other, (own.isNull() & other.isNull()) if spec.null_safe else F.lit(False))
    return same


def _catalog_name(path: str) -> str:
    return f"lakestrata_bucketed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table with its hash column, read in buckets; None unless it is stored so."""
    plain = spark.read.parquet(path)
    spec = bucketing_of(plain)
    if spec is None or plain.isEmpty():
        return None
    name = _catalog_name(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({HASH}) SORTED BY ({HASH}) INTO {spec.buckets} BUCKETS "
              f"LOCATION '{path}'")
    return spark.table(name).withMetadata(HASH, {MARK: {"keys": list(spec.keys), "buckets": spec.buckets, "null_safe": spec.null_safe}})


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table without its hash column; also a table that is not bucketed."""
    stored = _stored(spark, path)
    return (spark.read.parquet(path) if stored is None else stored).drop(HASH)


def _write(dealt: DataFrame, path: str, spec: Bucketing) -> None:
    """Replace the table by rows with their hash, each task of which holds whole buckets."""
    spark = dealt.sparkSession
    fresh = new_beside(path)
    name = _catalog_name(fresh)
    marked = dealt.withMetadata(HASH, {MARK: {"keys": list(spec.keys), "buckets": spec.buckets, "null_safe": spec.null_safe}})
    if dealt.isEmpty():
        marked.write.parquet(fresh)
    else:
        try:
            marked.write.bucketBy(spec.buckets, HASH).sortBy(HASH).option("path", fresh).format("parquet").saveAsTable(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # the entry only: the files are outside the catalog's own folder
    swap_path(spark, fresh, path)
    spark.sql(f"DROP TABLE IF EXISTS {_catalog_name(path)}")
    spark.catalog.refreshByPath(path)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, null_safe: bool = True) -> DataFrame:
    """Store ``df`` bucketed by ``keys``, in place of any table at ``path``.

    ``buckets`` is the least number: a table of more than ``BUCKET_ROWS`` rows a bucket gets as many more as it takes, so that what a task holds does not
    grow with the table. ``df`` is counted for that. Upserts keep the number; a table that grows to a multiple by them is to be written again.
    """
    rows = df.drop(HASH)
    rows = materialize(rows, "bucketed") if _reads(rows, path) else rows
    spec = Bucketing(tuple(keys), max(buckets, -(-rows.count() // BUCKET_ROWS)), null_safe)
    _write(rows.withColumn(HASH, _hashed(rows, spec)).repartition(spec.buckets, HASH), path, spec)
    return read_bucketed(df.sparkSession, path)


def _reads(df: DataFrame, path: str) -> bool:
    return any(f"{path.rstrip('/')}/" in f for f in df.inputFiles())


def upsert_bucketed(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], *, null_safe: bool = True,
                    update: Sequence[str] | None = None, delete_unmatched: bool = False, check_source: bool = True, key: str | None = None,
                    order_by: Sequence[str] = ()) -> DataFrame:
    """Upsert into the table at ``path`` and return the table; options as for ``upsert``.

    The load is dealt out into the table's buckets and joined with them; the stored rows are not exchanged, and each bucket is written by the
    task that read it. With ``key`` inserted rows get the next numbers in ``order_by`` order; only they are sorted and dealt out again.

    A table that is not bucketed, or bucketed by other keys, is upserted by ``upsert`` and written as it was.
    """
    stored = _stored(spark, path)
    spec = None if stored is None else bucketing_of(stored)
    if spec is None or set(spec.keys) != set(keys) or spec.null_safe != null_safe:
        return _upsert_plain(spark, path, source, keys, key, order_by, null_safe=null_safe, update=update, delete_unmatched=delete_unmatched,
                             check_source=check_source)
    if not delete_unmatched and key is None:
        merged = bucketed_merge(stored, source, update, check_source)
    else:
        merged = _two_halves(stored, materialize(source, "upsert-source"), update, delete_unmatched, check_source, key, order_by)
    _write(merged, path, spec)
    return read_bucketed(spark, path)


def _load_side(stored: DataFrame, source: DataFrame, check_source: bool) -> tuple[Bucketing, DataFrame]:
    """The load in the stored types, with its hash, dealt out like the table."""
    spec = bucketing_of(stored)
    rows = align_to(source, stored.drop(HASH))
    if check_source:
        require_unique_keys(rows, spec.keys, spec.null_safe)
    return spec, rows.withColumn(HASH, _hashed(rows, spec)).repartition(spec.buckets, HASH)


def bucketed_merge(stored: DataFrame, source: DataFrame, update: Sequence[str] | None = None, check_source: bool = True) -> DataFrame:
    """Stored rows with the load's values where keys match, and the load's other rows: one full outer join within the buckets."""
    spec, load = _load_side(stored, source, check_source)
    update = [c for c in load.columns if c not in spec.keys and c != HASH] if update is None else list(update)
    tagged = load.select(*[F.col(c).alias(SRC + c) for c in load.columns], F.lit(True).alias(HIT))
    joined = stored.withColumn("_target", F.lit(True)).join(tagged, (F.col(HASH) == F.col(SRC + HASH)) & _same_key(spec), "full_outer")
    is_new = F.col("_target").isNull()

    def value(name: str) -> Column:
        own = F.when(F.col(HIT), F.col(SRC + name)).otherwise(F.col(name)) if name in update else F.col(name)
        return (F.when(is_new, F.col(SRC + name)).otherwise(own) if name in load.columns else own).alias(name)
    return joined.select(*[value(c) for c in stored.columns])


def _two_halves(stored: DataFrame, source: DataFrame, update: Sequence[str] | None, delete_unmatched: bool, check_source: bool, key: str | None,
                order_by: Sequence[str]) -> DataFrame:
    """Stored rows after the update, and the inserted rows, numbered if asked; neither join moves the stored side."""
    spec, load = _load_side(stored, source, check_source)
    update = [c for c in load.columns if c not in spec.keys and c != HASH] if update is None else list(update)
    tagged = load.select(*[F.col(c).alias(SRC + c) for c in load.columns], F.lit(True).alias(HIT))
    on = (F.col(HASH) == F.col(SRC + HASH)) & _same_key(spec)
    kept = stored.join(tagged, on, "inner" if delete_unmatched else "left").select(*picked_columns(stored, update))
    names = [HASH, *spec.keys]
    other = stored.select(*[F.col(c).alias(SRC + c) for c in names])
    fresh = inserted_rows(load.join(other.hint("merge"), on, "left_anti"), stored)  # the stored side grows: read in buckets, not broadcast
    if key is not None:
        last = stored.agg(F.max(key).alias("k")).scalar()
        fresh = number_rows(fresh, key, order_by, after=last).select(*stored.columns).repartition(spec.buckets, HASH)
    return kept.unionByName(fresh)


def _upsert_plain(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], key: str | None, order_by: Sequence[str],
                  **options) -> DataFrame:
    table = spark.read.parquet(path)
    spec, target = bucketing_of(table), table.drop(HASH)
    batch = materialize(source, "upsert-source")
    merged = upsert(target, batch, keys, **options) if key is None else upsert_keyed(target, batch, keys, key, order_by, **options)
    if spec is None:
        replace_path(merged, path)
    else:
        merged = materialize(merged, "bucketed")
        _write(merged.withColumn(HASH, _hashed(merged, spec)).repartition(spec.buckets, HASH), path, spec)
    return read_bucketed(spark, path)
