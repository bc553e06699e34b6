"""Upsert (update matching rows, insert the others) over plain DataFrames and Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakestrata.operators.bounds import largest, partition_bounds
from lakestrata.operators.keys import number_rows
from lakestrata.operators.writes import joint_schema, overwrite_partitions, stored_schema
from lakestrata.session import materialize

SRC = "_src_"
HIT = "_matched"
OLD = "_was_there"


class DuplicateSourceKeys(ValueError):
    """More than one source row claims the same target row."""


def _all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str, null_safe: bool) -> Column:
    pairs = [(left[k], right[prefix + k]) for k in keys]
    return _all_of([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def require_unique_keys(df: DataFrame, keys: Sequence[str], null_safe: bool = True) -> None:
    """Raise when a key occurs twice. Counts are combined before the shuffle."""
    rows = df.select(*keys) if null_safe else df.select(*keys).dropna()
    repeated = rows.groupBy(*keys).count().filter("count > 1").limit(1)
    if not repeated.isEmpty():
        raise DuplicateSourceKeys(f"source rows are not unique on {list(keys)}")


def align_to(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source columns cast to the target's types; a column the target lacks is an error."""
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"target has no columns {unknown}")
    types = {f.name: f.dataType for f in target.schema.fields}
    return source.select(*[F.col(c).cast(types[c]) for c in source.columns])


def picked_columns(target: DataFrame, update: Sequence[str]) -> list[Column]:
    return [F.when(F.col(HIT), F.col(SRC + c)).otherwise(target[c]).alias(c) if c in update
            else target[c] for c in target.columns]


def inserted_rows(rows: DataFrame, target: DataFrame) -> DataFrame:
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields])


def split_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], *, null_safe: bool = True,
                 update: Sequence[str] | None = None, delete_unmatched: bool = False,
                 check_source: bool = True) -> tuple[DataFrame, DataFrame]:
    """The two halves of an upsert: target rows after the update, and source rows to insert.

    The target is looked up against the source (a left join, so a small source is broadcast and the
    target is not shuffled) and only the matching target keys travel to find the rows to insert.
    """
    source = align_to(source, target)
    if check_source:
        require_unique_keys(source, keys, null_safe)
    update = [c for c in source.columns if c not in keys] if update is None else list(update)
    tagged = source.select(*[F.col(c).alias(SRC + c) for c in source.columns], F.lit(True).alias(HIT))
    on = _match(target, tagged, keys, SRC, null_safe)
    kept = target.join(tagged, on, "inner" if delete_unmatched else "left").select(*picked_columns(target, update))

    source_keys = source.select(*[F.col(k).alias(SRC + k) for k in keys])
    target_keys = target.select(*keys)
    found = (target_keys.join(source_keys, _match(target_keys, source_keys, keys, SRC, null_safe), "left_semi")
             .select(*[F.col(k).alias(SRC + k) for k in keys]))
    fresh = source.join(found, _match(source, found, keys, SRC, null_safe), "left_anti")
    return kept, inserted_rows(fresh, target)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], *, null_safe: bool = True,
           update: Sequence[str] | None = None, delete_unmatched: bool = False,
           bulk: bool = False, check_source: bool = True) -> DataFrame:
    """The target after the upsert, with the target's columns.

    keys              match columns; with ``null_safe`` two NULLs match, otherwise NULL matches nothing
    update            columns taken from the source on a match (default: all its non-key columns)
    delete_unmatched  drop target rows that match no source row
    bulk              one full outer join, for a source of the target's order of size and a target that
                      is unique on the keys, as a table kept by upserts is; the default copes with any
    check_source      reject a source with repeated keys (skip it when the source was just deduplicated)

    Target columns absent from the source, such as a surrogate key, keep their values on update and are
    NULL on insert.
    """
    if bulk:
        source = align_to(source, target)
        if check_source:
            require_unique_keys(source, keys, null_safe)
        update = [c for c in source.columns if c not in keys] if update is None else list(update)
        return _upsert_full_outer(target, source, keys, null_safe, update, delete_unmatched)
    kept, fresh = split_upsert(target, source, keys, null_safe=null_safe, update=update,
                               delete_unmatched=delete_unmatched, check_source=check_source)
    return kept.unionByName(fresh)


def upsert_keyed(target: DataFrame, source: DataFrame, keys: Sequence[str], key: str, order_by: Sequence[str],
                 after: Column | None = None, bulk: bool = False, **options) -> DataFrame:
    """Upsert into a table with a surrogate key: known rows keep theirs, inserted rows get the next numbers.

    Numbering follows ``order_by`` and starts after ``after`` (default: the largest key of the target).
    Only the inserted rows are sorted and written to number them; the target is passed through. With ``bulk``, for a source of the target's order of
    size, both travel once: the rows are the same, and written once to tell the inserted ones.
    """
    if bulk:
        merged = materialize(upsert(target.withColumn(OLD, F.lit(True)), source, keys, bulk=True, **options), "merged")
        kept, fresh = merged.filter(F.col(OLD)).drop(OLD), merged.filter(F.col(OLD).isNull()).drop(OLD)
    else:
        kept, fresh = split_upsert(target, source, keys, **options)
    last = target.agg(F.max(key).alias("k")).scalar() if after is None else after
    return kept.unionByName(number_rows(fresh, key, order_by, after=last).select(*target.columns))


def _upsert_full_outer(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool,
                       update: Sequence[str], delete_unmatched: bool) -> DataFrame:
    apart = []
    if not null_safe:
        # NULL keys never match; they would all meet in one join task, so they go round the join.
        has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        if not delete_unmatched:
            apart.append(target.filter(has_null))
        apart.append(inserted_rows(source.filter(has_null), target))
        target, source = target.filter(~has_null), source.filter(~has_null)
    tagged = source.select(*[F.col(c).alias(SRC + c) for c in source.columns], F.lit(True).alias(HIT))
    base = target.withColumn("_target", F.lit(True))
    joined = base.join(tagged, _match(base, tagged, keys, SRC, null_safe),
                       "right" if delete_unmatched else "full_outer")
    is_new = F.col("_target").isNull()
    columns = []
    for field in target.schema.fields:
        name = field.name
        own = F.col(name)
        if name in update:
            own = F.when(F.col(HIT), F.col(SRC + name)).otherwise(own)
        if name in source.columns:
            own = F.when(is_new, F.col(SRC + name)).otherwise(own)
        columns.append(own.cast(field.dataType).alias(name))
    return reduce(DataFrame.unionByName, apart, joined.select(*columns))


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_by: str,
                      key: str | None = None, order_by: Sequence[str] = (), store: Callable[[DataFrame, str, str], object] = overwrite_partitions,
                      touched: Callable[[list], object] | None = None, **options) -> DataFrame:
    """Upsert into a partitioned Parquet table and return the table.

    ``partition_by`` must follow from the key (a month of a key timestamp, say). Then rows of one key
    share a partition, and only the partitions named by the source are read and rewritten: loading a
    month costs that month, not the whole table. The new partitions are complete beside the table before any
    is replaced. With ``key`` the table has a surrogate key, numbered in ``order_by`` order; its largest value comes from the bounds kept for
    each partition, so other partitions are not read for it either.

    ``store(rows, path, partition_by)`` puts the finished rows of the touched partitions in place; one that checks them first (``quality.observed``)
    can refuse, and the table stays as it was. ``touched`` is told the partitions when all are in place.

    Stored columns that the source lacks stay: unchanged on update, NULL on insert. New columns of the
    source are added, NULL in rows that were there.
    """
    batch = materialize(source, "upsert-source")
    # One value per table partition: as short as the list of partition folders.
    named = [row[0] for row in batch.select(partition_by).distinct().collect()]
    declared = source.schema if key is None else T.StructType([T.StructField(key, T.LongType()), *source.schema.fields])
    schema = joint_schema(declared, stored_schema(spark, path), partition_by, path)
    table = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    in_load = F.col(partition_by).isin([v for v in named if v is not None])
    part = table.filter(in_load | F.col(partition_by).isNull() if None in named else in_load)
    last = None if key is None else F.lit(largest(partition_bounds(spark, path, [key], schema), key))
    if part.isEmpty():
        # New partitions only, the usual case of a monthly load: nothing to match, one write less.
        if options.get("check_source", True):
            require_unique_keys(batch, keys, options.get("null_safe", True))
        fresh = batch if key is None else number_rows(batch, key, order_by, after=last)
        store(fresh, path, partition_by)
    else:
        merged = (upsert(part, batch, keys, **options) if key is None
                  else upsert_keyed(part, batch, keys, key, order_by, after=last, **options))
        # Dynamic overwrite writes beside the table and swaps partitions when all tasks are done, so it may read them.
        store(merged, path, partition_by)
    if key is not None:
        partition_bounds(spark, path, [key], schema)  # of the partitions just written
    if touched is not None:
        touched(named)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def merge_into(source: DataFrame, table: str, keys: Sequence[str], *, null_safe: bool = True,
               update: Sequence[str] | None = None, delete_unmatched: bool = False) -> None:
    """The same upsert as a MERGE statement, for tables of a catalog that supports it."""
    op = "eqNullSafe" if null_safe else "__eq__"
    on = _all_of([getattr(F.col(f"{table}.{k}"), op)(F.col(f"source.{k}")) for k in keys])
    writer = source.alias("source").mergeInto(table, on)
    if update is None:
        writer = writer.whenMatched().updateAll()
    else:
        writer = writer.whenMatched().update({c: F.col(f"source.{c}") for c in update})
    writer = writer.whenNotMatched().insertAll()
    if delete_unmatched:
        writer = writer.whenNotMatchedBySource().delete()
    writer.merge()
