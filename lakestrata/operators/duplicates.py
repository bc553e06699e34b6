"""Duplicate counts that stay flat under hot keys: counts are combined before each shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakestrata.session import materialize

FEW = 500_000  # repeated hashes up to which rows are looked up among them, beyond that in a bitmap
BITMAP_BITS = 28


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def duplicate_summary(df: DataFrame, keys: Sequence[str], skip_null: bool = False) -> DataFrame:
    """One row: records, unique_keys, duplicates (records - unique), rows_in_duplicates.

    ``skip_null`` treats a NULL single key the way COUNT(DISTINCT column) does: it is no value, so
    its rows count as duplicates. Otherwise a NULL, or a tuple holding one, is a value like any other.
    """
    counts = key_counts(df, keys)
    is_value = F.lit(True)
    if skip_null:
        for k in keys:
            is_value = is_value & F.col(k).isNotNull()
    total = F.coalesce(F.sum("_n"), F.lit(0))
    unique = F.count_if(is_value)
    return counts.agg(
        total.alias("records"), unique.alias("unique_keys"), (total - unique).alias("duplicates"),
        F.coalesce(F.sum(F.when(is_value & (F.col("_n") > 1), F.col("_n"))), F.lit(0)).alias("rows_in_duplicates"))


def exact_duplicate_summary(df: DataFrame) -> DataFrame:
    """``duplicate_summary`` over whole rows.

    Equal rows have equal hashes, so a first pass shuffles one 8-byte hash per row and writes the hashes that repeat. Being a written table its size is
    known: where few repeat (``FEW`` hashes) it is broadcast, else a bitmap of them is sent, which is bounded at any number of hashes and lets some others
    pass. Only rows with such a hash travel, equal ones combined before, and are compared in full. ``df`` is read three times, so it should be a table
    rather than a long plan.
    """
    columns = df.columns
    hashed = df.withColumn("_h", F.xxhash64(*columns))
    counts = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    hashes = materialize(counts.filter("_n > 1").select("_h"), "repeated-hashes")
    few = hashes.limit(FEW + 1).count() <= FEW
    suspects = key_counts(hashed.join(hashes, "_h", "left_semi") if few else _in_bitmap(hashed, hashes), columns)
    found = suspects.agg((F.coalesce(F.sum("_n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicates"),
                         F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("rows_in_duplicates"))
    records = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return found.select(records.alias("records"), (records - F.col("duplicates")).alias("unique_keys"), "duplicates",
                        "rows_in_duplicates")


def _in_bitmap(hashed: DataFrame, hashes: DataFrame) -> DataFrame:
    """Rows whose hash ``_h`` is among ``hashes``, and a few others whose hash shares its last bits with one of them.

    One bit per value of the hash's last ``BITMAP_BITS`` bits, in pieces of 4 KB that go to the tasks as one array: 32 MB at any number of hashes.
    """
    place = F.col("_h").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    piece, at = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    used = hashes.groupBy(piece.alias("_piece")).agg(F.bitmap_construct_agg(at).alias("_bits"))
    every = hashes.sparkSession.range(1, (1 << max(BITMAP_BITS - 15, 0)) + 1).select(F.col("id").alias("_piece"), F.unhex(F.lit("00")).alias("_bits"))
    filled = used.unionByName(every).groupBy("_piece").agg(F.max("_bits").alias("_bits"))
    bits = filled.agg(F.array_sort(F.collect_list(F.struct("_piece", "_bits"))).getField("_bits").alias("bits")).scalar()
    byte = F.conv(F.hex(F.substring(F.get(bits, (piece - 1).cast("int")), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return hashed.filter(F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)))
