"""Exact duplicates by a tree merge of sorted digest runs; DataFrame functions only.

Every input partition turns its rows into sorted runs: one entry per distinct text with its digest,
two checks, the smallest and largest identifier and the number of rows. In each round, groups of
``fan_in`` runs are exchanged and merged, and the merged entry keeps the smallest and largest
identifier. So one text has at most ``fan_in`` entries in any exchange, however many rows share it.
The root of the tree is then matched with the first runs again, whose entries list their row
identifiers; a list never exceeds ``RUN_ROWS``.

Defined results: null text counts as empty; rows without an identifier belong to their group but are
never the one that stays, unless the group has none with one; rows that repeat an identifier and text
are one document (both say kept, ``deduplicate`` returns one). Other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import ascii_lower
from lakestrata.session import materialize

RUN_ROWS = 4096
FAN_IN = 16


def verified(value: Column) -> Column:
    """``value``, or an error if entries of one digest differ in length or second hash."""
    same = (F.min("len_lo") == F.max("len_hi")) & (F.min("alt_lo") == F.max("alt_hi"))
    return F.when(same, value).otherwise(F.raise_error(F.lit("two texts share a digest")).cast("bigint"))


def runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """First runs: one entry per (partition, run, digest) with the identifiers of its rows."""
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    place = F.monotonically_increasing_id()
    hashed = (docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("t"), place.alias("place"))
              .select("id", F.sha2(F.col("t"), 256).alias("digest"), F.octet_length("t").cast("bigint").alias("size"),
                      F.xxhash64("t").alias("alt"), F.shiftright("place", 33).alias("part"),
                      F.expr(f"(place & {(1 << 33) - 1}) div {RUN_ROWS}").alias("run")))
    return (hashed.groupBy("part", "run", "digest")
            .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n"),
                 F.min("size").alias("len_lo"), F.max("size").alias("len_hi"),
                 F.min("alt").alias("alt_lo"), F.max("alt").alias("alt_hi"),
                 F.collect_list(F.struct("id")).alias("ids")))


def merged(level: DataFrame) -> DataFrame:
    """One round: entries of a text within a group of runs become one, sorted by digest."""
    return (level.repartition("node", "digest").sortWithinPartitions("node", "digest").groupBy("node", "digest")
            .agg(verified(F.min("low")).alias("low"), verified(F.max("high")).alias("high"), F.sum("n").alias("n"),
                 F.min("len_lo").alias("len_lo"), F.max("len_hi").alias("len_hi"),
                 F.min("alt_lo").alias("alt_lo"), F.max("alt_hi").alias("alt_hi")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z. ``keep`` says which identifier of a group
    stays: 'smallest' or 'largest'. Writes the first runs to the work folder while building.
    """
    first = materialize(runs(docs, id_col, text_col), "digest-runs")
    level = first.drop("ids", "run").withColumnRenamed("part", "node")
    parts = (first.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        level = merged(level)
        if parts <= 1:
            break
        parts = -(-parts // fan_in)
        level = level.withColumn("node", F.expr(f"node div {fan_in}"))
    stays = "low" if keep == "smallest" else "high"
    root = level.select("digest", F.col(stays).alias("keep_id"), F.col("n").alias("group_size"))
    return (first.select("digest", "ids").join(root, "digest")
            .select(F.explode("ids").alias("row"), "keep_id", "group_size", "digest")
            .select(F.col("row.id").alias("doc_id"), "keep_id", "group_size",
                    F.col("row.id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct text, with their own columns.

    The join keeps the texts where they are if the list of kept rows is small, and otherwise moves them once.
    Rows whose identifier is null stay only if their whole group has none.
    """
    rid, digest = (next(n for n in (f"{c}{'_' * k}" for k in range(1, 99)) if n not in docs.columns) for c in ("rid", "digest"))
    kept = (exact_groups(docs, id_col, text_col, keep).where("kept")
            .select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(rid), F.col("text_sha256").alias(digest)).distinct())
    named = (docs.withColumn(rid, F.coalesce(F.col(id_col).cast("bigint").cast("string"), F.lit("")))
             .withColumn(digest, F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256)))
    return named.join(kept, [rid, digest], "left_semi").dropDuplicates([rid, digest]).select(*docs.columns)
