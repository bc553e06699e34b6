"""Silver: filter, deduplicate and standardise Bronze rows."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.functions.text import title_trim, trimmed_or
from lakestrata.functions.time import month_of
from lakestrata.operators.dedupe import keep_one
from lakestrata.operators.lineage import rename_lineage, stamp
from lakestrata.operators.upsert import upsert
from lakestrata.plans.presets import EventRules
from lakestrata.session import materialize


def is_valid_event(rules: EventRules, until: dt.date | None = None) -> Column:
    """The row filter of the cleaner. The quality suite counts what to expect with the same filter.

    A comparison with NULL is not true, so rows lacking a checked measure are dropped too.
    """
    last = F.current_date() if until is None else F.lit(until)
    start = F.col(rules.start)
    tests = [F.col(c).isNotNull() for c in rules.required]
    tests.append(F.col(rules.end) >= start)
    tests += [F.col(c) >= 0 for c in rules.non_negative]
    tests += [F.col(c) > 0 for c in rules.positive]
    tests.append(start >= F.lit(rules.first_day).cast("timestamp_ntz"))
    tests.append(start <= last.cast("timestamp_ntz"))
    tests.append(month_of(start) == F.col(rules.month_column))
    # Follows from the three tests before it; said again so that a table partitioned by month is pruned.
    tests.append(F.col(rules.month_column).between(rules.first_day[:7], month_of(last.cast("timestamp_ntz"))))
    return reduce(lambda a, b: a & b, tests)


def clean_events(bronze: DataFrame, rules: EventRules, until: dt.date | None = None,
                 at: dt.datetime | None = None) -> DataFrame:
    """Valid rows, one per key (the latest loaded), gaps filled, lineage renamed.

    The filter stands before the dedupe, so it reaches the scan and fewer rows are shuffled.
    """
    rows = keep_one(bronze.filter(is_valid_event(rules, until)), rules.key, rules.latest_by)
    filled = {c: trimmed_or(F.col(c), v) for c, v in rules.trimmed_defaults.items()}
    filled |= {c: F.coalesce(F.col(c), F.lit(v)) for c, v in rules.defaults.items()}
    return stamp(rename_lineage(rows.withColumns(filled), "bronze"), "silver", at)


def clean_reference(bronze: DataFrame, id_column: str, titled: dict[str, str], trimmed: dict[str, str],
                    id_name: str, at: dt.datetime | None = None) -> DataFrame:
    """One row per numeric id; text trimmed, some of it in title case. Ids that are no number are dropped.

    ``titled`` and ``trimmed`` map source column to Silver column.
    """
    rows = bronze.select(
        F.col(id_column).try_cast("int").alias(id_name),
        *[title_trim(F.col(c)).alias(n) for c, n in titled.items()],
        *[F.trim(c).alias(n) for c, n in trimmed.items()],
        "bronze_ingestion_timestamp", "bronze_ingestion_date")
    rows = keep_one(rows.filter(F.col(id_name).isNotNull()), [id_name])
    return stamp(rows, "silver", at)


def clean_series(bronze: DataFrame, time_column: str, latest_by: str = "bronze_ingestion_timestamp",
                 at: dt.datetime | None = None) -> DataFrame:
    """One row per time, the latest loaded; rows without a time are dropped."""
    rows = keep_one(bronze.filter(F.col(time_column).isNotNull()), [time_column], [latest_by])
    return stamp(rename_lineage(rows, "bronze", ("source_file",)), "silver", at)


def refresh(target: DataFrame, cleaned: DataFrame, keys: list[str], update: list[str] | None = None,
            null_safe: bool = True) -> DataFrame:
    """Upsert freshly cleaned rows (already one per key) into a Silver table.

    The rows are written first: they are used three times, and their real size decides the join.
    """
    return upsert(target, materialize(cleaned, "cleaned"), keys, null_safe=null_safe, update=update, check_source=False)
