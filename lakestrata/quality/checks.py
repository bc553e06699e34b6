"""Checks and the pass that runs them.

All row and table checks of a suite are aggregates of one scan. A uniqueness check groups by its key
(only the key columns are read and counts are combined before the shuffle) instead of adding a
DISTINCT aggregate, which would copy every row once per key. All foreign keys share one more scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.functions.numeric import percentage
from lakestrata.operators.duplicates import duplicate_summary, exact_duplicate_summary
from lakestrata.operators.lookups import orphan_counts
from lakestrata.operators.ranking import label_positions, listed_order
from lakestrata.quality.rules import RuleSet


@dataclass(frozen=True)
class Check:
    name: str
    check_type: str = ""


@dataclass(frozen=True)
class Rows(Check):
    """Counts the rows for which ``failing`` is true. ``null_if_empty``: no count on an empty table."""

    failing: Column | None = None
    expected: str = "0"
    severity: str = ""
    null_if_empty: bool = False


@dataclass(frozen=True)
class Total(Check):
    """``failures`` is an aggregate over the table; ``expected``/``actual`` are shown, ``base`` is the
    denominator of the percentage (default: the rows of the table)."""

    failures: Column | None = None
    expected: Column | str = "0"
    actual: Column | None = None
    base: Column | None = None
    severity: str = ""


@dataclass(frozen=True)
class Unique(Check):
    """Rows minus distinct keys. ``skip_null``: a NULL key is no value, as in COUNT(DISTINCT column)."""

    keys: Sequence[str] = ()
    skip_null: bool = False
    severity: str = ""


@dataclass(frozen=True)
class UniqueRows(Check):
    """Rows minus distinct whole rows."""

    severity: str = ""


@dataclass(frozen=True)
class Reference(Check):
    """Non-NULL values of ``column`` that the dimension lacks."""

    column: str = ""
    dim: DataFrame | None = None
    dim_key: str = ""


@dataclass(frozen=True)
class Other(Check):
    """A one-row DataFrame with ``records`` and ``failures`` computed elsewhere."""

    frame: DataFrame | None = None


@dataclass(frozen=True)
class Volumes(Check):
    """One informational row per value of ``label``: its rows. ``name`` is completed with the value."""

    label: Column | None = None
    first_position: int = 0
    severity: str = "MONTHLY_COUNT"


_LONG = "long"


def _row(position: Column, check: Check, records: Column, failures: Column, expected: Column, actual: Column,
         base: Column | None = None) -> Column:
    return F.struct(
        position.cast("int").alias("check_order"), F.lit(check.name).alias("check_name"),
        F.lit(check.check_type).alias("check_type"), F.lit(getattr(check, "severity", "")).alias("severity"),
        records.cast(_LONG).alias("records_checked"), failures.cast(_LONG).alias("failures"),
        expected.cast("string").alias("expected_value"), actual.cast("string").alias("actual_value"),
        (records if base is None else base).cast(_LONG).alias("pct_base"))


def scan_aggregates(checks: list[tuple[int, Check]]) -> list[Column]:
    """All row checks and totals as aggregates of one pass."""
    aggregates = [F.count(F.lit(1)).alias("records")]
    for i, c in checks:
        if isinstance(c, Rows):
            count = F.count_if(c.failing)
            aggregates.append((F.when(F.count(F.lit(1)) > 0, count) if c.null_if_empty else count).alias(f"f{i}"))
        else:
            aggregates.append(c.failures.alias(f"f{i}"))
            if isinstance(c.expected, Column):
                aggregates.append(c.expected.alias(f"e{i}"))
            if c.actual is not None:
                aggregates.append(c.actual.alias(f"a{i}"))
            if c.base is not None:
                aggregates.append(c.base.alias(f"b{i}"))
    return aggregates


def scan_rows(one_row: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    """One row per check from the row of their aggregates."""
    rows = []
    for i, c in checks:
        failures = F.col(f"f{i}")
        expected = F.col(f"e{i}") if isinstance(c.expected, Column) else F.lit(c.expected)
        actual = F.col(f"a{i}") if isinstance(c, Total) and c.actual is not None else failures
        base = F.col(f"b{i}") if isinstance(c, Total) and c.base is not None else None
        rows.append(_row(F.lit(i), c, F.col("records"), failures, expected, actual, base))
    return one_row.select(F.inline(F.array(*rows)))


def _single(frame: DataFrame, position: int, check: Check, records: str, failures: str) -> DataFrame:
    row = _row(F.lit(position), check, F.col(records), F.col(failures), F.lit("0"), F.col(failures))
    return frame.select(F.inline(F.array(row)))


def _references(df: DataFrame, checks: list[tuple[int, Reference]]) -> DataFrame:
    """All foreign keys in one pass: each count row finds its check by the name of its column."""
    counts = orphan_counts(df, {c.column: (c.dim, c.dim_key) for _, c in checks})
    rows = [F.when(F.col("fk") == c.column, _row(F.lit(i), c, F.col("records_checked"), F.col("orphans"), F.lit("0"),
                                                 F.col("orphans"))) for i, c in checks]
    return counts.select(F.coalesce(*rows).alias("row")).select("row.*")


def _volumes(df: DataFrame, checks: list[Volumes]) -> DataFrame:
    """All label counts in one pass over the table."""
    labels = F.array(*[F.struct(F.lit(i).alias("which"), c.label.alias("label")) for i, c in enumerate(checks)])
    counts = df.select(F.inline(labels)).groupBy("which", "label").agg(F.count(F.lit(1)).alias("records"))
    rows = [F.when(F.col("which") == i, _row(F.col("position"), c, F.col("records"), F.lit(0), F.lit("0"), F.lit("0")))
            for i, c in enumerate(checks)]
    first = F.element_at(F.array(*[F.lit(c.first_position) for c in checks]), F.col("which") + 1)
    ranked = label_positions(counts, "label", "position", first, within=["which"])
    named = ranked.select("label", F.coalesce(*rows).alias("row")).select("label", "row.*")
    return named.withColumn("check_name", F.concat("check_name", F.lit(" ("), "label", F.lit(")"))).drop("label")


def measure(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: order, name, type, severity, records, failures, expected, actual, percentage."""
    return measure_numbered(df, list(enumerate(checks, 1)))


def measure_numbered(df: DataFrame, numbered: list[tuple[int, Check]], first: Sequence[DataFrame] = ()) -> DataFrame:
    """``measure`` for checks with their positions; ``first`` are rows of checks that were measured elsewhere."""
    plain = [(i, c) for i, c in numbered if isinstance(c, Rows | Total)]
    references = [(i, c) for i, c in numbered if isinstance(c, Reference)]
    parts = [*first, *([scan_rows(df.agg(*scan_aggregates(plain)), plain)] if plain else [])]
    for i, c in numbered:
        if isinstance(c, Unique):
            parts.append(_single(duplicate_summary(df.select(*c.keys), c.keys, c.skip_null), i, c,
                                 "records", "duplicates"))
        elif isinstance(c, UniqueRows):
            parts.append(_single(exact_duplicate_summary(df), i, c, "records", "duplicates"))
        elif isinstance(c, Other):
            parts.append(_single(c.frame, i, c, "records", "failures"))
    volumes = [c for _, c in numbered if isinstance(c, Volumes)]
    if volumes:
        parts.append(_volumes(df, volumes))
    if references:
        parts.append(_references(df, references))
    measured = reduce(DataFrame.unionByName, parts)
    return measured.withColumn("failure_pct", percentage(F.col("failures"), F.col("pct_base"))).drop("pct_base")


def run_suite(df: DataFrame, checks: Sequence[Check], rules: RuleSet, table: str = "") -> DataFrame:
    """The measured checks with their status."""
    return with_status(measure(df, checks), rules, table)


def with_status(measured: DataFrame, rules: RuleSet, table: str = "") -> DataFrame:
    status = rules.status(F.col("check_name"), F.col("check_type"), F.col("severity"), F.col("failures"),
                          F.col("failure_pct"))
    return measured.withColumns({"status": status, "table_name": F.lit(table)})


Run = Callable[[DataFrame, Sequence[Check], RuleSet, str], DataFrame]  # run_suite, or what measures the rows on their way into a table


# Report layouts -------------------------------------------------------------------------------------------

_BY_STATUS = ["FAIL", "WARN", "PASS"]


def simple_report(result: DataFrame) -> DataFrame:
    return result.select("check_name", F.col("failures").alias("failed_rows"), "status").orderBy("check_name")


def source_report(result: DataFrame) -> DataFrame:
    """Percentage as text, in check order; the order column itself is not shown."""
    text = F.when(F.col("failure_pct").isNotNull(), F.format_string("%.2f%%", "failure_pct"))
    columns = ["check_name", "check_type", "records_checked", F.col("failures").alias("affected_rows"),
               text.alias("affected_percentage"), "status"]
    return result.select("check_order", *columns).orderBy("check_order").drop("check_order")


def table_report(result: DataFrame, with_actual: bool = False) -> DataFrame:
    """Failed checks first, then warnings."""
    columns = ["table_name", "check_name", "check_type", "records_checked", "failures", "expected_value"]
    columns += ["actual_value"] if with_actual else []
    return (result.select(*columns, "failure_pct", "status")
            .orderBy(listed_order(F.col("status"), _BY_STATUS), "check_type", "check_name"))
