"""Which column sets identify a row: all minimal unique column combinations of a table.

Level by level, from single columns up. A set is looked at in the data only if nothing known decides it:

* it holds a smaller unique set: unique, but not minimal, so it is left out;
* the distinct counts of its columns multiply to less than the rows: it cannot be unique;
* it lies within an agree set: two rows seen to agree in these columns. Every set found not to be unique gives such a pair of rows, and the columns in
  which they agree are often many more than the set.

A look counts the set's keys, combined before the shuffle: first those of one slice in 64, where a set with many repeats shows one, then, if none
does, all of them. The driver holds column names and the agree sets, and of a witness the hash of its key and the columns in which its rows agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations
from math import prod

from pyspark.sql import DataFrame, functions as F

from lakestrata.operators.duplicates import duplicate_summary

SCHEMA = "key_columns string, width int"
SLICES = 64  # a set is first asked in this part of its keys


def minimal_keys(df: DataFrame, columns: Sequence[str] | None = None, max_width: int | None = None) -> DataFrame:
    """``key_columns, width`` of every minimal unique set of at most ``max_width`` columns, comma-joined in the order given. NULL is a value.

    An empty table has the empty set as its only minimal key, which identifies its rows as well as any other: it is returned as '' of width 0, as
    for a table of one row. A table with two equal rows has none. ``df`` is read once per look, so it should be a table rather than a long plan.
    """
    return df.sparkSession.createDataFrame([(",".join(key), len(key)) for key in search(df, list(columns or df.columns), max_width)], SCHEMA)


def search(df: DataFrame, columns: list[str], max_width: int | None = None, looks: list | None = None) -> list[tuple[str, ...]]:
    """The minimal unique sets; ``looks`` collects the sets that the data were asked about."""
    rows, distinct = _counts(df, columns)
    if rows <= 1:
        return [()]
    looks = [] if looks is None else looks
    found: list[tuple[str, ...]] = [(c,) for c in columns if distinct[c] == rows]
    agree: list[frozenset[str]] = []
    rest = [c for c in columns if distinct[c] < rows]
    for width in range(2, min(max_width or len(rest), len(rest)) + 1):
        open_sets = 0
        for key in combinations(rest, width):
            if any(set(smaller) <= set(key) for smaller in found):
                continue
            open_sets += 1
            if prod(distinct[c] for c in key) < rows or any(set(key) <= same for same in agree):
                continue
            looks.append(key)
            witness = _agreeing(df, key, columns)
            if witness is None:
                found.append(key)
            else:
                agree = [same for same in agree if not same <= witness] + [witness]
        if not open_sets or frozenset(columns) in agree:
            break
    return found


def _counts(df: DataFrame, columns: list[str]) -> tuple[int, dict[str, int]]:
    """Rows, and distinct values (NULL one of them) of each column."""
    distinct, rows = {}, 0
    for c in columns:
        one = duplicate_summary(df.select(c), [c]).first()
        rows, distinct[c] = one["records"], one["unique_keys"]
    return rows, distinct


def _repeated(df: DataFrame, key: Sequence[str]) -> int | None:
    """The hash of some key that occurs twice; only keys and counts are shuffled."""
    one = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.xxhash64(*key).alias("h")).first()
    return None if one is None else one["h"]


def _agreeing(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> frozenset[str] | None:
    """The columns in which some two rows with the same key agree, or None if there are no such rows.

    A slice of the keys, with all rows of each, is asked first: one repeated there already is the answer. Only if there is none are all keys counted.
    The rows of the one key that was found are then picked by its hash, so that whole rows of other keys are in no exchange.
    """
    code = F.xxhash64(*key)
    found = _repeated(df.filter(F.pmod(code, F.lit(SLICES)) == 0), key)
    found = _repeated(df, key) if found is None else found
    if found is None:
        return None
    every = F.struct(*[F.col(c) for c in columns])
    repeated = (df.filter(code == found).groupBy(*key)
                .agg(F.count(F.lit(1)).alias("_n"), F.min(every).alias("_low"), F.max(every).alias("_high")).filter("_n > 1"))
    same = [F.col("_low")[c].eqNullSafe(F.col("_high")[c]) for c in columns]
    one = repeated.select(*[s.alias(f"s{i}") for i, s in enumerate(same)]).first()
    return frozenset(c for c, s in zip(columns, one) if s)
