"""Runs (maximal periodic stretches of words) by a harmonic grid of longest common extensions over a difference cover.

A run is a stretch of consecutive words with smallest period q - words q apart are equal - of at least max(``least``, ``times`` * q) words that no
neighbouring word extends. Words are ``[^\\x20\\x09-\\x0D]+``.

The words of a block of documents become numbers in one row, with a number of its own after each document, which nothing crosses.

* Difference cover: ``COVER`` modulo ``MODULUS`` holds two members of every difference, so for any places i, j some shift below ``MODULUS`` brings
  both into it. Only suffixes that start at covered places are sorted: first by ``MODULUS`` words, then by doubling, which stays in the cover. The
  longest common prefixes of neighbours get a sparse table of range minima. The longest common extension (LCE) of any two places then takes less than
  ``MODULUS`` word comparisons and one range minimum.
* Harmonic grid: for each period q the places 0, q, 2q, ... are looked at, n ln n in all. A run of period q holds ``times`` or more of them in a row, with
  equal words; only such places are extended, by LCE forwards and, over the reversed row, backwards. Of the stretches found with the same ends the
  smallest period is the run's.

Documents are independent, so nothing is shuffled. Memory and time follow a block's words (n ln n); one document longer than a block is a block.

Defined results: null, empty and wordless texts have no runs and an empty text; rows are taken each for itself, whatever their identifiers; other
columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import blocks, prepare, texts

# A perfect difference set.
MODULUS, COVER = 13, (0, 1, 3, 9)
AT_ONCE = 1 << 20   # places extended at once

RUN = "struct<start:long,length:long,period:long>"


def _shifts() -> np.ndarray:
    """[a, b]: the smallest shift that brings places with these remainders into the cover."""
    out = np.zeros((MODULUS, MODULUS), np.int64)
    for a in range(MODULUS):
        for b in range(MODULUS):
            out[a, b] = next(s for s in range(MODULUS) if (a + s) % MODULUS in COVER and (b + s) % MODULUS in COVER)
    return out


SHIFT = _shifts()


class Extensions:
    """Longest common extensions to the right between places of a row of positive numbers."""

    def __init__(self, row: np.ndarray):
        self.n = len(row)
        self.row = np.concatenate((row, np.zeros(2 * MODULUS, np.int64)))
        places = np.flatnonzero(np.isin(np.arange(self.n) % MODULUS, COVER))
        self.slot = np.full(self.n + 1, -1, np.int64)  # of a covered place; beyond the row there is none
        self.slot[places] = np.arange(len(places))

        rank = self._dense([self.row[places + k] for k in range(MODULUS)])
        levels, reach = [rank], MODULUS
        while len(places) and rank.max() + 1 < len(places):
            rank = self._dense([rank, self._rank_at(rank, places + reach)])
            levels.append(rank)
            reach *= 2
        order = np.argsort(rank, kind="stable")
        self.rank = np.empty(len(places), np.int64)
        self.rank[order] = np.arange(len(places))
        self.table = self._minima(self._neighbours(places[order], levels))

    @staticmethod
    def _dense(keys: list[np.ndarray]) -> np.ndarray:
        """Rank of each row of keys, from 0, equal rows alike."""
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), np.int64)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _rank_at(self, rank: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Ranks at covered places, -1 beyond the row."""
        out = np.full(len(places), -1, np.int64)
        inside = places < self.n
        out[inside] = rank[self.slot[places[inside]]]
        return out

    def _same(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words agree from places a and b on, up to ``most`` (``MODULUS`` at the utmost)."""
        length = np.zeros(len(a), np.int64)
        active = np.flatnonzero(most > 0)
        while len(active):
            k = length[active]
            x, y = self.row[a[active] + k], self.row[b[active] + k]
            active = active[(x == y) & (x > 0)]
            length[active] += 1
            active = active[length[active] < most[active]]
        return length

    def _neighbours(self, sorted_places: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Longest common prefix of each sorted suffix with the one before it."""
        a, b = sorted_places[:-1].copy(), sorted_places[1:].copy()
        length = np.zeros(len(a), np.int64)
        for k in reversed(range(len(levels))):
            inside = np.flatnonzero((a < self.n) & (b < self.n))
            equal = inside[levels[k][self.slot[a[inside]]] == levels[k][self.slot[b[inside]]]]
            step = MODULUS << k
            # Equal ranks at the row's end cover its padding, which is no word; two places never reach the end together.
            a[equal] += step
            b[equal] += step
            length[equal] += step
        inside = np.flatnonzero((a < self.n) & (b < self.n))
        length[inside] += self._same(a[inside], b[inside], np.full(len(inside), MODULUS))
        return length

    @staticmethod
    def _minima(values: np.ndarray) -> list[np.ndarray]:
        table, width = [values], 1
        while 2 * width <= len(values):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from places a and b on; a < b < n + 1."""
        shift = SHIFT[a % MODULUS, b % MODULUS]
        length = self._same(a, b, shift)
        go_on = np.flatnonzero((length == shift) & (b + shift < self.n))
        x, y = self.rank[self.slot[a[go_on] + shift[go_on]]], self.rank[self.slot[b[go_on] + shift[go_on]]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            length[go_on[at]] += np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << k)])
        return length


def grid_places(row: np.ndarray, longest: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """``place, period``: grid places that begin ``times`` equal words one period apart."""
    places, periods = [], []
    for q in range(1, longest // times + 1):
        own = row[::q]
        equal = own[1:] == own[:-1]
        if times > 1 and not equal.any():
            continue
        streak = equal
        for k in range(1, times - 1):
            streak = streak[:-1] & equal[k:]
        at = np.flatnonzero(streak)
        if len(at):
            places.append(at * q)
            periods.append(np.full(len(at), q))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def runs(row: np.ndarray, longest: int, least: int, times: int) -> np.ndarray:
    """``start, length, period`` of every run of the row, whose documents have at most ``longest`` words, by start, then period."""
    place, period = grid_places(row, longest, times)
    found = [np.zeros((0, 3), np.int64)]
    if len(place):
        ahead, back, n = Extensions(row), Extensions(row[::-1].copy()), len(row)
        for low in range(0, len(place), AT_ONCE):
            a, q = place[low:low + AT_ONCE], period[low:low + AT_ONCE]
            # Backwards the words before a are compared with those before a + q; at the row's start there are none.
            before = back.of(n - a - q, n - a)
            start = a - before
            length = before + q + ahead.of(a, a + q)
            enough = length >= np.maximum(least, times * q)
            found.append(np.unique(np.stack([start[enough], length[enough], q[enough]], axis=1), axis=0))
    every = np.unique(np.concatenate(found), axis=0)
    same = np.zeros(len(every), bool)
    same[1:] = (every[1:, :2] == every[:-1, :2]).all(axis=1)
    every = every[~same]  # sorted, so the smallest period of a stretch stays
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def numbered(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all lists as numbers from 1 in one row, a number of its own after each list; and where each list starts."""
    names: dict[bytes, int] = {}
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    first = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    is_word = np.ones(int(sizes.sum()) + len(lists), bool)
    is_word[first + sizes] = False
    row = np.empty(len(is_word), np.int64)
    row[is_word] = np.fromiter((names.setdefault(w, len(names) + 1) for words in lists for w in words), np.int64, int(sizes.sum()))
    row[~is_word] = np.arange(len(lists)) + len(names) + 1
    return row, first


def block_runs(lists: list[list[bytes]], least: int, times: int) -> list[np.ndarray]:
    """The runs of each list of words, places counted from its own start. Lists without a place to extend are not sorted."""
    out = [np.zeros((0, 3), np.int64)] * len(lists)
    longest = max(map(len, lists), default=0)
    if longest < max(least, times):
        return out
    row, first = numbered(lists)
    hit = np.unique(np.searchsorted(first, grid_places(row, longest, times)[0], side="right") - 1).tolist()
    if not hit:
        return out
    row, first = numbered([lists[k] for k in hit])
    found = runs(row, longest, least, times)
    owner = np.searchsorted(first, found[:, 0], side="right") - 1
    found[:, 0] -= first[owner]
    cuts = np.searchsorted(owner, np.arange(len(hit) + 1))
    for k, a, b in zip(hit, cuts[:-1], cuts[1:]):
        out[k] = found[a:b]
    return out


def kept_words(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words without those that a run repeats after its first period."""
    if not len(found):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, found[:, 0] + found[:, 2], 1)
    np.add.at(depth, found[:, 0] + found[:, 1], -1)
    keep = np.cumsum(depth[:-1]) == 0
    return [words[k] for k in np.flatnonzero(keep).tolist()]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, times: int = 4,
                  change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_words, runs, collapsed``.

    ``runs`` are ordered by start, then period; ``collapsed`` is the text of the words that no run repeats after its first period, joined by one space.
    ``change`` may replace a document's words before (a function of its identifier and words).
    """
    if times < 2:
        raise ValueError("times must be 2 at least")
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        for batch in (b for part in batches for b in blocks([part], "text", 4 << 20)):
            lists = [t.split() for t in texts(batch, "text")]
            if change:
                lists = [change(i, words) for i, words in zip(batch.column("doc_id").to_pylist(), lists)]
            found = block_runs(lists, least, times)
            every = np.concatenate(found)
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            fields = pa.StructArray.from_arrays([pa.array(every[:, k]) for k in range(3)], ["start", "length", "period"])
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_words": pa.array([len(x) for x in lists], pa.int64()),
                "runs": pa.ListArray.from_arrays(pa.array(offsets), fields),
                "collapsed": pa.array([b" ".join(kept_words(w, f)) for w, f in zip(lists, found)], pa.binary())})

    return (narrow.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed binary")
            .withColumn("collapsed", F.col("collapsed").cast("string")))


def digests(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one, and digests of all runs and of the collapsed text."""
    best = F.expr("""aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>),
                     (a, x) -> if(a is null or x.length > a.length, x, a))""")  # by start, then period: the first of equals stays
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256")))
