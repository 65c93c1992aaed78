"""Exact interpolated quantiles of many columns at any table size.

Small inputs use Spark's exact ``percentile``, which keeps every distinct value
of a column in one task. Beyond a size limit that task would grow with the data,
so larger inputs close in on the wanted ranks instead: each pass asks the
mergeable percentile sketch for a bracket around every rank and counts what lies
below it; when a bracket holds few enough rows its values are counted and ranked.
Both ways give the same numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column
from riskloom.functions.text import name, number

DIRECT_VALUES = 5_000_000
"""Rows times columns that may meet in one task."""
SKETCH = 2_000
COLUMN_BLOCK = 50


@dataclass
class _Search:
    """The value at one rank of one column, known to lie strictly between two bounds."""

    column: str
    rank: int
    rows: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    answer: float | None = None

    def held(self):
        c = as_column(self.column).cast("double")
        test = c.isNotNull()
        if self.low is not None:
            test = test & (c > self.low)
        if self.high is not None:
            test = test & (c < self.high)
        return F.when(test, c)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], points: Sequence[float], direct_rows: int | None = None
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column; nulls are skipped, an empty column gives None."""
    columns, found = list(columns), {}
    for start in range(0, len(columns), COLUMN_BLOCK):
        block = columns[start:start + COLUMN_BLOCK]
        limit = direct_rows if direct_rows is not None else DIRECT_VALUES // len(block)
        found.update(_block(df, block, list(points), limit))
    return found


def _block(df, columns, points, direct_rows):
    counted = df.selectExpr(*[f"count({name(c)}) AS n{i}" for i, c in enumerate(columns)]).first()
    counts = {c: counted[f"n{i}"] for i, c in enumerate(columns)}
    if max(counts.values()) <= direct_rows:
        wanted = f"array({', '.join(number(p) for p in points)})"
        row = df.selectExpr(*[f"percentile(CAST({name(c)} AS DOUBLE), {wanted}) AS q{i}" for i, c in enumerate(columns)]).first()
        return {c: list(row[f"q{i}"] or [None] * len(points)) for i, c in enumerate(columns)}

    searches: dict[tuple[str, int], _Search] = {}
    for c in columns:
        for p in points:
            place = (counts[c] - 1) * p
            for rank in (math.floor(place), math.ceil(place)):
                if counts[c]:
                    searches.setdefault((c, rank), _Search(c, rank, counts[c]))
    while True:
        wide = [s for s in searches.values() if s.answer is None and s.rows > direct_rows]
        if not wide:
            break
        _narrow(df, wide)
    _finish(df, [s for s in searches.values() if s.answer is None])
    out: dict[str, list[float | None]] = {}
    for c in columns:
        out[c] = []
        for p in points:
            if not counts[c]:
                out[c].append(None)
                continue
            place = (counts[c] - 1) * p
            low, high = searches[(c, math.floor(place))].answer, searches[(c, math.ceil(place))].answer
            out[c].append(low + (high - low) * (place - math.floor(place)))
    return out


def _narrow(df: DataFrame, searches: list[_Search]) -> None:
    """Two aggregates: sketch two values around the rank, then count exactly.

    The rank falls on one of the two values, which ends the search, or strictly
    between them, which leaves a few thousandths of the rows.
    """
    groups = _same_bounds(searches)
    held = df.select(*[together[0].held().alias(f"h{i}") for i, together in enumerate(groups)])  # before the aggregates, which would interpret it
    runs = [_adjacent(together) for together in groups]
    row = held.agg(*[F.percentile_approx(f"h{i}", [edge for run in group for edge in _edges(run)], SKETCH) for i, group in enumerate(runs)]).first()
    tallies = _tallies(held, [list(row[i]) for i in range(len(groups))])
    for i, group in enumerate(runs):
        for j, run in enumerate(group):
            low, high = row[i][2 * j:2 * j + 2]
            counts = tallies[i](low, high)
            for s in run:
                _move(s, low, high, *counts)


def _place(value: float) -> tuple[bool, float]:
    """Order as in Spark: NaN is one value, above all others."""
    return (True, 0.0) if value != value else (False, value)


def _tallies(held: DataFrame, edges: list[list[float]]) -> list[Callable[[float, float], tuple[int, int, int, int]]]:
    """Per column: how many values lie below, on, between and on two of its edges.

    Values come one to a row, and their place among the edges of their column is counted: the edges below a value and
    those not above it, which is one number for each edge and each gap. So there are few counts, whatever the columns.
    """
    edges = [sorted(e, key=_place) for e in edges]
    width = max(map(len, edges))
    at = [F.array(*[F.lit(e[min(k, len(e) - 1)]) for e in edges])[F.col("i")] for k in range(width)]  # the last edge may stand several times
    code = reduce(add, [(e < F.col("v")).cast("int") + (e <= F.col("v")).cast("int") for e in at])
    long = held.select(F.posexplode(F.array(*map(as_column, held.columns))).alias("i", "v")).where("v IS NOT NULL")
    found: list[dict[int, int]] = [{} for _ in edges]
    for r in long.groupBy("i", code.alias("code")).count().collect():
        found[r["i"]][r["code"]] = r["count"]

    def tally(counts: dict[int, int], own: list[float]):
        own = [_place(e) for e in own] + [_place(own[-1])] * (width - len(own))

        def between(low: float, high: float) -> tuple[int, int, int, int]:
            a, b = (sum((e < _place(x)) + (e <= _place(x)) for e in own) for x in (low, high))
            inside = lambda first, end: sum(n for c, n in counts.items() if first <= c < end)
            return inside(0, a), counts.get(a, 0), inside(a + 1, b), counts.get(b, 0) if b > a else 0

        return between

    return [tally(*pair) for pair in zip(found, edges)]


def _same_bounds(searches: list[_Search]) -> list[list[_Search]]:
    """Searches among the same rows, which need one sketch or one list of values."""
    held: dict[tuple, list[_Search]] = {}
    for s in searches:
        held.setdefault((s.column, s.low, s.high), []).append(s)
    return list(held.values())


def _adjacent(searches: list[_Search]) -> list[list[_Search]]:
    """Runs of neighbouring ranks, which one bracket serves."""
    runs: list[list[_Search]] = []
    for s in sorted(searches, key=lambda s: s.rank):
        if runs and s.rank - runs[-1][-1].rank == 1:
            runs[-1].append(s)
        else:
            runs.append([s])
    return runs


def _edges(run: list[_Search]) -> list[float]:
    """Shares of the rows still held, a little below and above the ranks of a run."""
    margin = 2.0 / SKETCH
    at = [(s.rank - s.below + 0.5) / s.rows for s in (run[0], run[-1])]
    return [max(0.0, at[0] - margin), min(1.0, at[1] + margin)]


def _move(s: _Search, low: float, high: float, under: int, on_low: int, between: int, on_high: int) -> None:
    """Ends a search whose rank falls on an edge, and sets the bounds of any other."""
    place, first = s.rank - s.below, under + on_low
    if place < under:
        s.high, s.rows = low, under
    elif place < first:
        s.answer = low
    elif place < first + between:
        s.low, s.high, s.below, s.rows = low, high, s.below + first, between
    elif place < first + between + on_high:
        s.answer = high
    else:
        taken = first + between + on_high
        s.low, s.below, s.rows = high, s.below + taken, s.rows - taken


def _finish(df: DataFrame, searches: list[_Search]) -> None:
    """Count and rank the few values left inside each open bracket."""
    if not searches:
        return
    groups = _same_bounds(searches)
    entries = []
    for i, together in enumerate(groups):
        c = together[0].held()
        entries.append(F.when(c.isNotNull(), F.struct(F.lit(i).alias("i"), c.alias("v"))))
    held = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.i", "e.v")
    tally = held.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = tally.withColumn("end", F.sum("n").over(upto))
    inside = lambda s: (F.col("end") > s.rank - s.below) & (F.col("end") - F.col("n") <= s.rank - s.below)
    hits = [(F.col("i") == i) & reduce(or_, map(inside, together)) for i, together in enumerate(groups)]
    for r in ranked.where(reduce(or_, hits)).collect():
        for s in groups[r["i"]]:
            if r["end"] - r["n"] <= s.rank - s.below < r["end"]:
                s.answer = r["v"]
