"""Entity roll-up: one row per key from a history table.

A roll-up plan holds overall statistics, recency windows, value splits, value
shares, last-N statistics and distinct counts. It is executed in two levels:

1. *cells* - the history is grouped by (key, recency bucket, split value) with a
   few sums, counts and extremes per cell. The buffers are narrow and combine
   before the shuffle, so a key that owns a large part of the table becomes a
   handful of cell rows instead of one overloaded task.
2. the cells, the latest rows of each key (at most N, cut down before the
   shuffle by Spark's window group limit) and the distinct counts are brought
   together once by key, and every output column is a conditional combination
   of those few rows.

Where tasks hold too few rows of a key for cells and newest rows to be fewer than
rows, and no key has very many, the rows themselves travel by key once; they are
numbered there, and become cells there if that leaves fewer. Columns that a history
derives row by row (``derive``) are made after that trip.

Nothing is joined back: all windows, splits and last-N blocks of a table come
out of the same final grouping, already partitioned by key for the merge.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column
from riskloom.functions.text import name as _name, text as _text
from riskloom.session import DENSE, check_distinct_names, settle

STATS = ("rows", "count", "sum", "mean", "min", "max", "matches", "share", "approx_distinct")
OTHER = "__other__"
#: Logarithm of the registers of a distinct-count sketch; the relative standard error is 1.04 / sqrt(2**12), or 1.6 %.
SKETCH_BITS = 12
#: Rows of one key, and its part of all rows, that may meet in one task without being combined first.
MOST_ROWS, MOST_SHARE = 100_000, 1 / 16
#: Lots of keys for each time that the rows could hold a key with the most rows, so that a lot of other keys has far fewer.
LOTS = 8


@dataclass(frozen=True)
class Stat:
    """One statistic. ``value`` is used by ``matches`` and ``share`` only.

    ``approx_distinct`` counts distinct values, null as one of them, by sketches that merge over cells, windows and
    last-N blocks; ``Rollup.distinct`` counts exactly, over all rows of a key.
    """

    kind: str
    column: str | None = None
    value: str | None = None
    name: str | None = None

    def __post_init__(self):
        if self.kind not in STATS:
            raise ValueError(f"unknown statistic {self.kind!r}; known: {STATS}")

    @property
    def label(self) -> str:
        return self.name or f"{self.column}_{self.kind}"


def stats(kind: str, columns: Sequence[str]) -> tuple[Stat, ...]:
    return tuple(Stat(kind, c) for c in columns)


@dataclass(frozen=True)
class Recency:
    """Nested windows ``order >= -span``; rows without an order value are in none."""

    order: str
    spans: tuple[int, ...]
    unit: str
    stats: tuple[Stat, ...] = ()
    trends: tuple[str, ...] = ()
    shares: dict[int, tuple[Stat, ...]] = field(default_factory=dict)


@dataclass(frozen=True)
class Split:
    """Statistics of the rows where ``column`` equals one value."""

    column: str
    value: str
    label: str
    stats: tuple[Stat, ...]


@dataclass(frozen=True)
class Latest:
    """Statistics of the newest N rows. Rows without an order value belong to every N."""

    order: str
    sizes: tuple[int, ...]
    stats: tuple[Stat, ...]
    ties: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rollup:
    key: str
    overall: tuple[Stat, ...]
    recency: Recency | None = None
    splits: tuple[Split, ...] = ()
    latest: Latest | None = None
    distinct: tuple[str, ...] = ()
    prefix: str = ""


def share_stats(column: str, categories: Sequence[str], label: str | None = None) -> tuple[Stat, ...]:
    """Share of each category among the non-null values of ``column``."""
    return tuple(
        Stat("share", column, value=c, name=f"{label or column}_{c}_prop") for c in sorted(categories, key=str)
    )


def _all_stats(plan: Rollup) -> list[Stat]:
    found = list(plan.overall)
    if plan.recency:
        found += list(plan.recency.stats)
        for block in plan.recency.shares.values():
            found += list(block)
    for split in plan.splits:
        found += list(split.stats)
    return found


def _dimensions(plan: Rollup) -> dict[str, list[str]]:
    """Columns whose values separate cells, with the values that matter."""
    wanted: dict[str, set[str]] = {}
    for stat in _all_stats(plan) + (list(plan.latest.stats) if plan.latest else []):
        if stat.kind in ("matches", "share"):
            wanted.setdefault(stat.column, set()).add(stat.value)
    for split in plan.splits:
        wanted.setdefault(split.column, set()).add(split.value)
    return {column: sorted(values, key=str) for column, values in wanted.items()}


def _partials(found: Sequence[Stat]) -> dict[str, tuple[str, str]]:
    """Partial column name -> (kind, source column)."""
    needed: dict[str, tuple[str, str]] = {}
    for stat in found:
        if stat.kind in ("sum", "mean"):
            needed[f"s_{stat.column}"] = ("sum", stat.column)
        if stat.kind == "approx_distinct":
            needed[f"h_{stat.column}"] = ("sketch", stat.column)
        if stat.kind in ("count", "mean", "approx_distinct"):
            needed[f"n_{stat.column}"] = ("count", stat.column)
        if stat.kind == "max":
            needed[f"hi_{stat.column}"] = ("max", stat.column)
        if stat.kind == "min":
            needed[f"lo_{stat.column}"] = ("min", stat.column)
    return needed


def _span_index(recency: Recency) -> Column:
    """Index of the tightest window holding the row; beyond the last one otherwise."""
    order, spans = as_column(recency.order), sorted(recency.spans)
    index = F.when(order.isNull(), F.lit(len(spans)))
    for i, span in enumerate(spans):
        index = index.when(order >= -span, F.lit(i))
    return index.otherwise(F.lit(len(spans)))


def _tag(column: str, values: Sequence[str]) -> Column:
    """The value if it matters to the plan, one shared tag for all others, null for null."""
    text = as_column(column).cast("string")
    return F.when(text.isin([str(v) for v in values]), text).when(text.isNotNull(), F.lit(OTHER))


def _measures(partials) -> list[Column]:
    sketch = lambda c: F.hll_sketch_agg(c.cast("string"), SKETCH_BITS)
    combine = {"sum": lambda c: F.sum(c.cast("double")), "count": F.count, "max": F.max, "min": F.min, "sketch": sketch}
    return [F.count(F.lit(1)).alias("rows"), *[combine[kind](as_column(column)).alias(name) for name, (kind, column) in partials.items()]]


def _cell_rows(df: DataFrame, plan: Rollup, partials, dims) -> DataFrame:
    keys = [as_column(plan.key)]
    keys.append((_span_index(plan.recency) if plan.recency else F.lit(0)).alias("__span"))
    undated = as_column(plan.latest.order).isNull() if plan.latest else F.lit(False)
    keys.append(undated.alias("__undated"))
    for i, (column, values) in enumerate(dims.items()):
        keys.append(_tag(column, values).alias(f"__dim{i}"))
    return df.groupBy(*keys).agg(*_measures(partials)).withColumn("__rank", F.lit(None).cast("int"))


def latest_rows(df: DataFrame, key: str, order: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The newest ``n`` dated rows of each key and all its undated rows, in no particular order."""
    ranking = Window.partitionBy(as_column(key)).orderBy(as_column(order).desc(), *[as_column(t).asc() for t in ties])
    dated = df.where(as_column(order).isNotNull()).withColumn("__rank", F.row_number().over(ranking))
    return dated.where(F.col("__rank") <= n).drop("__rank").unionByName(df.where(as_column(order).isNull()))


#: A single row as the partial of its own cell.
_SINGLE = {
    "sum": lambda c: c.cast("double"),
    "count": lambda c: c.isNotNull().cast("long"),
    "max": lambda c: c,
    "min": lambda c: c,
}


def _newest_first(latest: Latest, key: str):
    return Window.partitionBy(as_column(key)).orderBy(as_column(latest.order).desc(), *[as_column(t).asc() for t in latest.ties])


def _latest_rows(df: DataFrame, plan: Rollup, partials, dims) -> DataFrame:
    latest, key = plan.latest, as_column(plan.key)
    newest = (
        df.where(as_column(latest.order).isNotNull())
        .withColumn("__rank", F.row_number().over(_newest_first(latest, plan.key)))
        .where(F.col("__rank") <= max(latest.sizes))
    )
    tags = [_tag(c, v).alias(f"__dim{i}") for i, (c, v) in enumerate(dims.items())]
    return newest.select(
        key,
        F.lit(None).cast("int").alias("__span"),
        F.lit(False).alias("__undated"),
        *tags,
        F.lit(1).cast("long").alias("rows"),
        *[_SINGLE[kind](as_column(column)).alias(name) for name, (kind, column) in partials.items() if kind != "sketch"],
        # single values, to be sketched where they are chosen
        *[as_column(column).cast("string").alias(f"v_{column}") for kind, column in partials.values() if kind == "sketch"],
        "__rank",
    )


def _single_rows(df: DataFrame, plan: Rollup, partials, dims, derive, fewer: bool) -> DataFrame:
    """Every row as a cell of its own, partitioned by key; dated rows have their rank among the newest.

    With ``fewer`` only the newest rows are, and older ones that agree in span and values share a cell.
    """
    latest = plan.latest
    rows = derive(df.repartition(as_column(plan.key))).select(*map(as_column, _columns_of(plan)))
    if latest:
        rows = rows.withColumn("__place", F.row_number().over(_newest_first(latest, plan.key)))
        dated, place = as_column(latest.order).isNotNull(), F.col("__place")
    else:
        dated, place = F.lit(False), F.lit(None).cast("int")
    of_cell = [
        as_column(plan.key),
        (_span_index(plan.recency) if plan.recency else F.lit(0)).alias("__span"),
        (~dated).alias("__undated"),
        *[_tag(c, v).alias(f"__dim{i}") for i, (c, v) in enumerate(dims.items())],
    ]
    if fewer:
        ranked = F.when(dated & (place <= (max(latest.sizes) if latest else 0)), place).alias("__rank")
        return rows.groupBy(*of_cell, ranked).agg(*_measures(partials))
    return rows.select(
        *of_cell,
        F.lit(1).cast("long").alias("rows"),
        *[_SINGLE[kind](as_column(column)).alias(name) for name, (kind, column) in partials.items()],
        F.when(dated, place).alias("__rank"),
    )


def _has_hot_key(df: DataFrame, key: str, rows: int) -> bool:
    """True if a key holds too many rows for one task. Rows are counted by lots of keys, then by key in full lots alone."""
    most = min(MOST_ROWS, MOST_SHARE * rows)
    if most < 1:
        return rows > 0
    lot = F.pmod(F.xxhash64(as_column(key)), F.lit(int(LOTS * rows / most) + 1))
    full = [r[0] for r in df.groupBy(lot.alias("lot")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).collect()]
    if not full:
        return False
    counted = df.where(lot.isin(full)).groupBy(as_column(key)).agg(F.count(F.lit(1)).alias("n"))
    return not counted.where(F.col("n") > most).isEmpty()


def _trips(df: DataFrame, plan: Rollup, dims) -> tuple[bool, bool]:
    """Whether rows are to travel as they are, and whether cells would be fewer once they have.

    Before they travel, cells and newest rows are as many as tasks have keys, times the cells of a key. Keys are estimated.
    """
    per_task = df.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(F.xxhash64(as_column(plan.key)), SKETCH_BITS).alias("s"))
    seen = per_task.agg(
        F.sum("n").alias("rows"), F.sum(F.hll_sketch_estimate("s")).alias("held"), F.hll_sketch_estimate(F.hll_union_agg("s")).alias("keys")).first()
    rows = seen["rows"] or 0
    if not rows:
        return True, False
    cells = len(plan.recency.spans) + 1 if plan.recency else 1
    for values in dims.values():
        cells *= len(values) + 2
    newest = max(plan.latest.sizes) if plan.latest else 0
    sent = min(rows, seen["held"] * cells) + min(rows, seen["held"] * newest)
    return rows <= sent and not _has_hot_key(df, plan.key, rows), rows > seen["keys"] * (cells + newest)


def _value(stat: Stat, inside: str | None, dims, always: bool, ranked: bool = False) -> str:
    """A statistic over the cell rows selected by ``inside``, as a SQL expression.

    A roll-up has hundreds of these; one text per column is far quicker to build
    than as many nested column objects. ``always`` marks a selection that holds
    for every existing group; elsewhere sums and counts are null, not 0, when no
    row was selected at all. ``ranked`` marks a selection with newest rows in it.
    """
    def only(term: str) -> str:
        return term if inside is None else f"CASE WHEN {inside} THEN {term} END"

    def total(name: str) -> str:
        return f"sum({only(_name(name))})"

    def where_any(term: str, zero: str = "0") -> str:
        filled = f"coalesce({term}, {zero})"
        return filled if always else f"CASE WHEN {total('rows')} > 0 THEN {filled} END"

    if stat.kind == "rows":
        return where_any(total("rows"))
    if stat.kind == "count":
        return where_any(total(f"n_{stat.column}"))
    if stat.kind == "sum":
        return where_any(total(f"s_{stat.column}"), "0D")
    if stat.kind == "mean":
        return f"try_divide({total(f's_{stat.column}')}, {total(f'n_{stat.column}')})"
    if stat.kind == "approx_distinct":
        merged = f"hll_union_agg({only(_name(f'h_{stat.column}'))})"
        if ranked:
            single = f"hll_sketch_agg({only(_name(f'v_{stat.column}'))}, {SKETCH_BITS})"
            merged = f"coalesce(hll_union({merged}, {single}), {merged}, {single})"
        with_null = f"CASE WHEN {total('rows')} > {total(f'n_{stat.column}')} THEN 1 ELSE 0 END"
        return where_any(f"hll_sketch_estimate({merged}) + {with_null}")
    if stat.kind == "max":
        return f"max({only(_name(f'hi_{stat.column}'))})"
    if stat.kind == "min":
        return f"min({only(_name(f'lo_{stat.column}'))})"
    tag = f"__dim{list(dims).index(stat.column)}"
    hits = f"sum({only(f'CASE WHEN {tag} = {_text(stat.value)} THEN rows END')})"
    if stat.kind == "matches":
        return where_any(hits)
    present = f"sum({only(f'CASE WHEN {tag} IS NOT NULL THEN rows END')})"
    return f"CASE WHEN {present} > 0 THEN coalesce({hits}, 0) / {present} END"


def _columns_of(plan: Rollup) -> list[str]:
    """The columns of a history that a plan reads."""
    wanted = [plan.key, *plan.distinct, *(split.column for split in plan.splits)]
    wanted += [s.column for s in _all_stats(plan) + (list(plan.latest.stats) if plan.latest else []) if s.column]
    wanted += [plan.recency.order] if plan.recency else []
    wanted += [plan.latest.order, *plan.latest.ties] if plan.latest else []
    return list(dict.fromkeys(wanted))


def _is_derived(df: DataFrame) -> bool:
    """True if reading the rows again would repeat a join, a grouping or a window."""
    return bool(re.search(r"\b(Join|Aggregate|Window|Generate)\b", df._jdf.queryExecution().optimizedPlan().toString()))


def roll_up(df: DataFrame, plan: Rollup, derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """One row per key with every column of the plan. ``derive`` adds columns to the history, row by row.

    Cells, newest rows and distinct values each read the history, and so do the counts of rows and keys before them. If
    it is not a plain table its needed columns are written first, so that what it is made of is read and shuffled once.
    """
    dims = _dimensions(plan)
    cell_parts = _partials(_all_stats(plan) + (list(plan.latest.stats) if plan.latest else []))
    plain = not _is_derived(df)
    raw, df = df, derive(df)
    if (plan.latest or plan.distinct) and not plain:
        df = raw = settle(df.select(*map(as_column, _columns_of(plan))), "history", DENSE)
        derive, plain = lambda df: df, True
    wide = plan.latest or plan.distinct or plan.recency or dims
    sketched = any(kind == "sketch" for kind, _ in cell_parts.values())
    single, fewer = _trips(raw, plan, dims) if wide and plain and not sketched else (False, False)
    if single:
        branches = [_single_rows(raw, plan, cell_parts, dims, derive, fewer)]
    else:
        cells = _cell_rows(df, plan, cell_parts, dims)
        # narrow rows travel; the wide aggregate below runs after this exchange
        branches = [cells.repartition(as_column(plan.key)) if wide else cells]
    # newest rows and distinct counts are partitioned by key already, and so is the union: no row travels again
    if plan.latest and not single:
        branches.append(_latest_rows(df, plan, cell_parts, dims))
    for column in plan.distinct:
        # grouping by value first keeps a hot key distributed; null forms its own group and counts
        values = df.groupBy(as_column(plan.key), as_column(column).alias("__value")).agg(F.count(F.lit(1)).alias("n"))
        branches.append(values.groupBy(as_column(plan.key)).agg(F.count(F.lit(1)).alias(f"d_{column}")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)

    cell = "__rank IS NULL" if plan.latest and not single else None
    out = [(s.label, _value(s, cell, dims, always=True)) for s in plan.overall]
    out += [(f"{c}_nunique", f"max({_name(f'd_{c}')})") for c in plan.distinct]
    trends: list[tuple[str, str, str]] = []
    if plan.recency:
        for i, span in enumerate(sorted(plan.recency.spans)):
            inside, tail = f"__span <= {i}", f"{span}{plan.recency.unit}"
            out += [(f"{s.label}_{tail}", _value(s, inside, dims, always=False)) for s in plan.recency.stats]
            out += [(s.label, _value(s, inside, dims, always=False)) for s in plan.recency.shares.get(span, ())]
            trends += [(f"{t}_mean_{tail}", f"{t}_mean", f"{t}_mean_trend_{tail}") for t in plan.recency.trends]
    for split in plan.splits:
        inside = f"__dim{list(dims).index(split.column)} = {_text(split.value)}" + (f" AND {cell}" if cell else "")
        out += [(f"{split.label}_{s.label}", _value(s, inside, dims, always=False)) for s in split.stats]
    if plan.latest:
        for n in sorted(plan.latest.sizes):
            inside = f"(__rank <= {n} OR (__undated AND __rank IS NULL))"  # a row of distinct counts is neither
            out += [(f"LAST_{n}_{s.label}", _value(s, inside, dims, always=False, ranked=True)) for s in plan.latest.stats]

    check_distinct_names(df.sparkSession, [n for n, _ in out])
    grouped = rows.groupBy(as_column(plan.key)).agg(*[F.expr(e).alias(n) for n, e in out])
    final = [f"{_name(plan.key)}"] + [f"{_name(n)} AS {_name(plan.prefix + n)}" for n, _ in out]
    final += [f"{_name(recent)} - {_name(overall)} AS {_name(plan.prefix + n)}" for recent, overall, n in trends]
    return grouped.selectExpr(*final)


def categories(df: DataFrame, column: str, limit: int | None = None) -> list[str]:
    """Distinct non-null values, sorted as text. They become columns; ``limit`` stops a job that would have too many."""
    values = df.select(as_column(column)).where(as_column(column).isNotNull()).distinct()
    found = [r[0] for r in (values if limit is None else values.limit(limit + 1)).collect()]
    if limit is not None and len(found) > limit:
        raise ValueError(f"{column} has more than {limit} categories; it cannot become columns")
    return sorted(found, key=str)


def categories_by_recency(df: DataFrame, column: str, order: str, spans: Sequence[int], limit: int | None = None) -> dict[int | None, list[str]]:
    """Categories over all rows (key ``None``) and inside each window, from one small job.

    A category occurs in a window exactly when its newest row does.
    """
    values = df.where(as_column(column).isNotNull()).groupBy(as_column(column).alias("v")).agg(F.max(as_column(order)).alias("newest"))
    newest = (values if limit is None else values.limit(limit + 1)).collect()
    if limit is not None and len(newest) > limit:
        raise ValueError(f"{column} has more than {limit} categories; it cannot become columns")
    found: dict[int | None, list[str]] = {None: sorted((r["v"] for r in newest), key=str)}
    for span in spans:
        found[span] = sorted((r["v"] for r in newest if r["newest"] is not None and r["newest"] >= -span), key=str)
    return found


def child_means(parent: DataFrame, child_rollup: DataFrame, key: str, child_key: str) -> DataFrame:
    """Unweighted mean, per parent key, of statistics rolled up at the child grain.

    A parent without any child keeps its row, with nulls.
    """
    columns = [c for c in child_rollup.columns if c != child_key]
    linked = parent.select(as_column(key), as_column(child_key)).join(child_rollup, child_key, "left")
    return linked.groupBy(as_column(key)).agg(*[F.avg(as_column(c)).alias(f"{c}_mean") for c in columns])
