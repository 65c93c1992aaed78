"""Global ranks and running totals without a one-task window.

A window ordered over a whole table, or over one of two classes, would sort
everything in a single task. Here every position is split into an offset, taken
from a small table of counts per range, and a rank inside that range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column

PREFIX = 4
"""Hex digits of the draw that name a range: 65,536 ranges per class."""

RANGE_ROWS = 200_000
MAX_RANGES = 10_000


def draw(key: str | Sequence[str], seed: int) -> Column:
    """A repeatable, uniform draw per key as hex text; the same in any engine with md5."""
    keys = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[as_column(k).cast("string") for k in keys]))


def unit_draw(*parts, seed: int) -> Column:
    """A repeatable number in [0, 1)."""
    return F.pmod(F.xxhash64(*[as_column(p) for p in parts], F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class; the number of classes is small by nature."""
    return {r[0]: r[1] for r in df.groupBy(as_column(label)).count().collect()}


def _with_draw(df: DataFrame, key, seed: int) -> DataFrame:
    return df.withColumn("__draw", draw(key, seed)).withColumn("__range", F.substring("__draw", 1, PREFIX))


def _range_offsets(drawn: DataFrame, label: str) -> DataFrame:
    """Rows before each draw range of a class; at most 65,536 rows per class."""
    before = Window.partitionBy("__class").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return (
        drawn.groupBy(as_column(label).alias("__class"), "__range").agg(F.count(F.lit(1)).alias("__held"))
        .withColumn("__before", F.coalesce(F.sum("__held").over(before), F.lit(0)))
    )


def shuffled_rank(df: DataFrame, label: str, key, seed: int, name: str = "draw_rank") -> DataFrame:
    """1-based position of each row in a repeatable shuffle of its class.

    ``key`` must identify rows, so that the draws spread evenly.
    """
    drawn = _with_draw(df, key, seed)
    offsets = F.broadcast(_range_offsets(drawn, label).drop("__held"))
    keys = [key] if isinstance(key, str) else list(key)
    inside = Window.partitionBy(as_column(label), "__range").orderBy("__draw", *[as_column(k) for k in keys])
    return (
        drawn.withColumn("__inner", F.row_number().over(inside))
        .withColumnRenamed("__range", "__own")
        .join(offsets, as_column(label).eqNullSafe(F.col("__class")) & (F.col("__own") == F.col("__range")))
        .withColumn(name, (F.col("__before") + F.col("__inner")).cast("long"))
        .drop("__inner", "__class", "__range", "__before", "__draw", "__own")
    )


def take_per_class(df: DataFrame, label: str, key, sizes: Mapping, seed: int, inside: str | None = None) -> DataFrame:
    """The first ``sizes[class]`` rows of each class in shuffled order, whole rows kept.

    Only the one draw range per class in which the cut falls is ranked; rows of
    earlier ranges pass, later ones do not. ``inside`` names a boolean column to
    mark membership instead of filtering.
    """
    drawn = _with_draw(df, key, seed)
    wanted = None
    for value, size in sizes.items():
        test = F.col("__class").eqNullSafe(F.lit(value))
        wanted = F.when(test, F.lit(int(size))) if wanted is None else wanted.when(test, F.lit(int(size)))
    cuts = (
        _range_offsets(drawn, label).withColumn("__want", F.coalesce(wanted, F.lit(0)))
        .withColumn(
            "__take",
            F.when(F.col("__before") >= F.col("__want"), 0)
            .when(F.col("__before") + F.col("__held") <= F.col("__want"), F.col("__held"))
            .otherwise(F.col("__want") - F.col("__before")),
        )
        .select("__class", F.col("__range").alias("__cut"), "__held", "__take")
    )
    placed = drawn.join(
        F.broadcast(cuts), as_column(label).eqNullSafe(F.col("__class")) & (F.col("__range") == F.col("__cut"))
    )
    keys = [key] if isinstance(key, str) else list(key)
    split = (F.col("__take") > 0) & (F.col("__take") < F.col("__held"))
    order = Window.partitionBy("__class", "__range", "__part").orderBy("__draw", *[as_column(k) for k in keys])
    whole = placed.where(~split).withColumn("__in", F.col("__take") > 0)
    part = (
        placed.where(split).withColumn("__part", F.lit(0))
        .withColumn("__in", F.row_number().over(order) <= F.col("__take")).drop("__part")
    )
    both = whole.unionByName(part)
    helpers = ("__draw", "__range", "__class", "__cut", "__held", "__take", "__in")
    if inside:
        return both.withColumn(inside, F.col("__in")).drop(*helpers)
    return both.where("__in").drop(*helpers)


def cut_points(df: DataFrame, column: str, pieces: int) -> list[float]:
    """Values that divide the rows into about equal ranges; only their order matters."""
    steps = [i / pieces for i in range(1, pieces)]
    row = df.agg(F.percentile_approx(as_column(column).cast("double"), steps, max(1000, 4 * pieces)).alias("q")).first()
    return sorted(set(row["q"] or []))


def put_in_ranges(df: DataFrame, column: str, cuts: Sequence[float], name: str) -> DataFrame:
    """Range number by binary search: how many cut points are <= the value."""
    if not cuts:
        return df.withColumn(name, F.lit(0.0))
    edges = [-float("inf"), *cuts, float("inf")]
    return Bucketizer(splits=edges, inputCol=column, outputCol=name, handleInvalid="error").transform(df)


def running_totals(stored: DataFrame, order: str, sums: Mapping[str, str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Running sums by descending ``order``, which must be unique per row.

    ``sums`` maps output name -> summed column. ``stored`` should be a written
    table: it is counted, cut into ranges of about ``range_rows`` rows, totalled
    per range and read once more for the result. Small tables need one range.
    """
    rows = stored.count()
    pieces = min(MAX_RANGES, -(-rows // range_rows))
    cuts = cut_points(stored, order, pieces) if pieces > 1 else []
    ranged = put_in_ranges(stored, order, cuts, "__piece")
    within = Window.partitionBy("__piece").orderBy(as_column(order).desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    inner = ranged.select("*", *[F.sum(as_column(c)).over(within).alias(f"__w_{n}") for n, c in sums.items()])
    kept = [as_column(c) for c in stored.columns]
    if not cuts:
        return inner.select(*kept, *[F.col(f"__w_{n}").alias(n) for n in sums])
    per_range = ranged.groupBy("__piece").agg(*[F.sum(as_column(c)).alias(f"__t_{n}") for n, c in sums.items()])
    earlier = Window.orderBy(F.desc("__piece")).rowsBetween(Window.unboundedPreceding, -1)  # at most MAX_RANGES rows
    offsets = per_range.select(
        F.col("__piece").alias("__from"),
        *[F.coalesce(F.sum(f"__t_{n}").over(earlier), F.lit(0)).alias(f"__o_{n}") for n in sums],
    )
    placed = inner.join(F.broadcast(offsets), F.col("__piece") == F.col("__from"))
    return placed.select(*kept, *[(F.col(f"__w_{n}") + F.col(f"__o_{n}")).alias(n) for n in sums])
