"""Nearest neighbours by an inverted file, or exactly by pivot cells.

By default an inverted file (``inverted_file``) names the candidates. On request,
for few points, and for queries that find too few points, the search is exact:
vectors are grouped around a bounded set of pivots, and the triangle inequality
tells which cells can still hold one of the k nearest. Either way cells are
compared in blocks of bounded size, and equal vectors once, so a large group of
copies is a single candidate.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column
from riskloom.operators import inverted_file
from riskloom.operators.ranking import draw
from riskloom.session import settle

# task functions travel with their code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_PIVOTS = 256
#: Points, and queries, that meet in one comparison: a share of all points, but no fewer and no more than this.
BLOCKS, LEAST_ROWS, BLOCK_ROWS = 16, 4_096, 32_768
#: Numbers in the arrays of one step.
STEP = 2_000_000
#: Up to so many distinct vectors all are compared.
FEW_POINTS = 1_000
#: Share of the true neighbours that the probed cells must hold, for so many queries that are answered exactly to tell.
TARGET = 0.95
RECALL_QUERIES = 500
SLACK = 1e-9


def nearest(queries: DataFrame, points: DataFrame, key: str, vector: str, k: int, seed: int = 42, exact: bool = False,
            few: int = FEW_POINTS) -> DataFrame:
    """(query, neighbor, rank, distance): the k nearest other points of each query row.

    Euclidean; equal distances are ordered by neighbour key, and a row is never
    its own neighbour. ``key`` is unique in both inputs.

    Up to ``few`` distinct points all are compared. Beyond that the nearest cells
    of an inverted file are, as many as hold TARGET of the true neighbours of a
    sample of queries that is answered exactly as well; inside these cells
    nothing is lost. Queries that find fewer than k points are answered exactly.
    ``exact`` asks for that throughout, which in many dimensions compares nearly
    all pairs.
    """
    want = k + 1
    points, queries = _narrow(points, key, vector), _narrow(queries, key, vector)
    groups = settle(_distinct_points(points, want), "vectors")
    query_rows = settle(queries.join(groups.select("vec", F.col("vid").alias("point_vid")), "vec", "left"), "queries")
    query_groups = query_rows.groupBy("vec").agg(F.min("id").alias("qid"))

    total = groups.count()
    pivots = _pivots(groups, min(MAX_PIVOTS, max(1, math.isqrt(total))), seed)
    if exact or total <= few:
        pairs = _by_pivots(query_groups, groups, pivots, want)
    else:
        pairs = _by_inverted_file(query_groups, groups, pivots, total, want, seed)
        copies = groups.select("vid", F.size("ids").alias("copies"))
        found = pairs.join(copies, "vid").groupBy("qid").agg(F.sum("copies").alias("found")).where(F.col("found") >= want)
        short = settle(query_groups.join(found, "qid", "left_anti"), "short")
        if not short.isEmpty():
            pairs = pairs.join(short.select("qid"), "qid", "left_anti").unionByName(_by_pivots(short, groups, pivots, want))

    by_query = Window.partitionBy("qid").orderBy("distance", "vid")
    best = pairs.withColumn("r", F.row_number().over(by_query)).where(F.col("r") <= want)
    lists = (
        best.join(groups.select("vid", "ids"), "vid").groupBy("qid")
        .agg(F.sort_array(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(F.col("distance").alias("distance"), i.alias("neighbor")))))).alias("near"))
    )
    named = query_groups.join(lists, "qid").select("vec", "near")
    others = F.slice(F.filter("near", lambda n: n["neighbor"] != F.col("id")), 1, k)
    return (
        query_rows.select("id", "vec").join(named, "vec").select(F.col("id").alias("query"), F.posexplode(others).alias("p", "n"))
        .select("query", F.col("n.neighbor").alias("neighbor"), (F.col("p") + 1).alias("rank"), F.col("n.distance").alias("distance"))
    )


def _narrow(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(as_column(key).alias("id"), as_column(vector).cast("array<double>").alias("vec"))


def _distinct_points(points: DataFrame, want: int) -> DataFrame:
    """One row per distinct vector with its first ``want`` keys."""
    order = Window.partitionBy("vec").orderBy("id")
    first = points.withColumn("r", F.row_number().over(order)).where(F.col("r") <= want)
    return first.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select("vec", "ids", F.col("ids")[0].alias("vid"))


def _pivots(groups: DataFrame, count: int, seed: int) -> np.ndarray:
    rows = groups.select("vec", draw("vid", seed).alias("d")).orderBy("d").limit(count).collect()
    return np.array([r["vec"] for r in rows], dtype=float)


def _distances(block: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances from differences, a few rows at a time to bound the memory."""
    step = max(1, 4_000_000 // max(1, others.size))
    parts = [np.sqrt(((block[i:i + step, None, :] - others[None]) ** 2).sum(axis=2)) for i in range(0, len(block), step)]
    return np.concatenate(parts) if parts else np.zeros((0, len(others)))


def _assign(groups: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Cell and distance to its pivot for every vector."""
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                away = _distances(np.stack(batch["vec"].to_numpy()), pivots)
                cell = away.argmin(axis=1)
                yield batch.assign(cell=cell.astype("int32"), away=away[np.arange(len(batch)), cell])

    kinds = dict(groups.dtypes)
    return groups.mapInPandas(place, f"vid {kinds['vid']}, vec array<double>, copies int, cell int, away double")


def _cell_facts(cells: DataFrame, want: int):
    """Rows and radius per cell, and the distances of the ``want`` vectors closest to its pivot."""
    facts = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("away").alias("reach")).collect()
    size, reach = {r["cell"]: r["rows"] for r in facts}, {r["cell"]: r["reach"] for r in facts}
    inner = Window.partitionBy("cell").orderBy("away", "vid")
    close: dict[int, list[float]] = {}
    for r in cells.withColumn("r", F.row_number().over(inner)).where(F.col("r") <= want).select("cell", "away", "copies").collect():
        close.setdefault(r["cell"], []).extend([r["away"]] * min(r["copies"], want))
    return size, reach, close


def _group_cells(pivots: np.ndarray, size: dict[int, int], rows: int) -> np.ndarray:
    """The group of each cell: neighbours along the direction in which the pivots differ most, about ``rows`` vectors together."""
    middle = np.nan_to_num(pivots - pivots.mean(axis=0), posinf=0, neginf=0)
    direction = np.linalg.eigh(middle.T @ middle)[1][:, -1]
    group, at, held = np.zeros(len(pivots), int), 0, 0
    for c in np.argsort(middle @ direction, kind="stable"):
        if held and held + size.get(c, 0) > rows:
            at, held = at + 1, 0
        group[c] = at
        held += size.get(c, 0)
    return group


def _candidate_groups(query_groups, pivots, group, reach, close, want) -> DataFrame:
    """For each query vector the groups of cells that can hold one of its neighbours.

    They come as one list, so that a batch of queries does not grow by the number of its cells.
    """
    used = np.array(sorted(reach), dtype=int)
    radius = np.array([reach[c] for c in used])
    width = max(len(v) for v in close.values())
    inside = np.full((len(used), width), np.inf)
    for i, c in enumerate(used):
        values = sorted(close[c])
        inside[i, :len(values)] = values
    apart = _distances(pivots, pivots)

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            away = _distances(np.stack(batch["vec"].to_numpy()), pivots)
            home = away.argmin(axis=1)
            groups = []
            for i in range(len(batch)):
                to_pivot = away[i, used]
                bounds = (to_pivot[:, None] + inside).ravel()
                limit = np.partition(bounds, want - 1)[want - 1] if bounds.size >= want else np.inf
                limit = limit * (1 + SLACK) + SLACK
                keep = to_pivot - radius <= limit
                gap = apart[home[i], used]
                beyond = np.divide(to_pivot**2 - away[i, home[i]] ** 2, 2 * gap, out=np.full(len(used), -np.inf), where=gap > 0)
                keep &= beyond <= limit
                groups.append(np.unique(group[used[keep]]).astype("int32"))
            yield batch.assign(groups=groups)

    kinds = dict(query_groups.dtypes)
    return query_groups.mapInPandas(pick, f"vec array<double>, qid {kinds['qid']}, groups array<int>")


def _closest(x: np.ndarray, y: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of x, rows of y and distances of the ``want`` nearest of each row; of equal distances the earlier.

    A matrix product tells, up to its rounding, which pairs can be among them; these are compared by differences.
    """
    middle = np.nan_to_num(y, posinf=0, neginf=0).mean(axis=0)
    a, b = x - middle, y - middle
    own, length = (a**2).sum(axis=1), (b**2).sum(axis=1)
    blur = 1e-15 * (x.shape[1] + 8) * (own + length[np.isfinite(length)].max(initial=0.0))
    first, step, chunk = max(want, len(y) // 8), max(1, STEP // len(y)), max(1, STEP // max(1, x.shape[1]))
    found = []
    for i in range(0, len(x), step):
        square = length - 2 * (a[i:i + step] @ b.T)  # less the length of x, which is the same along a row

        def within(columns: int) -> np.ndarray:
            if columns > len(y) or want > columns:
                return np.isfinite(square)
            limit = np.partition(square[:, :columns], want - 1, axis=1)[:, want - 1]
            return square <= np.where(np.isnan(limit), np.inf, limit + 2 * blur[i:i + step])[:, None]

        near = within(first)
        if near.sum() > chunk:  # the first points do not stand for all
            near = within(len(y))
        rows, at = np.nonzero(near)
        parts = [np.sqrt(((x[i + rows[k:k + chunk]] - y[at[k:k + chunk]]) ** 2).sum(axis=1)) for k in range(0, len(rows), chunk)]
        away = np.concatenate(parts) if parts else np.zeros(0)
        order = np.lexsort((at, away, rows))
        rows, at, away = rows[order], at[order], away[order]
        best = np.arange(len(rows)) - np.searchsorted(rows, rows) < want
        found.append((i + rows[best], at[best], away[best]))
    return tuple(np.concatenate(part) for part in zip(*found))


def _compare(asked: DataFrame, cells: DataFrame, want: int, rows: int) -> DataFrame:
    """Best candidates per query and block; both sides of a block have a bounded size.

    A group with many points or queries is cut into parts on either side, by counts that are joined to it.
    """
    kinds = dict(asked.dtypes), dict(cells.dtypes)
    asked = asked.select("qid", "vec", F.explode("groups").alias("grp"))
    parts = lambda df, name: df.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))
    both = F.broadcast(parts(cells, "pparts").join(parts(asked, "qparts"), "grp"))  # a row per group, and there are no more than pivots

    def spread(counter: str):
        return F.explode(F.sequence(F.lit(0), F.col(counter) - 1))

    left = asked.join(both, "grp").withColumn("qpart", F.pmod(F.xxhash64("qid"), "qparts").cast("int")).withColumn("ppart", spread("pparts"))
    right = (
        cells.select("vid", "vec", "grp").join(both, "grp")
        .withColumn("ppart", F.pmod(F.xxhash64("vid"), "pparts").cast("int")).withColumn("qpart", spread("qparts"))
    )

    def best(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(held):
            return pd.DataFrame({"qid": asking["qid"][:0], "vid": held["vid"][:0], "distance": np.zeros(0)})
        held = held.sort_values("vid")
        row, at, away = _closest(np.stack(asking["vec"].to_numpy()), np.stack(held["vec"].to_numpy()), want)
        return pd.DataFrame({"qid": asking["qid"].to_numpy()[row], "vid": held["vid"].to_numpy()[at], "distance": away})

    where = ["grp", "ppart", "qpart"]
    return left.select("qid", "vec", *where).groupBy(*where).cogroup(right.select("vid", "vec", *where).groupBy(*where)).applyInPandas(
        best, f"qid {kinds[0]['qid']}, vid {kinds[1]['vid']}, distance double"
    )


def _by_inverted_file(query_groups: DataFrame, groups: DataFrame, pivots: np.ndarray, total: int, want: int, seed: int) -> DataFrame:
    """Candidates of an inverted file that probes as many cells as a recall of TARGET needs on a sample of the queries."""
    points = groups.select("vid", "vec")
    file = inverted_file.fit(points, total, seed)
    sample = settle(query_groups.orderBy(draw("qid", seed), "qid").limit(RECALL_QUERIES), "recall-queries")
    order = Window.partitionBy("qid").orderBy("distance", "vid")
    best = _by_pivots(sample, groups, pivots, want).withColumn("r", F.row_number().over(order)).where(F.col("r") <= want)
    # a vector always finds its own copies
    true = settle(best.where(F.col("distance") > 0).select("qid", "vid"), "true-neighbours")
    probes = inverted_file.probes_for(file, sample, true, TARGET)
    return settle(inverted_file.search(file, query_groups, points, probes, want), "found")


def _by_pivots(query_groups: DataFrame, groups: DataFrame, pivots: np.ndarray, want: int) -> DataFrame:
    """Candidates of all cells that the triangle inequality cannot rule out."""
    cells = settle(_assign(groups.select("vid", "vec", F.size("ids").alias("copies")), pivots), "cells")
    size, reach, close = _cell_facts(cells, want)
    rows = min(BLOCK_ROWS, max(LEAST_ROWS, sum(size.values()) // BLOCKS))
    group = _group_cells(pivots, size, rows)
    asked = settle(_candidate_groups(query_groups, pivots, group, reach, close, want), "candidates")
    placed = cells.withColumn("grp", F.array(*map(F.lit, group.tolist()))[F.col("cell")])
    return _compare(asked, placed, want, rows)
