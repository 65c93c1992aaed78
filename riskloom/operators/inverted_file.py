"""Candidates for nearest neighbours from an inverted file.

Points lie in cells around centroids that k-means in Spark has fitted. Each cell
lists its points as codes: the difference to the centroid in one byte per
dimension, with the length of what the rounding left out. That length bounds how
far a distance to a code is from the true one, so codes tell which points of a
probed cell can be among the nearest, and no other neighbour is lost than those
in cells that were not probed. Only these few are compared by their vectors.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ranking import unit_draw
from riskloom.session import settle

# task functions travel with their code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The square root of the number of points is the number of cells, up to this many.
MAX_CELLS = 65_536
#: k-means sees about so many points per cell, drawn by their keys.
SAMPLE_PER_CELL, ROUNDS = 64, 8
#: Cells that travel together, and the points and queries of one comparison.
GROUP_CELLS, BLOCK_POINTS, BLOCK_QUERIES = 32, 16_384, 2_000
#: Numbers in the arrays of one step.
STEP = 4_000_000
SLACK = 1e-9


@dataclass(frozen=True)
class InvertedFile:
    """``lists``: (vid, cell, grp, codes, scale, error); ``sizes``: points per cell; ``groups``: the group of each cell."""

    centroids: np.ndarray
    groups: np.ndarray
    lists: DataFrame
    sizes: np.ndarray

    def share(self, queries: np.ndarray, probes: int) -> float:
        """Part of all points whose codes are compared with these queries."""
        near = _nearest_cells(queries, self.centroids, probes)
        return float(self.sizes[near].sum() / max(1, len(queries) * self.sizes.sum()))


def _squares(x: np.ndarray, centroids: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Squared distances to all centroids, some rows at a time."""
    own = (centroids**2).sum(axis=1)
    step = max(1, STEP // len(centroids))
    for a in range(0, len(x), step):
        part = x[a:a + step]
        yield slice(a, a + step), (part**2).sum(axis=1)[:, None] - 2 * part @ centroids.T + own


def _nearest_cells(x: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    if probes >= len(centroids):
        return np.tile(np.arange(len(centroids)), (len(x), 1))
    return np.concatenate([np.argpartition(away, probes - 1, axis=1)[:, :probes] for _, away in _squares(x, centroids)]) if len(x) else np.zeros((0, probes), int)


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def fit_cells(points: DataFrame, total: int, seed: int) -> np.ndarray:
    """Centroids of about sqrt(total) cells, from a sample by key; at most MAX_CELLS of them come to the driver."""
    cells = min(MAX_CELLS, max(1, math.isqrt(total)))
    drawn = unit_draw("vid", seed=seed) < min(1.0, SAMPLE_PER_CELL * cells / max(1, total))
    sample = settle(points.where(drawn).select(array_to_vector(F.col("vec")).alias("v")), "cells-sample")
    model = KMeans(k=max(2, cells), initMode="random", maxIter=ROUNDS, seed=seed, featuresCol="v").fit(sample)
    return np.array(model.clusterCenters(), dtype=float)


def _group_of(centroids: np.ndarray) -> np.ndarray:
    """Neighbouring cells in groups of GROUP_CELLS, along the direction in which the centroids differ most."""
    middle = centroids - centroids.mean(axis=0)
    direction = np.linalg.eigh(middle.T @ middle)[1][:, -1]
    out = np.zeros(len(centroids), np.int64)
    out[np.argsort(middle @ direction, kind="stable")] = np.arange(len(centroids)) // GROUP_CELLS
    return out


def fit(points: DataFrame, total: int, seed: int = 42) -> InvertedFile:
    """The inverted file of (vid, vec), one row per distinct vector; every point is listed."""
    centroids = fit_cells(points, total, seed)
    groups = _group_of(centroids)
    shared = points.sparkSession.sparkContext.broadcast((centroids, groups))

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, group = shared.value
        for batch in batches:
            if len(batch):
                x = _stack(batch["vec"])
                cell = np.concatenate([away.argmin(axis=1) for _, away in _squares(x, centres)])
                rest = x - centres[cell]
                scale = np.abs(rest).max(axis=1) / 127
                scale[scale == 0] = 1.0
                codes = np.rint(rest / scale[:, None]).astype(np.int8)
                error = np.sqrt(((rest - codes * scale[:, None]) ** 2).sum(axis=1))
                yield pd.DataFrame({"vid": batch["vid"], "cell": cell.astype("int32"), "grp": group[cell].astype("int32"), "codes": [c.tobytes() for c in codes],
                                    "scale": scale, "error": error})

    kind = dict(points.dtypes)["vid"]
    lists = settle(points.select("vid", "vec").mapInPandas(listed, f"vid {kind}, cell int, grp int, codes binary, scale double, error double"), "lists")
    sizes = np.zeros(len(centroids), np.int64)
    for r in lists.groupBy("cell").count().collect():
        sizes[r["cell"]] = r["count"]
    return InvertedFile(centroids, groups, lists, sizes)


def probes_for(file: InvertedFile, queries: DataFrame, true: DataFrame, recall: float) -> int:
    """Cells to probe so that this share of the ``true`` (qid, vid) pairs of some queries (qid, vec) lies in them."""
    pairs = true.join(file.lists.select("vid", "cell"), "vid").join(queries.select("qid", "vec"), "qid").select("vec", "cell").toPandas()
    if not len(pairs):
        return 1
    x, cell, ranks = _stack(pairs["vec"]), pairs["cell"].to_numpy(), []
    for rows, away in _squares(x, file.centroids):
        own = np.take_along_axis(away, cell[rows, None], axis=1)
        ranks.append((away <= own).sum(axis=1))
    return int(np.quantile(np.concatenate(ranks), recall, method="higher"))


def candidates(file: InvertedFile, queries: DataFrame, probes: int, want: int) -> DataFrame:
    """(qid, vid) that can be among the ``want`` nearest points of the probed cells, by their codes."""
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast((file.centroids, file.groups))
    qkind, vkind = dict(queries.dtypes)["qid"], dict(file.lists.dtypes)["vid"]

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, group = shared.value
        for batch in batches:
            if len(batch):
                near = _nearest_cells(_stack(batch["vec"]), centres, probes)
                row = np.repeat(np.arange(len(batch)), near.shape[1])
                order = np.lexsort((group[near.ravel()], row))
                row, cell = row[order], near.ravel()[order]
                first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (group[cell[1:]] != group[cell[:-1]])))
                out = batch.iloc[row[first]]
                yield out.assign(grp=group[cell[first]].astype("int32"), cells=np.split(cell.astype("int32"), first[1:]))

    asked = settle(queries.select("qid", "vec").mapInPandas(routed, f"qid {qkind}, vec array<double>, grp int, cells array<int>"), "probes")
    parts = lambda df, rows, name: df.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))
    both = F.broadcast(parts(file.lists, BLOCK_POINTS, "pparts").join(parts(asked, BLOCK_QUERIES, "qparts"), "grp"))  # a row per group of cells
    spread = lambda counter: F.explode(F.sequence(F.lit(0), F.col(counter) - 1))
    left = asked.join(both, "grp").withColumn("qpart", F.pmod(F.xxhash64("qid"), "qparts").cast("int")).withColumn("ppart", spread("pparts"))
    right = file.lists.join(both, "grp").withColumn("ppart", F.pmod(F.xxhash64("vid"), "pparts").cast("int")).withColumn("qpart", spread("qparts"))

    def compared(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asking) and len(held):
            centres, _ = shared.value
            x = _stack(asking["vec"])
            codes = np.frombuffer(b"".join(held["codes"]), np.int8).reshape(len(held), -1)
            cell_of = held["cell"].to_numpy()
            by_cell = np.argsort(cell_of, kind="stable")
            wanted = np.concatenate(asking["cells"].to_numpy())
            row = np.repeat(np.arange(len(asking)), asking["cells"].map(len))
            for c in np.unique(cell_of):
                points = by_cell[slice(*np.searchsorted(cell_of[by_cell], [c, c + 1]))]
                some = row[wanted == c]
                step = max(1, STEP // len(points))
                for a in range(0, len(some), step):
                    q = some[a:a + step]
                    found.append((q, points, *_bounds(x[q] - centres[c], codes[points] * held["scale"].to_numpy()[points, None], held["error"].to_numpy()[points], want)))
        if not found:
            return pd.DataFrame({"qid": asking["qid"][:0], "vid": held["vid"][:0], "low": np.zeros(0), "high": np.zeros(0)})
        q, v = np.concatenate([f[0][f[2]] for f in found]), np.concatenate([f[1][f[3]] for f in found])
        low, high = np.concatenate([f[4] for f in found]), np.concatenate([f[5] for f in found])
        order = np.lexsort((high, q))
        place = np.arange(len(q)) - np.searchsorted(q[order], q[order])
        limit = np.full(len(asking), np.inf)
        limit[q[order][place == want - 1]] = high[order][place == want - 1]
        good = low <= limit[q]
        return pd.DataFrame({"qid": asking["qid"].to_numpy()[q[good]], "vid": held["vid"].to_numpy()[v[good]], "low": low[good], "high": high[good]})

    where = ["grp", "ppart", "qpart"]
    near = left.select("qid", "vec", "cells", *where).groupBy(*where).cogroup(right.select("vid", "cell", "codes", "scale", "error", *where).groupBy(*where)).applyInPandas(
        compared, f"qid {qkind}, vid {vkind}, low double, high double")
    by_query = Window.partitionBy("qid")
    ranked = near.withColumn("place", F.row_number().over(by_query.orderBy("high", "vid")))
    limit = F.max(F.when(F.col("place") == want, F.col("high"))).over(by_query)
    return ranked.withColumn("limit", limit).where(F.col("limit").isNull() | (F.col("low") <= F.col("limit"))).select("qid", "vid")


def _bounds(x: np.ndarray, points: np.ndarray, error: np.ndarray, want: int):
    """Rows, points and bounds of the pairs whose lower bound is not above the ``want``-th smallest upper bound of the row."""
    square = (x**2).sum(axis=1)[:, None] - 2 * x @ points.T + (points**2).sum(axis=1)
    about = np.sqrt(np.maximum(square, 0))
    # what floating-point sums may lose near zero
    blur = np.sqrt(1e-14 * ((x**2).sum(axis=1)[:, None] + (points**2).sum(axis=1))) + SLACK
    low, high = about - error - blur, about + error + blur
    limit = np.partition(high, want - 1, axis=1)[:, want - 1] if len(points) >= want else np.full(len(x), np.inf)
    rows, at = np.nonzero(low <= limit[:, None])
    return rows, at, low[rows, at], high[rows, at]


def search(file: InvertedFile, queries: DataFrame, points: DataFrame, probes: int, want: int) -> DataFrame:
    """(qid, vid, distance): the candidates compared by their vectors; at least the ``want`` nearest of the probed cells."""
    pairs = candidates(file, queries, probes, want)
    gap = F.zip_with("vec", "other", lambda a, b: (a - b) * (a - b))
    distance = F.sqrt(F.aggregate(gap, F.lit(0.0), lambda t, v: t + v))
    return (
        pairs.join(points.select("vid", F.col("vec").alias("other")), "vid").join(queries.select("qid", "vec"), "qid")
        .select("qid", "vid", distance.alias("distance"))
    )
