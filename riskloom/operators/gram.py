"""Correlations of very many columns: a Gram matrix in tiles.

The columns are cut into blocks of ``block``, and a tile holds the sums of products of two blocks. Every task adds up its
rows tile by tile and sends one row per tile; these meet in two steps, by tile and salt, then by tile. No buffer holds
more than ``held`` bytes of tiles: where all tiles are more, the table is read once for each band of block rows, and later
bands read fewer columns. Values are centred first, so columns with a large mean keep their digits. The driver sees some
numbers per column, and never a matrix.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.text import name
from riskloom.session import settle

# task functions travel with their code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pieces of one tile that meet in the second step of merging.
SALTS = 32
#: Values of a matrix that a task makes of its rows at one time.
CHUNK_VALUES = 1 << 21

Batches = Iterator[pa.RecordBatch]
TILES = "i int, j int, piece binary"


def _matrix(batches: Batches, width: int) -> Iterator[np.ndarray]:
    """Rows as matrices of bounded size; a null is NaN."""
    rows = max(CHUNK_VALUES // width, 1)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            values = batch.column(0).slice(at, rows).flatten()
            yield values.to_numpy(zero_copy_only=False).reshape(-1, width)


def _packed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(F.expr(f"array({', '.join(f'CAST({name(c)} AS DOUBLE)' for c in columns)}) AS v"))


def _pieces(numbers: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for (i, j), values in numbers.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())], ["i", "j", "piece"])


def _ranges(width: int, block: int):
    """Per block of columns: rows, sums, smallest and largest values."""

    def run(batches: Batches) -> Batches:
        facts = None
        for x in _matrix(batches, width):
            new = np.stack([np.full(width, float(len(x))), x.sum(axis=0), x.min(axis=0), x.max(axis=0)])
            facts = new if facts is None else _joined(facts, new)
        if facts is not None:
            yield from _pieces({(b // block, b // block): facts[:, b:b + block] for b in range(0, width, block)})

    return run


def _joined(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.stack([one[0] + other[0], one[1] + other[1], np.minimum(one[2], other[2]), np.maximum(one[3], other[3])])


def _products(shift: np.ndarray, first: int, last: int, block: int):
    """Tiles of the block rows first .. last - 1; column 0 of the rows is the first column of block ``first``."""

    def run(batches: Batches) -> Batches:
        sums: dict[int, np.ndarray] = {}
        for x in _matrix(batches, len(shift)):
            x = x - shift
            for i in range(first, last):
                at = (i - first) * block
                more = x[:, at:at + block].T @ x[:, at:]
                sums[i] = sums[i] + more if i in sums else more
        for i, row in sums.items():
            yield from _pieces({(i, i + b // block): row[:, b:b + block] for b in range(0, row.shape[1], block)})

    return run


def _merge(join, rows: int | None = None):
    """One row per tile, from rows sorted by tile."""

    def run(batches: Batches) -> Batches:
        now, total = None, None
        for batch in batches:
            for i, j, piece in zip(batch.column("i").to_pylist(), batch.column("j").to_pylist(), batch.column("piece")):
                values = np.frombuffer(piece.as_buffer())
                values = values.reshape(rows, -1) if rows else values
                if (i, j) != now:
                    if now is not None:
                        yield from _pieces({now: total})
                    now, total = (i, j), values
                else:
                    total = join(total, values)
        if now is not None:
            yield from _pieces({now: total})

    return run


def _together(pieces: DataFrame, join, rows: int | None = None) -> DataFrame:
    merge = _merge(join, rows)
    salted = pieces.withColumn("salt", F.spark_partition_id() % SALTS).repartition("i", "j", "salt").sortWithinPartitions("i", "j")
    once = salted.drop("salt").mapInArrow(merge, TILES)
    return once.repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(merge, TILES)


def _centres(df: DataFrame, columns: Sequence[str], block: int) -> np.ndarray:
    """Means, held between the smallest and the largest value, so that a constant column is centred to exactly 0."""
    found = _together(_packed(df, columns).mapInArrow(_ranges(len(columns), block), TILES), _joined, 4)
    out = np.zeros(len(columns))
    for r in found.toLocalIterator():
        n, total, low, high = np.frombuffer(r.piece).reshape(4, -1)
        with np.errstate(invalid="ignore"):
            out[r.i * block:r.i * block + len(n)] = np.clip(total / n, low, high)
    return out


def _bands(blocks: int, tile_bytes: int, held: int) -> list[tuple[int, int]]:
    """Runs of block rows whose tiles fit; a single row of tiles that does not is a band of its own."""
    out, first = [], 0
    while first < blocks:
        last = first + 1
        while last < blocks and sum(blocks - i for i in range(first, last + 1)) * tile_bytes <= held:
            last += 1
        out.append((first, last))
        first = last
    return out


def _diagonals(batches: Batches) -> Batches:
    for batch in batches:
        for i, j, piece in zip(batch.column("i").to_pylist(), batch.column("j").to_pylist(), batch.column("piece")):
            square = np.frombuffer(piece.as_buffer())
            yield from _pieces({(i, j): square[::int(len(square) ** 0.5) + 1]})


def _pairs(names: Sequence[str], norms: np.ndarray, block: int, threshold: float):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for i, j, piece in zip(batch.column("i").to_pylist(), batch.column("j").to_pylist(), batch.column("piece")):
                left, right = norms[i * block:(i + 1) * block], norms[j * block:(j + 1) * block]
                with np.errstate(invalid="ignore", divide="ignore"):
                    r = np.frombuffer(piece.as_buffer()).reshape(len(left), len(right)) / np.outer(left, right)
                    a, b = np.nonzero((np.abs(r) > threshold) & (np.outer(left, right) > 0))
                keep = i * block + a < j * block + b
                a, b = a[keep], b[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i * block + k] for k in a], pa.string()), pa.array([names[j * block + k] for k in b], pa.string()), pa.array(r[a, b])],
                    ["first", "second", "correlation"])

    return run


def strong_pairs(df: DataFrame, columns: Sequence[str], threshold: float = -1.0, block: int = 256, held: int = 64 << 20) -> DataFrame:
    """(first, second, correlation) of all pairs of columns, first before second in ``columns``, with |correlation| > threshold.

    Pearson correlations. A column that is constant, or holds a null, a NaN or an infinity, has none and is in no pair; an
    empty table gives no rows. A column named twice counts once. ``session.discard`` of the result deletes the tiles.
    """
    columns = list(dict.fromkeys(columns))
    schema = "first string, second string, correlation double"
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], schema)
    centres = _centres(df, columns, block)
    blocks = -(-len(columns) // block)
    sums = None
    for first, last in _bands(blocks, block * block * 8, held):
        band = _packed(df, columns[first * block:]).mapInArrow(_products(centres[first * block:], first, last, block), TILES)
        sums = band if sums is None else sums.unionByName(band)
    tiles = settle(_together(sums, np.add), "gram")
    norms = np.zeros(len(columns))
    for r in tiles.where(F.col("i") == F.col("j")).mapInArrow(_diagonals, TILES).toLocalIterator():
        values = np.frombuffer(r.piece)
        norms[r.i * block:r.i * block + len(values)] = np.sqrt(values)
    pairs = tiles.mapInArrow(_pairs(columns, norms, block, threshold), schema)
    pairs._settled_path = tiles._settled_path
    return pairs
