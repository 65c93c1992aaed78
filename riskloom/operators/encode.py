"""Category encoders, fitted on training rows and applied to any rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column
from riskloom.functions.text import name, text
from riskloom.session import check_distinct_names, settle

NULL_LABEL = "__NULL__"
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class FrequencyTable:
    """Training count (or share) per category, with its measured number of rows."""

    column: str
    table: DataFrame
    size: int
    unseen: float = 1

    def apply(self, df: DataFrame) -> DataFrame:
        """Replace the column by ``{column}_FREQ``; null and unseen get ``unseen``."""
        frequency = f"{self.column}_FREQ"
        table = self.table.withColumnRenamed(self.column, "__category")
        if self.size <= BROADCAST_ROWS:
            table = F.broadcast(table)
        kind = self.table.schema[frequency].dataType
        kept = [as_column(c) for c in df.columns if c != self.column]
        return df.join(table, as_column(self.column) == F.col("__category"), "left").select(
            *kept, F.coalesce(as_column(frequency), F.lit(self.unseen).cast(kind)).alias(frequency)
        )


def fit_frequency(train: DataFrame, column: str, normalize: bool = False, unseen: float = 1) -> FrequencyTable:
    frequency = f"{column}_FREQ"
    counted = train.groupBy(as_column(column)).agg(F.count(F.lit(1)).alias(frequency))
    if normalize:
        rows = train.count()
        counted = counted.withColumn(frequency, as_column(frequency) / F.lit(float(rows)))
    table = settle(counted.where(as_column(column).isNotNull()), "frequency")
    return FrequencyTable(column, table, table.count(), unseen)


@dataclass(frozen=True)
class CategoryCodes:
    """Fitted binary and one-hot codes; plain data, so it can be stored as JSON."""

    binary: dict[str, dict[str, int]] = field(default_factory=dict)
    one_hot: dict[str, list[str]] = field(default_factory=dict)
    unknown: int = -1
    null_label: str = NULL_LABEL

    def apply(self, df: DataFrame) -> DataFrame:
        """One projection: coded columns replaced in place, one-hot columns at the end."""
        present, out, tail = set(df.columns), [], []
        for c in df.columns:
            if c in self.binary:
                out.append(f"{self._binary(c)} AS {name(c)}")
            elif c not in self.one_hot:
                out.append(name(c))
        for c in self.binary:
            if c not in present:
                tail.append(f"CAST({self.unknown} AS TINYINT) AS {name(c)}")
        for c, values in self.one_hot.items():
            for v in values:
                hit = f"coalesce({name(c)}, {text(self.null_label)}) = {text(v)}" if c in present else "false"
                tail.append(f"CAST({hit} AS TINYINT) AS {name(f'{c}_{v}')}")
        return df.selectExpr(*out, *tail)

    def _binary(self, column: str) -> str:
        cases = " ".join(f"WHEN {text(v)} THEN {int(code)}" for v, code in self.binary[column].items())
        return f"CAST(CASE {name(column)} {cases} ELSE {self.unknown} END AS TINYINT)"


def fit_codes(
    train: DataFrame,
    columns: Sequence[str],
    binary_values: Sequence[int] = (0, 1),
    use_binary: bool = True,
    drop_first: bool = False,
    unknown: int = -1,
    null_label: str = NULL_LABEL,
    limit: int | None = None,
) -> CategoryCodes:
    """Two non-null categories become one coded column, any other number one column each.

    The category lists become columns and are brought to the driver. ``limit``
    stops a job in which a column has more categories, counted exactly, before
    any list is brought there; None takes any number.
    """
    columns = list(columns)
    if not columns:
        return CategoryCodes(unknown=unknown, null_label=null_label)
    entries = F.array(*[F.struct(F.lit(c).alias("c"), as_column(c).alias("v")) for c in columns])
    values = train.select(F.explode(entries).alias("e")).select("e.c", "e.v").distinct()
    if limit is not None:
        wide = sorted(r[0] for r in values.where("v IS NOT NULL").groupBy("c").count().where(F.col("count") > limit).collect())
        if wide:
            raise ValueError(f"too many categories to turn into columns (limit {limit}): {wide}")
    rows = values.collect()
    seen: dict[str, set] = {c: set() for c in columns}
    for r in rows:
        seen[r["c"]].add(r["v"])
    binary, one_hot = {}, {}
    for c in columns:
        values = sorted((v for v in seen[c] if v is not None), key=str)
        plain = [v for v in values if v != null_label]
        if use_binary and len(plain) == 2:
            binary[c] = dict(zip(plain, binary_values))
            continue
        if None in seen[c] and null_label not in values:
            values.append(null_label)
        one_hot[c] = values[1:] if drop_first else values
    check_distinct_names(train.sparkSession, [f"{c}_{v}" for c, values in one_hot.items() for v in values])
    return CategoryCodes(binary, one_hot, unknown, null_label)
