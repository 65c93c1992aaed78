"""Reading source files, processed tables and scoring requests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.columns import as_column
from riskloom.plans import fixed_values as fv

# Type names a schema may use. Unsigned types take the next wider signed one.
TYPE_NAMES = {
    "Int8": T.ByteType(),
    "Int16": T.ShortType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "UInt8": T.ShortType(),
    "UInt16": T.IntegerType(),
    "UInt32": T.LongType(),
    "UInt64": T.DecimalType(20, 0),
    "Float32": T.FloatType(),
    "Float64": T.DoubleType(),
    "String": T.StringType(),
    "Boolean": T.BooleanType(),
}


def named_type(name: str) -> T.DataType:
    if name not in TYPE_NAMES:
        raise ValueError(f"unknown column type {name!r}; known: {sorted(TYPE_NAMES)}")
    return TYPE_NAMES[name]


def without_markers(column, markers: Sequence[str] = fv.NULL_MARKERS) -> Column:
    """Text that means null becomes null."""
    c = as_column(column)
    return F.when(~c.isin(list(markers)), c)


def _guess_types(df: DataFrame, columns: Sequence[str]) -> dict[str, T.DataType]:
    """Narrowest of long, double, boolean and string that fits every value, from one aggregate over all rows."""
    if not columns:
        return {}
    asks = []
    for i, c in enumerate(columns):
        col = as_column(c)
        asks += [
            F.count(col).alias(f"n{i}"), F.count(col.try_cast("long")).alias(f"l{i}"),
            F.count(col.try_cast("double")).alias(f"d{i}"),
            F.count_if(F.lower(col).isin("true", "false")).alias(f"b{i}"),
            F.count_if(col.contains(".")).alias(f"p{i}"),
        ]
    row = df.agg(*asks).first()
    guessed = {}
    for i, c in enumerate(columns):
        n = row[f"n{i}"]
        if n and row[f"l{i}"] == n and not row[f"p{i}"]:
            guessed[c] = T.LongType()
        elif n and row[f"d{i}"] == n:
            guessed[c] = T.DoubleType()
        elif n and row[f"b{i}"] == n:
            guessed[c] = T.BooleanType()
        else:
            guessed[c] = T.StringType()
    return guessed


def read_csv(spark: SparkSession, path: str, types: Mapping[str, str] = fv.SOURCE_TYPES,
             markers: Sequence[str] = fv.NULL_MARKERS) -> DataFrame:
    """A typed table from a CSV file with a header.

    All fields are read as text so that every null marker works for every type;
    the listed types win, the other columns are typed by one more pass over all
    rows; list every type to save it. A value that does not fit its type fails
    the job, as does a malformed line.
    """
    plain = {f: named_type(t) for f, t in types.items()}
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    text = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("nullValue", "").csv(path)
    text = text.select([without_markers(n, markers).alias(n) for n in names])
    unlisted = [n for n in names if n not in plain]
    kinds = {**_guess_types(text.select(*map(as_column, unlisted)), unlisted), **plain}
    return text.select([as_column(n).cast(kinds[n]).alias(n) for n in names])


def read_credit_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: read_csv(spark, path) for name, path in paths.items()}


def read_table(spark: SparkSession, path: str, sample: int | None = None) -> DataFrame:
    """A processed parquet table, or its first rows as an input example."""
    df = spark.read.parquet(path)
    return df if sample is None else df.limit(sample)


def scoring_input(spark: SparkSession, path: str | None = None, json_text: str | None = None,
                  default_path: str | None = None) -> DataFrame:
    """Rows to score from a CSV file or from inline JSON, never from both."""
    if path and json_text:
        raise ValueError("give a file or inline JSON, not both")
    if json_text:
        return rows_from_json(spark, json_text)
    if path or default_path:
        return read_csv(spark, path or default_path)
    raise ValueError("no scoring input: give a file or inline JSON")


def rows_from_json(spark: SparkSession, text: str, max_rows: int | None = None) -> DataFrame:
    """One JSON object, or a non-empty array of objects, as rows."""
    one = spark.range(1, numPartitions=1).select(F.lit(text).alias("payload"))
    kind = one.select(F.trim("payload").substr(1, 1).alias("k"), F.json_array_length("payload").alias("n")).first()
    if kind["k"] not in ("{", "[") or (kind["k"] == "[" and not kind["n"]):
        raise ValueError("the payload must be a JSON object or a non-empty array of JSON objects")
    if kind["k"] == "[":
        items = one.select(F.explode(F.from_json("payload", "array<string>")).alias("item"))
        if items.where(~F.trim("item").startswith("{")).limit(1).count():
            raise ValueError("the payload must be a JSON object or a non-empty array of JSON objects")
        if max_rows is not None and kind["n"] > max_rows:
            raise ValueError(f"the batch holds more than {max_rows} rows")
    shape = one.select(F.schema_of_json(F.lit(text))).first()[0]
    array_shape = shape if shape.upper().startswith("ARRAY") else f"ARRAY<{shape}>"
    wrapped = F.col("payload") if kind["k"] == "[" else F.concat(F.lit("["), F.col("payload"), F.lit("]"))
    return one.select(F.inline(F.from_json(wrapped, array_shape)))


def split_payloads(df: DataFrame, column: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Request texts -> (rows, rejected texts). A text holds one object or a non-empty array.

    Rows keep the position they had in their request.
    """
    text = F.trim(as_column(column))
    wrapped = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    parsed = F.from_json(wrapped, f"array<{schema}>", {"mode": "PERMISSIVE"})
    raw_items = F.from_json(wrapped, "array<string>")
    all_objects = F.forall(raw_items, lambda x: F.trim(x).startswith("{"))
    good = F.coalesce(raw_items.isNotNull() & (F.size(raw_items) > 0) & all_objects & parsed.isNotNull(), F.lit(False))
    kept = [as_column(c) for c in df.columns if c != column]
    tagged = df.withColumn("__ok", good)
    rows = tagged.where("__ok").select(*kept, F.posexplode(parsed).alias("row_index", "__item")).select(*kept, "row_index", "__item.*")
    return rows, tagged.where("NOT __ok").drop("__ok")
