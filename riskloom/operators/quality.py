"""Data checks. Every check is collected; one error names all that failed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column, numeric_columns
from riskloom.functions.text import invalid_text, name as quoted
from riskloom.session import DENSE, settle

#: Conditions that one pass counts by as many aggregates.
MOST_AGGREGATES = 250
#: Columns whose nulls one number tells.
NULL_BITS = 32
CHECK_SCHEMA = "section string, name string, passed boolean, detail string"


@dataclass(frozen=True)
class Check:
    section: str
    name: str
    passed: bool
    detail: dict = field(default_factory=dict)


class CheckFailure(ValueError):
    """Raised with the names of all failed checks."""


@dataclass(frozen=True)
class TableFacts:
    """What one pass saw of a table: the number of rows, nulls and unusable numbers per column, targets other than 0 and 1."""

    rows: int
    nulls: dict[str, int]
    invalid: dict[str, int]
    outside: int = 0


def count_flags(df: DataFrame, flags: Sequence[str]) -> list[int]:
    """How many rows each condition holds for.

    Hundreds of aggregates would be interpreted for every row, so that many conditions become one array, of which the
    places that hold are counted.
    """
    if len(flags) <= MOST_AGGREGATES:
        return list(df.selectExpr(*[f"count_if({f}) AS n{i}" for i, f in enumerate(flags)]).first())
    packed = df.selectExpr(f"array({', '.join(flags)}) AS flags").select(F.posexplode("flags").alias("i", "holds"))
    found = {r["i"]: r["n"] for r in packed.where("holds").groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [found.get(i, 0) for i in range(len(flags))]


def table_facts(df: DataFrame, target: str | None = None, only: str | None = None) -> TableFacts:
    """The facts of a table from one pass over it; ``only`` restricts them to some rows."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    floats = [c for c, kind in kinds.items() if kind.simpleString() in ("double", "float")]
    flags = ["TRUE", *[f"{quoted(c)} IS NULL" for c in df.columns], *[invalid_text(c, kinds[c]) for c in floats]]
    flags += [f"{quoted(target)} NOT IN (0, 1)"] if target in kinds else []
    rows, *found = count_flags(df, flags if only is None else [f"({only}) AND ({f})" for f in flags])
    nulls, rest = found[:len(df.columns)], found[len(df.columns):]
    return TableFacts(rows, dict(zip(df.columns, nulls)), dict(zip(floats, rest)), rest[len(floats)] if target in kinds else 0)


def settle_with_facts(df: DataFrame, label: str, target: str | None = None, only: str | None = None) -> tuple[DataFrame, TableFacts]:
    """The table written to the shared folder, and its facts from one pass over what was written.

    An ``Observation`` would spare the pass, but in Spark 4.1 it leaves a session that cannot be serialized, and fitted
    models that hold a training summary then fail in every later job.
    """
    settled = settle(df, label, DENSE)
    return settled, table_facts(settled, target, only)


def bit_columns(columns: Sequence[str]) -> list[str]:
    return [f"__nulls{i}" for i in range(-(-len(columns) // NULL_BITS))]


def null_bits(columns: Sequence[str]) -> list[str]:
    """Which of many columns are null, as bits of a few numbers: what remains to be counted after the nulls are filled."""
    out = []
    for i, bits in enumerate(bit_columns(columns)):
        own = columns[i * NULL_BITS:(i + 1) * NULL_BITS]
        out.append(" | ".join(f"CASE WHEN {quoted(c)} IS NULL THEN {1 << k}L ELSE 0L END" for k, c in enumerate(own)) + f" AS {bits}")
    return out


def facts_of_bits(df: DataFrame, columns: Sequence[str], only: str) -> TableFacts:
    """Rows and nulls per column from ``null_bits``, among the rows where ``only`` holds."""
    # a word more, with one bit that every row has
    words = df.where(only).select(F.posexplode(F.array(F.lit(1).cast("long"), *map(as_column, bit_columns(columns)))).alias("i", "word"))
    held = words.select("i", "word", F.explode(F.sequence(F.lit(0), F.lit(NULL_BITS - 1))).alias("k")).where("shiftright(word, k) & 1 = 1")
    found = {(r["i"] - 1) * NULL_BITS + r["k"]: r["n"] for r in held.groupBy("i", "k").agg(F.count(F.lit(1)).alias("n")).collect()}
    return TableFacts(found.get(-NULL_BITS, 0), {c: found.get(i, 0) for i, c in enumerate(columns)}, {})


def source_files(paths: Mapping[str, str], spark: SparkSession) -> list[Check]:
    """Every source exists and holds at least one byte, on whatever file system it lives."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name, path in paths.items():
        location = jvm.org.apache.hadoop.fs.Path(path)
        system = location.getFileSystem(conf)
        exists = system.exists(location)
        size = system.getContentSummary(location).getLength() if exists else 0
        out.append(Check("source_files", f"raw_path_exists.{name}", exists, {"path": path}))
        out.append(Check("source_files", f"raw_path_non_empty.{name}", exists and size > 0, {"path": path}))
    return out


def required_columns(name: str, columns: Sequence[str], required: Sequence[str], section: str = "schema") -> Check:
    missing = [c for c in required if c not in columns]
    return Check(section, f"required_columns.{name}", not missing, {"missing": missing})


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values on more than one row, null being a value like any other."""
    return df.groupBy(as_column(key)).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def unique_key(name: str, df: DataFrame, key: str, section: str = "schema") -> Check:
    repeated = repeated_keys(df, key).count()
    return Check(section, f"unique_id.{name}", repeated == 0, {"repeated_keys": repeated})


def target_presence(name: str, columns: Sequence[str], target: str, wanted: bool, section: str = "schema") -> Check:
    word = "present" if wanted else "absent"
    return Check(section, f"target_{word}.{name}", (target in columns) == wanted)


def binary_target(name: str, df: DataFrame, target: str, section: str = "schema", facts: TableFacts | None = None) -> Check:
    """Non-null target values lie in {0, 1}; checked by counting, not by listing values."""
    if target not in df.columns:
        return Check(section, f"binary_target.{name}", True, {"outside": 0})
    outside = facts.outside if facts else df.agg(F.count_if(~as_column(target).isin(0, 1)).alias("n")).first()["n"]
    return Check(section, f"binary_target.{name}", outside == 0, {"outside": outside})


def same_columns(name: str, train_columns: Sequence[str], test_columns: Sequence[str], target: str, section: str = "schema") -> Check:
    """Test columns are the train columns without the target, in the same order."""
    expected = [c for c in train_columns if c != target]
    return Check(section, f"feature_alignment.{name}", list(test_columns) == expected)


def invalid_numbers(df: DataFrame) -> dict[str, int]:
    """NaN and infinite values per float column from a single pass."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    columns = [c for c in numeric_columns(df) if kinds[c].simpleString() in ("double", "float")]
    if not columns:
        return {}
    row = df.selectExpr(*[f"count_if({invalid_text(c, kinds[c])}) AS n{i}" for i, c in enumerate(columns)]).first()
    return {c: row[f"n{i}"] for i, c in enumerate(columns)}


def completeness(name: str, df: DataFrame, section: str = "schema", facts: TableFacts | None = None) -> list[Check]:
    """No nulls and no unusable numbers anywhere; both counted in the same pass, or known by ``facts``."""
    facts = facts or table_facts(df)
    nulls, invalid = (sorted(c for c, n in found.items() if n) for found in (facts.nulls, facts.invalid))
    return [
        Check(section, f"no_nulls.{name}", not nulls, {"columns": nulls}),
        Check(section, f"no_invalid_numeric.{name}", not invalid, {"columns": invalid}),
    ]


def sparse_columns(df: DataFrame, added: Sequence[str], limit: float, facts: TableFacts | None = None) -> dict[str, float]:
    """Null share of joined columns above the warning limit."""
    if not added:
        return {}
    if facts is None:
        row = df.selectExpr("count(1) AS n", *[f"count({quoted(c)}) AS v{i}" for i, c in enumerate(added)]).first()
        held, rows = {c: row[f"v{i}"] for i, c in enumerate(added)}, row["n"]
    else:
        held, rows = {c: facts.rows - facts.nulls[c] for c in added}, facts.rows
    rates = {c: (1 - held[c] / rows) if rows else 0.0 for c in added}
    return {c: r for c, r in rates.items() if r > limit}


def raw_table_checks(train, test, histories: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]], key: str, target: str) -> list[Check]:
    section = "raw_schema"
    checks = [
        required_columns("application_train", train.columns, [key, target], section),
        required_columns("application_test", test.columns, [key], section),
        target_presence("application_test", test.columns, target, False, section),
    ]
    for name, df in (("application_train", train), ("application_test", test)):
        if key in df.columns:
            checks.append(unique_key(name, df, key, section))
    if target in train.columns:
        checks.append(binary_target("application_train", train, target, section))
    checks += [required_columns(n, histories[n].columns, required[n], section) for n in required if n in histories]
    return checks


def final_table_checks(train: DataFrame, test: DataFrame, key: str, target: str, facts: tuple[TableFacts, TableFacts] | None = None) -> list[Check]:
    """With the ``facts`` of both tables only repeated keys need a job."""
    section, (of_train, of_test) = "final_schema", facts or (None, None)
    return [
        target_presence("final_train", train.columns, target, True, section),
        target_presence("final_test", test.columns, target, False, section),
        binary_target("final_train", train, target, section, of_train),
        unique_key("final_train", train, key, section),
        unique_key("final_test", test, key, section),
        same_columns("final_test", train.columns, test.columns, target, section),
        *completeness("final_train", train, section, of_train),
        *completeness("final_test", test, section, of_test),
    ]


def report(spark: SparkSession, checks: Sequence[Check]) -> DataFrame:
    rows = [(c.section, c.name, c.passed, json.dumps(c.detail, sort_keys=True)) for c in checks]
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def raise_on_failure(checks: Sequence[Check], label: str) -> None:
    failed = [c.name for c in checks if not c.passed]
    if failed:
        raise CheckFailure(f"{label} checks failed: {', '.join(failed)}")


def fingerprint(df: DataFrame) -> DataFrame:
    """(rows, content) of a table, independent of row order and file layout.

    The sum next to the xor keeps pairs of equal rows from cancelling out.
    """
    each = F.xxhash64(*[as_column(c) for c in sorted(df.columns)])
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(each).alias("content_xor"),
        F.sum(F.pmod(each, F.lit(1 << 31))).alias("content_sum"),
    )
