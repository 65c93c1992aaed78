"""Session set-up and durable hand-over points between jobs."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # category names become column names, and may differ only in case
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # call sites of every column expression are costly to record and not needed
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: For settled numbers: a sixth less room than the default, in the same time.
DENSE = "zstd"
#: Rows of one task where a table is spread.
TASK_ROWS = 40_000


def local_session(cores: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("riskloom")
    settings = {
        **SESSION_DEFAULTS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": memory,
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return name_shared_folder(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A missing setting is an error, because a machine-local folder would be lost
    together with its machine. ``name_shared_folder`` sets one for sessions that
    have a single machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return named


def name_shared_folder(spark: SparkSession) -> SparkSession:
    """Names a temporary folder if none is named and the session is on one machine; it goes when Python ends."""
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir() and context.master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="riskloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return spark


@contextmanager
def partitions_for(spark: SparkSession, rows: int, of_task: int) -> Iterator[None]:
    """Shuffles of the jobs run within have a partition for each ``of_task`` rows at least.

    A session's number suits no table size; with too few, tasks that hold wide rows spill them. Adaptive execution joins
    partitions that turn out small.
    """
    key, least = "spark.sql.shuffle.partitions", -(-rows // of_task)
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), least)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def check_distinct_names(spark: SparkSession, names) -> None:
    """Generated column names must stay apart under the session's case rule."""
    if spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true":
        return
    seen: dict[str, str] = {}
    for n in names:
        other = seen.setdefault(n.lower(), n)
        if other != n:
            raise ValueError(f"columns {other!r} and {n!r} differ only in case; set spark.sql.caseSensitive=true")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, never overwritten."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "table", codec: str | None = None) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Used where several jobs follow one expensive plan. The table survives lost
    executors, cuts the lineage, and stays prunable by column. ``codec`` is for
    tables that take much room; by default the session's holds.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    settled = df.sparkSession.read.schema(df.schema).parquet(path)
    settled._settled_path = path
    return settled


def spread(df: DataFrame, label: str = "spread") -> DataFrame:
    """``df`` written in parts of about TASK_ROWS rows, if it has more rows than that.

    A file is read by as many tasks as it has row groups, so one with a single
    large group gives all rows to one task, here and in every job that follows.
    """
    parts = -(-df.count() // TASK_ROWS)
    return settle(df.repartition(parts), label) if parts > 1 else df


def discard(*tables: DataFrame) -> None:
    """Deletes the files of settled tables that no one reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._settled_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
