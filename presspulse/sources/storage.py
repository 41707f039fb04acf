"""Reading and writing tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Collection
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presspulse.schemas import conform

# Dimensions up to this many rows are broadcast; larger ones are joined by shuffling.
MAX_BROADCAST_ROWS = 50_000
# Keys of rows (company, day, order) up to this many are broadcast to pick whole rows, which are then not shuffled.
MAX_BROADCAST_KEYS = 500_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder, since there driver and executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        existing = spark.sparkContext.getCheckpointDir()
        if existing:
            return existing
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="presspulse-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh location for one intermediate table."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of executors and the plan starts anew.

    Shuffle files of the plan behind it serve nothing more, so Spark is told to remove them when the
    checkpoint is done; else those of every round of an iteration stay until the driver collects garbage.
    """
    spark = df.sparkSession
    shared_dir(spark)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # the setting is read when a frame is made
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after counting; a larger table is left to an ordinary shuffled join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_if_narrow(df: DataFrame) -> DataFrame:
    """Spread a scan with fewer splits than cores over all cores, ahead of heavy per-row work.

    Expects a plain scan. A large table has more splits than cores and is returned as it is, without
    a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt_for_texts(df: DataFrame, key: str) -> DataFrame:
    """Narrow rows dealt by ``key``, ahead of a join with whole texts and work on these. The number of parts is
    fixed, since adaptive execution would merge them by the size of the narrow rows."""
    spark = df.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, key)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Typed read that yields an empty table when nothing has been stored yet."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_rows(df: DataFrame, path: str, schema: T.StructType, partition: str | None = "News_Date") -> int:
    """Append rows in the table's own shape; returns their number, counted on the way. Earlier files are never
    rewritten, and Spark's commit protocol publishes the new files together, so a failed run leaves the table
    as it was."""
    seen = Observation()
    writer = conform(df, schema).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append")
    if partition:
        writer = writer.partitionBy(partition)
    writer.parquet(path)
    return seen.get["rows"]


def replace_days(df: DataFrame, path: str, schema: T.StructType, partition: str = "News_Date") -> None:
    """Write whole days, replacing just the partitions present in ``df``, so that a repeated run
    does not duplicate its rows."""
    (
        conform(df, schema)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


# --- tables that runs replace by range of days ---------------------------------------------------
#
# Below the table's path:
#   write=<id>/<day column>=<day>/   the files of one write
#   _claims/<version>                taken by one writer each
#   _log/block=<n>/                  one row a finished write: its range, and the days that have rows; without
#                                    a range it replaces just these days
#   _snapshot/version=<version>/     the folder of each day after that version

LOG = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("first", T.DateType()),
        T.StructField("last", T.DateType()),
        T.StructField("days", T.ArrayType(T.DateType())),
        T.StructField("rows", T.LongType()),
        T.StructField("block", T.LongType()),
    ]
)
STATE = T.StructType([T.StructField("day", T.DateType()), T.StructField("folder", T.StringType())])
SNAPSHOT_EVERY = 16


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder of any file system that Spark reaches; none if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def _numbers(spark: SparkSession, folder: str, prefix: str = "") -> list[int]:
    found = (n.removeprefix(prefix) for n in _names(spark, folder) if n.startswith(prefix))
    return sorted(int(n) for n in found if n.isdigit())


def _create_first(spark: SparkSession, file: str) -> bool:
    """Create an empty file; False if it is there. Of several at once, one gets True."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        if fs.getScheme() != "file":
            return fs.createNewFile(path)
        # Hadoop's local file system looks and then creates; the operating system does both at once
        fs.mkdirs(path.getParent())
        none = spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0)
        jvm.java.nio.file.Files.createFile(jvm.java.nio.file.Paths.get(fs.makeQualified(path).toUri()), none)
        return True
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def claim_version(spark: SparkSession, path: str) -> int:
    """The next version of a table. Its claim file is created without overwriting, so that of several
    writers one gets it and the others go on to later ones."""
    version = max(_numbers(spark, f"{path}/_claims"), default=0) + 1
    while not _create_first(spark, f"{path}/_claims/{version}"):
        version += 1
    return version


def _log(spark: SparkSession, path: str, after: int = 0) -> list[Row]:
    """Finished writes of later versions than ``after``, in order."""
    rows = read_or_empty(spark, f"{path}/_log", LOG)
    later = rows.where((F.col("block") >= after // SNAPSHOT_EVERY) & (F.col("version") > after))
    return sorted(later.collect(), key=lambda r: r["version"])  # fewer than two blocks, unless an old state is asked for


def _state(spark: SparkSession, path: str, back: int = 0) -> dict[date, str]:
    """The folder that holds each day: the newest fitting snapshot and the few writes since then."""
    snapshots = _numbers(spark, f"{path}/_snapshot", "version=")
    if back:
        versions = [r["version"] for r in _log(spark, path)]
        until = versions[-back - 1] if back < len(versions) else 0
    else:
        until = math.inf
    base = max((v for v in snapshots if v <= until), default=0)
    state = {}
    if base:
        state = {r["day"]: r["folder"] for r in read_or_empty(spark, f"{path}/_snapshot/version={base}", STATE).collect()}  # a row a day
    for r in _log(spark, path, base):
        if r["version"] <= until:
            kept = state if r["first"] is None else {d: f for d, f in state.items() if not r["first"] <= d <= r["last"]}
            state = kept | dict.fromkeys(r["days"], r["folder"])
    return state


def _commit(spark: SparkSession, path: str, folder: str, first: date | None, last: date | None, days: list[date], rows: int) -> int:
    """Publish a finished write as the table's next version."""
    while True:
        version = claim_version(spark, path)
        row = (version, folder, first, last, days, rows, version // SNAPSHOT_EVERY)
        spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").partitionBy("block").parquet(f"{path}/_log")
        if max(_numbers(spark, f"{path}/_snapshot", "version="), default=0) < version:
            break  # else a snapshot passed this version by before it was in the log
    if version % SNAPSHOT_EVERY == 0:
        logged = {r["version"] for r in _log(spark, path, version - SNAPSHOT_EVERY)}
        if logged >= set(range(version - SNAPSHOT_EVERY + 1, version + 1)):  # no writer is still between claim and log
            state = sorted(_state(spark, path).items())
            spark.createDataFrame(state, STATE).coalesce(1).write.parquet(f"{path}/_snapshot/version={version}")
    return version


def replace_range(df: DataFrame, path: str, schema: T.StructType, start: date, end: date, partition: str = "News_Date") -> int:
    """Replace all days from ``start`` to ``end`` by ``df``, days without new rows included; returns the rows
    written, counted on the way.

    Every write is a folder of its own, which a log row publishes as the table's next version once it is
    complete. Readers take each day from the newest version that covers it, so a failed run changes nothing,
    nothing stale is left, and the state before is kept.
    """
    within = conform(df, schema).where(F.col(partition).between(start, end))
    folder, days, rows = _write_days(within, path, partition)
    _commit(df.sparkSession, path, folder, start, end, days, rows)
    return rows


def replace_listed(df: DataFrame, path: str, schema: T.StructType, partition: str = "News_Date") -> int:
    """Replace the days that ``df`` has rows of, and no others, as the next version of a table as
    ``replace_range`` writes it; returns the rows written. A day's rows go to few files, a large day's to more."""
    folder, days, rows = _write_days(conform(df, schema).where(F.col(partition).isNotNull()).hint("rebalance", partition), path, partition)
    if days:
        _commit(df.sparkSession, path, folder, None, None, days, rows)
    return rows


def _write_days(df: DataFrame, path: str, partition: str) -> tuple[str, list[date], int]:
    """Write a folder that no version holds yet; its name, its days and the number of rows."""
    folder = f"write={uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy(partition).parquet(f"{path}/{folder}")
    names = _names(df.sparkSession, f"{path}/{folder}")
    days = sorted(date.fromisoformat(n.removeprefix(f"{partition}=")) for n in names if n.startswith(f"{partition}="))
    return folder, days, seen.get["rows"] if days else 0


def read_range_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition: str = "News_Date",
    back: int = 0,
    start: date | None = None,
    end: date | None = None,
    days: Collection[date] | None = None,
) -> DataFrame:
    """Rows of a table written by ``replace_range``; ``back`` leaves out that many of the last writes.

    The plan is one scan of the days' folders, of those from ``start`` to ``end`` or of ``days`` if given,
    however many writes there were.
    """
    held = sorted(
        (d, f)
        for d, f in _state(spark, path, back).items()
        if (not start or d >= start) and (not end or d <= end) and (days is None or d in days)
    )
    if not held:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/{folder}/{partition}={day.isoformat()}" for day, folder in held]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(schema.fieldNames())


def day_folders(spark: SparkSession, path: str) -> dict[date, str]:
    """The folder that now holds each day of a table written by ``replace_range``; it changes when the day is replaced."""
    return _state(spark, path)


def newest_finished(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest complete write below ``path``, of those made by ``write_next``."""
    for version in reversed(_numbers(spark, path, "version=")):
        if "_SUCCESS" in _names(spark, f"{path}/version={version}"):
            return f"{path}/version={version}"
    return None


def write_next(df: DataFrame, path: str) -> None:
    """Write a small table as a whole, as the next version of it."""
    version = claim_version(df.sparkSession, path)
    df.coalesce(1).write.parquet(f"{path}/version={version}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)
