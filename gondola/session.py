"""Session settings for tests and benches, and the lineage cut used by the few operators
that must fix an intermediate result before reading it twice."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, memory: str = "8g", partitions: int | None = None, folder: str | None = None) -> SparkSession:
    """A local session as tests and benches use it; `folder` takes intermediate tables. A cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gondola")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = (spark.config("spark.checkpoint.dir", folder) if folder else spark).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own_folders: list[tempfile.TemporaryDirectory] = []
_scopes: list[str] = []


def checkpoint_folder(spark: SparkSession) -> None:
    """Uses the checkpoint folder the cluster names. Only a local master may fall back to a folder of this machine, which goes
    away with the process; on a cluster a missing setting is an error, because executors
    could not read each other's files after a loss."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        context.setCheckpointDir(named)
    elif context.master == "local" or context.master.startswith("local["):
        _own_folders.append(tempfile.TemporaryDirectory(prefix="gondola-checkpoint-", ignore_cleanup_errors=True))
        context.setCheckpointDir(_own_folders[-1].name)
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def table_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables and files of the `scratch` around the call, below the shared checkpoint folder."""
    checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/cuts/{_scopes[-1] if _scopes else 'unscoped'}"


def lineage_cut(df: DataFrame) -> DataFrame:
    """Writes `df` as a table into the shared checkpoint folder and reads it back: later reads, and retries
    after the loss of an executor, see the same rows, and the planner knows their size. Tables stay below
    `cuts` in that folder until the `scratch` around the call ends, or else until its owner clears it."""
    spark = df.sparkSession
    path = f"{table_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(cut: DataFrame) -> None:
    """Deletes the table of a `lineage_cut` that nothing reads any more: what was made of it is written."""
    files = cut.inputFiles()
    if files and "/cuts/" in files[0]:
        path = cut.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(cut.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Settings under which a job's shuffle files go when it ends, not when the driver collects its garbage, and tables are written smaller.
LITTLE_DISK = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def little_disk(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside leave no shuffle files behind. For chains of `lineage_cut`, each of which reads what the one before wrote."""
    before = {k: spark.conf.get(k) for k in LITTLE_DISK}
    try:
        for k, v in LITTLE_DISK.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


#: Rows of megabytes that are held at once.
FEW_ROWS = 8


@contextmanager
def few_rows_at_once(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside hand Python a few rows at a time. For tables whose rows hold long arrays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, str(FEW_ROWS))
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def few_rows_in_a_group(spark: SparkSession) -> Iterator[None]:
    """Tables that are written inside hold a few rows in each of their groups of rows. For rows of megabytes: a writer looks at its memory after a hundred
    rows, and a read decodes thousands at once where a group has them."""
    name = "parquet.block.row.count.limit"
    before = spark.conf.get(name, None)
    try:
        spark.conf.set(name, str(FEW_ROWS))
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


#: Rows that a task of a large shuffle takes, and the most tasks that are asked for.
TASK_ROWS, MOST_TASKS = 500_000, 50_000


def tasks_for(spark: SparkSession, rows: int | None) -> int | None:
    """Tasks that a shuffle of `rows` rows needs, where that is more than the session's own number."""
    wanted = min(MOST_TASKS, math.ceil((rows or 0) / TASK_ROWS))
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


@contextmanager
def sized_shuffles(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Jobs that run inside (a `lineage_cut`, a `head`) shuffle `rows` rows to as many tasks as take `TASK_ROWS` each, so that what a task sorts or holds
    does not grow with the input. The session's own number holds where it is enough, and again afterwards. Groups are still summed
    before the shuffle, and skewed joins are still split."""
    wanted = tasks_for(spark, rows)
    if not wanted:
        yield
        return
    # adaptive execution would merge the partitions again, up to a size that is a multiple in memory
    asked = {"spark.sql.shuffle.partitions": str(wanted), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in asked}
    try:
        for k, v in asked.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the intermediate tables of the queries built inside when it ends; their results must be written by then."""
    _scopes.append(uuid.uuid4().hex)
    try:
        yield
    finally:
        name = _scopes.pop()
        folder = spark.sparkContext.getCheckpointDir()
        if folder:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/cuts/{name}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
