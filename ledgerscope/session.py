"""Session construction and lineage checkpoints.

Library code never sets cluster-wide options on a session it is handed; the few
options of the session that it changes for a while (``shuffles_for``, ``options``) are put
back. The builder below is for tests, the benchmark and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "ledgerscope") -> SparkSession:
    master = master or os.environ.get("LEDGERSCOPE_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEDGERSCOPE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared, fault-tolerant folder and is used
    as is. Only when it is unset (local tests) do we make a scratch folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not path:
        path = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not path and not master.startswith("local"):
        # executors would each write to a disk of their own, and later reads miss those rows
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master}")
    if not path:
        path = tempfile.mkdtemp(prefix="ledgerscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


#: Rows that a task sorts at most on average while a derived table is written.
ROWS_A_TASK = 500_000
#: Shuffled bytes that Spark may join into one task meanwhile: about a million rows of the
#: ledger, which carries 32 bytes a row to its last join and sorts some 300 after it.
BYTES_A_TASK = 32 << 20


@contextmanager
def shuffles_for(spark: SparkSession, rows: int):
    """Raises the session's number of shuffle partitions to what ``rows`` need, and lowers
    the size up to which Spark joins them again, until the block ends. A fixed number gives
    tasks that grow with the ledger, and partitions joined by their narrow shuffled size
    undo a raised one: once a task's rows outgrow its memory every sort spills all of them.
    Spark still joins small partitions and splits hot ones, which it does not do for a
    ``repartition(n)``."""
    parts, size = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    was = {parts: spark.conf.get(parts, "200"), size: spark.conf.get(size, "64m")}
    put = {}
    if (need := -(-rows // ROWS_A_TASK)) > int(was[parts]):
        put[parts] = str(need)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(was[size]) > BYTES_A_TASK:
        put[size] = f"{BYTES_A_TASK}b"
    try:
        for name, value in put.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name in put:
            spark.conf.set(name, was[name])


@contextmanager
def options(spark: SparkSession, put: dict[str, str]):
    """Sets options of the session until the block ends."""
    was = {name: spark.conf.get(name, None) for name in put}
    try:
        for name, value in put.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in was.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: Spark drops the shuffle files of a job's plan with the job, not when the driver collects garbage.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

_PASSING: ContextVar[list | None] = ContextVar("passing", default=None)


@contextmanager
def passing_cuts(spark: SparkSession):
    """Every ``cut_lineage`` of the block goes when it ends: for work whose result is
    written elsewhere by then, or is a few values. Blocks may lie inside each other; the
    function given cuts what outlives the block and belongs to the one around it."""
    mine: list[str] = []
    outer = _PASSING.get()
    token = _PASSING.set(mine)

    def keep(df: DataFrame) -> DataFrame:
        inner = _PASSING.set(outer)
        try:
            return cut_lineage(df)
        finally:
            _PASSING.reset(inner)

    try:
        yield keep
    finally:
        _PASSING.reset(token)
        for path in mine:
            drop_cut(spark, path)


def drop_cut(spark: SparkSession, path: str) -> None:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared checkpoint folder and read back.

    Used by iterative jobs so that a lost executor rereads the last written round
    instead of replaying from the first scan. Parquet rather than ``checkpoint()``:
    what is read back has the size of its files, while a checkpoint keeps the
    estimate of its plan, and estimates of joins multiply round by round until
    planning, not running, takes the time.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cuts/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    if _PASSING.get() is not None:
        _PASSING.get().append(path)
    with options(spark, DROP_SHUFFLES):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
