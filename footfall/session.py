"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # The zone of the data: calendar parts follow it.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
STATIC_SETTINGS = {
    # No call site per expression: the wide tables have thousands of expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.codegen.cache.maxEntries": "1000",
}


def configure(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Settings the jobs want, on a session made elsewhere."""
    for key, value in (SETTINGS | {"spark.sql.session.timeZone": time_zone}).items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; on a cluster use the one submitted with the job."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("footfall")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        # Small data on one machine: keep every core busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in (SETTINGS | STATIC_SETTINGS).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder every executor shares, for a table written between two jobs.

    The cluster names the folder in `spark.checkpoint.dir`. Where it names none, a session on one machine,
    as in tests, sets and uses a folder there; on a cluster that would lose parts, so it is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="footfall-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for scope in _scopes.get():
        scope.append(path)
    return path


#: The open scopes of this thread or task: jobs that run side by side don't see each other's.
_scopes: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scopes", default=())


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made inside the block at its end; what it returns must not read them."""
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in paths:
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(table: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write a table that several jobs read, and read it back: lost executors cost no recomputation."""
    path = scratch_path(table.sparkSession, name)
    table.write.options(**(options or {})).parquet(path)
    return table.sparkSession.read.parquet(path)
