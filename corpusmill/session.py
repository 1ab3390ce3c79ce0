"""Session helpers, table loading and lineage cuts."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_OWN_STAGES: list[tuple[SparkSession, str]] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir says. A local session without the
    setting gets a folder of its own; on a cluster it has to be set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="corpusmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame, name: str, observed: Observation | None = None, *metrics: Column) -> DataFrame:
    """Write df once to the shared folder and read it back; with an observation its metrics come from
    the same job.

    Cuts the lineage in a way that survives lost executors, keeps column pruning and gives AQE
    real sizes. The files go when the session's Python process ends.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    (df.observe(observed, *metrics) if observed else df).write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh place in the shared folder for files in other formats; it goes with the session."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _OWN_STAGES:
        atexit.register(_drop_stages)
    _OWN_STAGES.append((spark, path))
    return path


def drop_stage(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    files = {str(Path(f).parent) for f in df.inputFiles()}
    for spark, path in list(_OWN_STAGES):
        if any(f.endswith(path.removeprefix("file://")) for f in files):
            _delete(spark, path)
            _OWN_STAGES.remove((spark, path))


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _drop_stages() -> None:
    for spark, path in _OWN_STAGES:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone already; its folder then goes with it
            pass


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Rows over as many tasks as the session shuffles into, for work that is costly per row: AQE
    would merge partitions that are small in bytes into one task. The rows go by a hash of the
    columns, as a repartition by the very columns of a distinct before it would be optimized away."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *([F.xxhash64(*cols)] if cols else []))


def widened(df: DataFrame) -> DataFrame:
    """A scan with fewer tasks than the session has cores (a small or single file) over so many tasks,
    for work that is costly per row; others as they are, so large tables are not shuffled for it."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= n else df.repartition(n)


def bounded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast df only if it is proven to have at most so many rows; else leave the join to AQE."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
