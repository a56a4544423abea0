"""Session factory and the few settings the operators read from a session."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def make_session(master: str = "local[*]", partitions: int = 8, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution, for tests, benches and notebooks."""
    builder = (
        SparkSession.builder.master(master)
        .appName("tallyspark")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


_SHIPPED: set[str] = set()


def ship(spark: SparkSession | None = None) -> SparkSession | None:
    """Sends the package to the workers of a session, once, so that they can import it whatever folder the driver was started in."""
    spark = spark or SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext.applicationId not in _SHIPPED:
        _SHIPPED.add(spark.sparkContext.applicationId)
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="tallyspark-code-")
        atexit.register(shutil.rmtree, folder, True)
        archive = Path(folder, "tallyspark.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster. Only a local master, where one machine does all, may go without: a folder of its own is made."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tallyspark-"))
    return context._jsc.sc().getCheckpointDir().get()


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` over all cores where its scan is too narrow to keep them busy: one file of one row group is one task. Rows are dealt by the hash of ``key``, so a task run again gets the same rows."""
    ship(df.sparkSession)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if 2 * df.rdd.getNumPartitions() > cores else df.repartition(cores, key)


BROADCAST_ROWS = 100_000


def join_counted(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", most: int = BROADCAST_ROWS) -> DataFrame:
    """A join that broadcasts ``right`` only if its rows, counted here, are ``most`` or fewer, and else sorts and merges.

    For tables whose size Spark can't foretell, such as what Python functions or filters leave over; ``right`` is read twice, so it should be narrow or written.
    """
    few = right.limit(most + 1).count() <= most
    return left.join(right.hint("broadcast" if few else "merge"), on, how)


_WRITTEN: list[tuple[SparkSession, str]] = []


def materialise(df: DataFrame) -> DataFrame:
    """``df`` as a table written once to the shared folder: lineage and plan end there, and lost executors cost nothing.

    The tables of a session are removed when its driver ends.
    """
    spark = ship(df.sparkSession)
    path = f"{ensure_checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _WRITTEN:
        atexit.register(_remove_written)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _remove_written() -> None:
    for spark, path in _WRITTEN:
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:
            return  # the session has ended before the driver: the shared folder is cleaned with it
