"""Session settings and the shared folder that every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Spark then removes the shuffle files of a query as soon as it has ended.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "topicweave", master: str | None = None, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.files.openCostInBytes", "1m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables: ``spark.checkpoint.dir``, for every master alike."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """For writes of tables: the shuffle files behind a table go when it is written, not when the driver happens to collect garbage."""
    before = spark.conf.get(CLEANED, None)
    spark.conf.set(CLEANED, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANED) if before is None else spark.conf.set(CLEANED, before)


def write_table(df, path: str, mode: str = "overwrite", by: tuple[str, ...] = ()) -> None:
    """``df`` as parquet, without leaving shuffle files."""
    with shuffles_removed(df.sparkSession):
        df.write.mode(mode).parquet(path, partitionBy=list(by) or None)


def remove_table(spark: SparkSession, path: str) -> None:
    """Remove a table below the shared folder that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df, label: str):
    """Cut the lineage of ``df``: write it once below the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    write_table(df, path, "errorifexists")
    return spark.read.schema(df.schema).parquet(path)
