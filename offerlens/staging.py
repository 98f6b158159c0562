"""Intermediate tables written to the checkpoint folder shared by the cluster.

A staged frame is a Parquet table: it survives the loss of executors, cuts the
lineage, and later scans still get column pruning and filter pushdown.
"""

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_CONF = "spark.checkpoint.dir"
#: Spark deletes the shuffle files of a query when it ends, not when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scopes: list[str] = []


def stage_root(spark: SparkSession) -> str:
    """The folder of this application below the checkpoint folder of the session.

    Without ``spark.checkpoint.dir`` the warehouse takes its place; like the checkpoint
    folder, a cluster keeps it where every executor can reach it.
    """
    context = spark.sparkContext
    root = spark.conf.get(_CONF, "") or context.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/offerlens/{context.applicationId}"


def new_stage_path(spark: SparkSession, label: str) -> str:
    return "/".join([stage_root(spark), *_scopes, f"{label}-{uuid4().hex}"])


def _delete(spark: SparkSession, folder) -> None:
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _folder(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder; none where it is missing."""
    folder = _folder(spark, path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def drop_stages(spark: SparkSession) -> None:
    """Delete everything this application staged; frames that read it become invalid."""
    _delete(spark, _folder(spark, stage_root(spark)))


def drop_stage(staged: DataFrame) -> None:
    """Delete the table behind one staged frame, once nothing reads it any more."""
    files = staged.inputFiles()
    if files:
        _delete(staged.sparkSession, _folder(staged.sparkSession, files[0]).getParent())


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Whatever is staged inside is deleted at the end; store results outside before."""
    _scopes.append(f"scope-{uuid4().hex}")
    path = "/".join([stage_root(spark), *_scopes])
    try:
        yield
    finally:
        _scopes.pop()
        _delete(spark, _folder(spark, path))


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a frame that reads it back; nothing it shuffled stays on disk."""
    path = new_stage_path(df.sparkSession, label)
    with _shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, label: str, key: str, buckets: int) -> str:
    """Write ``df`` once as a table bucketed by ``key``, whose joins and groups need no shuffle; the name of the table."""
    name = f"stage_{uuid4().hex}"
    with _shuffles_deleted(df.sparkSession):
        df.write.bucketBy(buckets, key).option("path", new_stage_path(df.sparkSession, label)).saveAsTable(name)
    return name


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table of ``stage_bucketed`` with its files, once nothing reads it any more."""
    drop_stage(spark.table(name))
    spark.sql(f"DROP TABLE {name}")


def stage_observed(df: DataFrame, label: str, *metrics: Column) -> tuple[DataFrame, dict]:
    """``stage`` plus aggregates taken while writing, without another pass."""
    observation = Observation(label)
    staged = stage(df.observe(observation, *metrics), label)
    return staged, observation.get


def _cores(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def spread(staged: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition a staged frame over every core, for a step that multiplies its rows.

    Partitions are sized by bytes, so a frame that is small before it is multiplied
    would be left to a task or two. Keys must be distinct rows, so that no partition
    is hot.
    """
    tasks = max(2 * _cores(staged), staged.rdd.getNumPartitions())
    # Plain keys would be merged into the shuffle of a preceding aggregation.
    return staged.repartition(tasks, F.xxhash64(*keys))
