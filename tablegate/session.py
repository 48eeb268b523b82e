"""Session settings, and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sizes of shuffle partitions are left to AQE: start wide, coalesce to the
# advisory size, split what is skewed.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}

# What may be broadcast once its size has been measured.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def get_session(app_name: str = "tablegate", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may run without that setting; it then gets a private
    temporary folder. On a cluster such a folder would be out of the executors'
    reach, so there the missing setting is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="tablegate-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Write once as Parquet in the shared folder, read it back, drop it at the end.

    Unlike :func:`materialize` the result keeps column pruning, pushed filters
    and true file sizes, so it suits wide frames that are read several times.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes of a small materialised frame."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns),
        F.lit(0),
    )
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).first()
    return row["n"], row["bytes"] or 0


def read_if_exists(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The Parquet table at ``path``, or None when nothing was written yet.

    Without a schema the footers of all files are merged (a distributed job), as
    a column added later is missing from older files and must not be lost.
    """
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
