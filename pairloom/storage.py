"""Shared-folder tables: how a plan cuts lineage so that it survives lost executors.

Intermediate results that are used more than once are written as Parquet into
the folder every executor can reach (``spark.checkpoint.dir``) and read back.
Nothing is kept on one machine only and ``localCheckpoint`` is never used.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share.

    The session's ``spark.checkpoint.dir`` wins. Only where it is unset, and all
    executors are threads of this machine (tests), a temporary folder is made, one
    for each application.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        if context.applicationId not in _OWN:
            _OWN[context.applicationId] = tempfile.mkdtemp(prefix="pairloom-")
        base = _OWN[context.applicationId]
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """Fresh path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/pairloom/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, for work that costs far more than its input's bytes tell.

    A small table may be one file and so one task. Scans of as many tasks as cores are
    left as they are, and so are plans that shuffle, whose tasks are Spark's to
    choose: asking for them would run the shuffles.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def grouped(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` shuffled by ``keys`` for work that costs far more than its input's bytes tell.

    Spark joins small shuffle partitions into few tasks by their bytes; a stated
    number of partitions it leaves alone. A grouping by the same keys needs no other
    shuffle.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), *keys)


def _located(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a path of the shared folder, if it is there."""
    fs, target = _located(spark, path)
    fs.delete(target, True)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it is not there."""
    fs, target = _located(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, target = _located(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file as a whole: under another name, then by one rename. FileExistsError if the name is taken."""
    fs, target = _located(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    _, draft = _located(spark, f"{target.getParent().toString()}/.{uuid.uuid4().hex}")
    stream = fs.create(draft)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(path)
