"""Reading source rows: Parquet, JSON, ORC, CSV, or a folder of image files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.operators.ingest import first_with_rows

FORMATS = ("parquet", "json", "orc", "csv")


def read_rows(spark: SparkSession, path: str, fmt: str = "parquet", row_index: str = "row_index") -> DataFrame:
    """Rows with ``row_index``. A table without that column is numbered in the order of its files' names and, inside
    a file, of its rows: the task's first number plus the place in the task.

    Spark reads splits in any order, so the number of rows of each split is asked for
    first (one narrow pass, without the other columns).
    """
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {FORMATS}")
    df = spark.read.format(fmt).options(**({"header": "true"} if fmt == "csv" else {})).load(path)
    if row_index in df.columns:
        return df
    at = F.monotonically_increasing_id()
    marked = df.withColumns({"__f": F.col("_metadata.file_path"), "__s": F.col("_metadata.file_block_start"), "__k": at})
    # Places inside a split are consecutive numbers from the split's first one on.
    splits = marked.groupBy("__f", "__s").agg(F.count(F.lit(1)).alias("__n"), F.min("__k").alias("__first"))
    before = F.sum("__n").over(Window.orderBy("__f", "__s").rowsBetween(Window.unboundedPreceding, -1))
    starts = splits.select("__f", "__s", "__first", F.coalesce(before, F.lit(0)).alias("__o"))  # a row for each split
    numbered = marked.join(F.broadcast(starts) if _few(starts) else starts, ["__f", "__s"])
    return numbered.withColumn(row_index, F.col("__o") + F.col("__k") - F.col("__first")).select(*df.columns, row_index)


def _few(splits: DataFrame, most: int = 1_000_000) -> bool:
    return splits.limit(most + 1).count() <= most


def read_first(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """The first of several sources that has rows."""
    return first_with_rows([lambda p=p: read_rows(spark, p, fmt) for p in paths])


def read_images(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, width, height, channels, pixels) of image files through the JVM's decoders; pixels are RGB bytes,
    height x width x channels. Files that cannot be decoded have width -1."""
    df = spark.read.format("image").option("pathGlobFilter", pattern).load(folder)
    swap = F.pandas_udf(lambda data, n: data.combine(n, _rgb), "binary")
    return df.select(F.col("image.origin").alias("path"), F.col("image.width").alias("width"), F.col("image.height").alias("height"), F.col("image.nChannels").alias("channels"), swap("image.data", "image.nChannels").alias("pixels"))


def _rgb(data: bytes | None, channels: int) -> bytes | None:
    """Bytes of blue, green, red (, alpha) pixels in the order red, green, blue."""
    import numpy as np

    if not data or channels < 3:
        return data
    return np.frombuffer(data, np.uint8).reshape(-1, channels)[:, [2, 1, 0]].tobytes()
