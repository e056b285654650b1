"""Storage, batch and latency summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.numeric import per_second
from pairloom.storage import materialize

MEGABYTE = 1048576


def storage(records: DataFrame, fixed_side: int = 384, fixed_tokens: int = 512) -> DataFrame:
    """(strategy, samples, image_bytes, text_bytes, overhead_bytes, total_mb) of fixed and of per-sample sizes."""
    c = F.col
    tokens = F.greatest(F.coalesce(c("q_len"), F.lit(0)), F.coalesce(c("a_len"), F.lit(0)), F.lit(1))
    ways = F.array(
        F.struct(F.lit("fixed").alias("strategy"), (c("channels").cast("bigint") * fixed_side * fixed_side * 4).alias("i"), F.lit(4 * fixed_tokens * 4).cast("bigint").alias("t"), F.lit(64).cast("bigint").alias("o")),
        F.struct(F.lit("dynamic").alias("strategy"), (c("channels").cast("bigint") * c("actual_height") * c("actual_width")).alias("i"), (tokens * 16).cast("bigint").alias("t"), F.lit(72).cast("bigint").alias("o")),
    )
    return (
        records.select(F.explode(ways).alias("x"))
        .groupBy("x.strategy")
        .agg(F.count(F.lit(1)).alias("samples"), F.sum("x.i").alias("image_bytes"), F.sum("x.t").alias("text_bytes"), F.sum("x.o").alias("overhead_bytes"))
        .withColumn("total_mb", (F.col("image_bytes") + F.col("text_bytes") + F.col("overhead_bytes")) / MEGABYTE)
    )


#: More labels than this are refused: their bounds are broadcast.
MOST_LABELS = 10_000
#: One over the rank error of the sketch that narrows a quantile down.
ACCURACY = 10_000


def quantiles(df: DataFrame, label: str, value: str, shares: dict[str, float], small: int = 200_000) -> DataFrame:
    """(label, n, mean, one column for each share): exact quantiles with linear interpolation.

    A sketch bounds each quantile from both sides; values below the bounds are
    only counted, and only those between them (some ten-thousandths of the rows)
    are ordered, as a table of values and counts. So a label that holds most rows
    is not gathered in a task. Labels of at most ``small`` values are ordered whole.
    Null values are left out; a label without values has n 0 and nulls.
    """
    rows = df.select(F.col(label).alias("__l"), F.col(value).cast("double").alias("__v"))
    eps = 4 / ACCURACY
    sketch = lambda p: F.percentile_approx("__v", F.lit(min(max(p, 0.0), 1.0)), ACCURACY)
    bounds = []
    for name, p in shares.items():
        few = F.count("__v") <= small
        bounds += [F.when(few | F.lit(p <= eps), F.min("__v")).otherwise(sketch(p - eps)).alias(f"{name}__a"), F.when(few | F.lit(p >= 1 - eps), F.max("__v")).otherwise(sketch(p + eps)).alias(f"{name}__b")]
    stats = rows.groupBy("__l").agg(F.count("__v").alias("n"), F.avg("__v").alias("mean"), *bounds)
    stats = materialize(stats, "quantile-bounds")
    if stats.limit(MOST_LABELS + 1).count() > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    near = rows.where("__v is not null").join(F.broadcast(stats.withColumnRenamed("__l", "__k")), F.col("__l").eqNullSafe(F.col("__k")))
    each = F.array(*[F.struct(F.lit(k).alias("q"), F.lit(p).alias("p"), F.col(f"{k}__a").alias("a"), F.col(f"{k}__b").alias("b")) for k, p in shares.items()])
    near = near.select("__l", "__v", "n", F.explode(F.filter(each, lambda e: F.col("__v") <= e["b"])).alias("e"))
    # All values below a bound become one row.
    table = near.groupBy("__l", "e.q", "e.p", "n", F.when(F.col("__v") >= F.col("e.a"), F.col("__v")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("__l", "q").orderBy(F.asc_nulls_first("v")))
    at = F.col("p") * (F.col("n") - 1)
    table = table.withColumn("upto", upto)
    pick = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("v")))
    found = table.groupBy("__l", "q", "p", "n").agg(pick(F.floor(at)).alias("x"), pick(F.ceil(at)).alias("y"))
    part = at - F.floor(at)
    found = found.select("__l", "q", (F.col("x") + (F.col("y") - F.col("x")) * part).alias("z"))
    wide = found.groupBy("__l").pivot("q", list(shares)).agg(F.first("z"))
    return stats.select(F.col("__l").alias("__k"), "n", "mean").join(wide, F.col("__k").eqNullSafe(F.col("__l")), "left").select(F.col("__k").alias(label), "n", "mean", *shares)


def latency(df: DataFrame, label: str, value: str) -> DataFrame:
    """(label, n, mean_ms, p50_ms, p99_ms) with linear interpolation, exactly."""
    return quantiles(df, label, value, {"p50_ms": 0.5, "p99_ms": 0.99}).withColumnRenamed("mean", "mean_ms")


def throughput(df: DataFrame, label: str, millis: str) -> DataFrame:
    """(label, n, seconds, per_second)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), (F.coalesce(F.sum(millis), F.lit(0)) / 1000).alias("seconds")).withColumn("per_second", per_second(F.col("n"), F.col("seconds")))


def speedup(df: DataFrame, value: str, baseline: Column) -> DataFrame:
    """``df`` (a few rows) with each value's ratio to the baseline row's."""
    first = F.max(F.when(baseline, F.col(value))).over(Window.partitionBy())
    return df.withColumn("speedup", F.when(first > 0, F.col(value) / first))
