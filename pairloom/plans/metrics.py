"""Queries of the storage, batch and latency summaries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pairloom.functions.numeric import percent_reduction
from pairloom.operators import metrics
from pairloom.plans.layout import _batched_records
from pairloom.plans.layout_sql import _BATCHED
from pairloom.operators.loader import padded_dims
from pairloom.tables import table


def _records(spark, sf_dir):
    return table(spark, sf_dir, "shard_records").dropDuplicates(["shard_id", "local_index"])


def storage_footprint(spark, sf_dir):
    return metrics.storage(_records(spark, sf_dir)).withColumn("total_mb", F.round("total_mb", 4))


def pct_reduction(spark, sf_dir):
    s = metrics.storage(_records(spark, sf_dir))
    per = s.agg(F.max(F.when(F.col("strategy") == "fixed", F.col("image_bytes"))).alias("a"), F.max(F.when(F.col("strategy") == "dynamic", F.col("image_bytes"))).alias("b"))
    return per.select(F.round(percent_reduction(F.col("a"), F.col("b")), 4).alias("image_reduction_pct"))


def batch_memory(spark, sf_dir):
    """Mean memory of padded batches in MB, and mean cost proxies."""
    p = padded_dims(_batched_records(spark, sf_dir), "actual_width", "actual_height", "q_len", "a_len")
    return p.agg(
        F.count(F.lit(1)).alias("batches"),
        F.round(F.coalesce(F.avg(F.col("padded_pixels") * 3 * 4) / metrics.MEGABYTE, F.lit(0.0)), 6).alias("avg_image_mb"),
        F.round(F.coalesce(F.avg(F.col("batch_size") * F.col("max_t") * 16) / metrics.MEGABYTE, F.lit(0.0)), 6).alias("avg_text_mb"),
        F.round(F.avg(F.col("max_h") * F.col("max_w")), 4).alias("avg_hw"),
        F.round(F.avg("max_t"), 4).alias("avg_seq_len"),
    )


def latency_percentiles(spark, sf_dir):
    m = metrics.latency(table(spark, sf_dir, "events"), "event_type", "value")
    return m.select("event_type", "n", *[F.round(c, 6).alias(c) for c in ("mean_ms", "p50_ms", "p99_ms")])


def throughput_by_label(spark, sf_dir):
    t = metrics.throughput(table(spark, sf_dir, "events"), "event_type", "value")
    return t.select("event_type", "n", F.round("seconds", 4).alias("seconds"), F.round("per_second", 4).alias("per_second"))


def speedup(spark, sf_dir):
    t = metrics.throughput(table(spark, sf_dir, "events"), "event_type", "value")
    t = t.withColumn("first", F.min("event_type").over(Window.partitionBy(F.lit(1))))  # a row for each label
    return metrics.speedup(t, "per_second", F.col("event_type") == F.col("first")).select("event_type", F.round("speedup", 6).alias("speedup"))


def best_config(spark, sf_dir):
    t = metrics.throughput(table(spark, sf_dir, "events"), "event_type", "value")
    return t.agg(F.max_by("event_type", "per_second").alias("best"), F.round(F.max("per_second"), 4).alias("per_second"))


def results_by_size(spark, sf_dir):
    """Samples of each data set by size class, sorted by size."""
    s = table(spark, sf_dir, "samples").where("image_width > 0").groupBy(F.lower(F.trim("dataset_name")).alias("label"), F.floor(F.col("image_width") / 8).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct("size", "n")))
    return s.groupBy("label").agg(F.array_join(F.transform(pairs, lambda x: F.concat_ws(":", x["size"].cast("string"), x["n"].cast("string"))), " ").alias("sizes"))


QUERIES = [storage_footprint, pct_reduction, batch_memory, latency_percentiles, throughput_by_label, speedup, best_config, results_by_size]

_ONE = f"(SELECT shard_id, local_index, max(channels) AS c, max(actual_height) AS h, max(actual_width) AS w, max(q_len) AS q, max(a_len) AS a FROM shard_records GROUP BY shard_id, local_index)"
_STORE = f"""(SELECT 'fixed' AS strategy, count(*) AS samples, CAST(sum(CAST(c AS BIGINT) * 384 * 384 * 4) AS BIGINT) AS image_bytes, CAST(sum(8192) AS BIGINT) AS text_bytes, CAST(sum(64) AS BIGINT) AS overhead_bytes FROM {_ONE}
UNION ALL SELECT 'dynamic', count(*), CAST(sum(CAST(c AS BIGINT) * h * w) AS BIGINT), CAST(sum(16 * greatest(coalesce(q, 0), coalesce(a, 0), 1)) AS BIGINT), CAST(sum(72) AS BIGINT) FROM {_ONE})"""
_RATE = "(SELECT event_type, count(*) AS n, coalesce(sum(value), 0) / 1000 AS seconds, CASE WHEN coalesce(sum(value), 0) > 0 THEN count(*) / (sum(value) / 1000) ELSE 0 END AS per_second FROM events GROUP BY event_type)"
_PAD = f"(SELECT batch_id, count(*) AS n, max(h) AS mh, max(w) AS mw, greatest(1, max(greatest(coalesce(q, 0), coalesce(a, 0)))) AS t FROM {_BATCHED} GROUP BY batch_id)"

ORACLES = {
    "storage_footprint": f"SELECT *, round((image_bytes + text_bytes + overhead_bytes) / CAST(1048576 AS DOUBLE), 4) AS total_mb FROM {_STORE}",
    "pct_reduction": f"SELECT round(CASE WHEN a > 0 THEN (1 - CAST(b AS DOUBLE) / a) * 100 ELSE 0 END, 4) AS image_reduction_pct FROM (SELECT max(CASE WHEN strategy = 'fixed' THEN image_bytes END) AS a, max(CASE WHEN strategy = 'dynamic' THEN image_bytes END) AS b FROM {_STORE})",
    "batch_memory": f"SELECT count(*) AS batches, round(avg(CAST(n * mh * mw * 12 AS DOUBLE)) / 1048576, 6) AS avg_image_mb, round(avg(CAST(n * t * 16 AS DOUBLE)) / 1048576, 6) AS avg_text_mb, round(avg(CAST(mh * mw AS DOUBLE)), 4) AS avg_hw, round(avg(CAST(t AS DOUBLE)), 4) AS avg_seq_len FROM {_PAD}",
    "latency_percentiles": "SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean_ms, round(quantile_cont(value, 0.5), 6) AS p50_ms, round(quantile_cont(value, 0.99), 6) AS p99_ms FROM events GROUP BY event_type",
    "throughput_by_label": f"SELECT event_type, n, round(seconds, 4) AS seconds, round(per_second, 4) AS per_second FROM {_RATE}",
    "speedup": f"SELECT event_type, round(per_second / (SELECT per_second FROM {_RATE} WHERE event_type = (SELECT min(event_type) FROM events)), 6) AS speedup FROM {_RATE}",
    "best_config": f"SELECT arg_max(event_type, per_second) AS best, round(max(per_second), 4) AS per_second FROM {_RATE}",
    "results_by_size": "SELECT label, string_agg(size || ':' || n, ' ' ORDER BY size) AS sizes FROM (SELECT lower(trim(dataset_name)) AS label, CAST(floor(image_width / 8) AS BIGINT) AS size, count(*) AS n FROM samples WHERE image_width > 0 GROUP BY 1, 2) GROUP BY label",
}
