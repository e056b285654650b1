"""Queries of this folder's operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import copies, lookalikes, mixing, packing, pairs, reading, repetition
from pairloom.plans.ingest import sql_has
from pairloom.tables import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.changed_texts(table(spark, sf_dir, "samples")).select("row_index", "field_name")


def p1_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.canonical_columns(table(spark, sf_dir, "samples").select("row_index", "question", "answer"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, ledger = copies.samples_ledger(table(spark, sf_dir, "samples"))
    pairs_ = copies.copy_pairs(rows, ledger)
    return pairs_.select(F.col("keep_id").alias("keep_row_index"), F.col("copy_id").alias("copy_row_index"))


def p2_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.collapsed(table(spark, sf_dir, "samples"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(table(spark, sf_dir, "samples")).select("row_index", "field_name")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.pair_defects(table(spark, sf_dir, "samples")).select("row_index", F.element_at("defects", 1).alias("defect"))


def p5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_specs"))


def p5_utilisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = table(spark, sf_dir, "pack_specs")
    return packing.utilisation(packing.pack(table(spark, sf_dir, "documents"), specs), specs)


def p5_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariants of the packing, which SQL can state."""
    documents, specs = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_specs")
    return packing.audit(packing.pack(documents, specs), specs, packing.sized(documents))


def p6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p6_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(*mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")))


def p6_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of mixtures of five million tokens each, and by how much small sources fall short."""
    return mixing.shares(*mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), total_tokens=5_000_000))


def p6_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target shares and invariants of the copies, which SQL can state."""
    return mixing.audit(*mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "graded_texts")).where("prose").select("doc_id", "band")


def p7_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "graded_texts"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_canonical, p2_found, p2_collapsed, p3_found, p4_found, p5_pack, p5_utilisation, p5_audit, p6_mix, p6_shares, p6_budget, p6_audit, p7_found, p7_levels)}


_PLAIN = r"regexp_replace(lower(coalesce({c}, '')), '[\p{{P}}\p{{Z}}\s\p{{C}}]+', '', 'g')"
_SETS = f"SELECT image_bytes, {_PLAIN.format(c='sample_id')} AS i, {_PLAIN.format(c='question')} AS q, row_index FROM samples"


_KEY = r"regexp_replace(lower(trim({c})), '[\s_\-]+', '-', 'g')"
_TEXTS = f"SELECT {_KEY.format(c='source')} AS source FROM documents WHERE {sql_has('text')}"
_WANTED = f"SELECT mix_id, {_KEY.format(c='source_name')} AS source, sum(CASE WHEN target_weight > 0 THEN target_weight ELSE 0 END) AS w, min(coalesce(max_repeats, 1)) AS m FROM mix_targets WHERE mix_id IS NOT NULL AND source_name IS NOT NULL GROUP BY ALL"
_USABLE = f"SELECT *, w > 0 AND m > 0 AND source IN (SELECT DISTINCT source FROM ({_TEXTS}) WHERE source IS NOT NULL) AS usable FROM ({_WANTED})"


def oracle_sql() -> dict[str, str]:
    """Problem 2 can be stated in SQL, and what must hold of the results of 5 and 6; the others are tested against brute force."""
    return {
        "p2_found": f"SELECT keep_row_index, row_index AS copy_row_index FROM (SELECT row_index, min(row_index) OVER (PARTITION BY image_bytes, i, q) AS keep_row_index FROM ({_SETS})) WHERE row_index > keep_row_index",
        "p2_collapsed": f"SELECT min(row_index) AS keep_row_index, count(*) AS copies FROM ({_SETS}) GROUP BY image_bytes, i, q",
        "p5_audit": f"SELECT spec_id, (SELECT count(*) FROM ({_TEXTS})) AS texts, CAST(0 AS BIGINT) AS overfull_containers, CAST(0 AS BIGINT) AS overfull_windows, CAST(0 AS BIGINT) AS misrouted, CAST(0 AS BIGINT) AS token_difference FROM pack_specs",
        "p6_audit": f"SELECT mix_id, source, round(CASE WHEN usable THEN w / sum(CASE WHEN usable THEN w ELSE 0 END) OVER (PARTITION BY mix_id) ELSE 0 END, 9) AS target_share, usable, CAST(0 AS BIGINT) AS out_of_range FROM ({_USABLE})",
    }
