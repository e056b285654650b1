"""Queries of the ingest operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.text import has_text, mask, mask_length, padded, token_id, token_ids, tokens
from pairloom.operators import ingest
from pairloom.tables import table

#: Characters that Python's strip takes away, for DuckDB's regular expressions.
SQL_TEXT = r"[^\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
TOKEN_LENGTH = 16


def sql_has(column: str) -> str:
    return f"coalesce(regexp_matches({column}, '{SQL_TEXT}'), false)"


def column_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = ingest.map_columns(table(spark, sf_dir, "raw_rows"))
    return m.select("row_index", F.octet_length("image").alias("image_len"), "question", "answer", "reasoning")


def id_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_rows").select("row_index", ingest.sample_id(F.col("id"), F.col("row_index")).alias("sample_id"))


def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_rows").select("row_index", ingest.filled(F.col("question"), "What is shown in the picture?").alias("question"), ingest.filled(F.col("model_answer"), "No caption.").alias("answer"))


def list_caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First of a list-valued caption; null for no caption."""
    words = F.filter(F.split(F.col("answer"), r"\. "), lambda w: F.length(w) > 0)
    return table(spark, sf_dir, "samples").select("row_index", F.get(words, F.lit(0)).alias("caption"), F.size(words).alias("captions"))


def validate_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.valid(table(spark, sf_dir, "samples")).select("row_index", "sample_id", "question", "answer")


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.reject_counts(table(spark, sf_dir, "samples"))


def metadata_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "samples")
    j = ingest.metadata_json(F.col("sample_id"), F.element_at("metadata", "model_reasoning"), orig_width=F.col("image_width"), orig_height=F.col("image_height"))
    return s.select("row_index", j.alias("j")).select("row_index", F.get_json_object("j", "$.sample_id").alias("sample_id"), F.get_json_object("j", "$.model_reasoning").alias("model_reasoning"), F.get_json_object("j", "$.orig_width").cast("int").alias("orig_width"))


def nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = F.element_at("metadata", "extra")
    return table(spark, sf_dir, "samples").where(extra.isNotNull()).select("row_index", F.get_json_object(extra, "$.layout.cells.ok").alias("ok"), F.get_json_object(extra, "$.layout.cells.mix[0]").cast("int").alias("first_mix"))


def max_samples_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit is the feature: rows are counted before validation."""
    return ingest.valid(ingest.first_rows(table(spark, sf_dir, "samples"), 500)).select("row_index", "sample_id")


def sample_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.summary(table(spark, sf_dir, "samples"))


def raw_vs_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at the source whose mapped question differs from the canonical sample's (null-safe)."""
    raw, s = table(spark, sf_dir, "raw_rows").alias("r"), table(spark, sf_dir, "samples").alias("s")
    both = raw.join(s, F.col("r.row_index") == F.col("s.row_index"), "inner")
    return both.groupBy(F.col("r.question").eqNullSafe(F.col("s.question")).alias("same_question"), F.col("r.model_answer").eqNullSafe(F.col("s.answer")).alias("same_answer")).agg(F.count(F.lit(1)).alias("rows"))


def late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by whole days between capture and arrival."""
    days = F.floor((F.unix_micros("ingested_at") - F.unix_micros("captured_at")) / F.lit(86_400_000_000))
    return table(spark, sf_dir, "samples").groupBy(days.alias("days_late")).agg(F.count(F.lit(1)).alias("rows"))


def dataset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by cleaned data set name."""
    name = F.when(has_text(F.col("dataset_name")), F.lower(F.trim("dataset_name"))).otherwise("unknown")
    return table(spark, sf_dir, "samples").groupBy(name.alias("dataset")).agg(F.count(F.lit(1)).alias("rows"), F.count("image_bytes").alias("images"))


def tokenize_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = token_ids(F.col("question"))
    t = table(spark, sf_dir, "samples").select("row_index", ids.alias("ids"))
    t = t.select("row_index", padded(F.col("ids"), TOKEN_LENGTH).alias("input_ids"), mask(F.col("ids"), TOKEN_LENGTH).alias("m"))
    return t.select("row_index", F.array_join("input_ids", ",").alias("input_ids"), mask_length(F.col("m")).alias("length"))


def tokenize_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.size(tokens(F.col("text")))
    return table(spark, sf_dir, "documents").select("doc_id", n.alias("actual_length"), F.least(n, F.lit(512)).alias("kept_length"))


def detokenize_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids back to text through the vocabulary of all questions."""
    s = table(spark, sf_dir, "samples").select("row_index", tokens(F.col("question")).alias("t"))
    flat = s.select("row_index", F.posexplode("t").alias("pos", "tok")).withColumn("id", token_id(F.col("tok")))
    salts = 16  # a frequent word is looked up in many tasks
    vocabulary = flat.groupBy("id").agg(F.min("tok").alias("word")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    looked = flat.select("row_index", "pos", "id", F.pmod(F.xxhash64("row_index", "pos"), F.lit(salts)).cast("int").alias("salt"))
    back = looked.join(vocabulary, ["id", "salt"]).groupBy("row_index").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("w"))
    return back.select("row_index", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("text"))


QUERIES = [column_mapping, id_fallback, default_fill, list_caption, validate_keep, reject_reasons, metadata_json, nested_json, max_samples_limit, sample_summary, raw_vs_samples, late_arrivals, dataset_counts, tokenize_static, tokenize_lengths, detokenize_roundtrip]

_VALID = f"coalesce(length(sample_id) > 0, false) AND coalesce(octet_length(image_bytes) > 0, false) AND coalesce(image_width >= 1, false) AND coalesce(image_height >= 1, false) AND {sql_has('question')} AND {sql_has('answer')}"
_TOK = "list_filter(string_split(coalesce({c}, ''), ' '), lambda t: t <> '')"
_ID = "CAST(('0x' || substr(md5({t}), 1, 7)) AS INTEGER)"

ORACLES = {
    "column_mapping": "SELECT row_index, octet_length(image) AS image_len, question, model_answer AS answer, model_reasoning AS reasoning FROM raw_rows",
    "id_fallback": "SELECT row_index, coalesce(id, 'row_' || row_index) AS sample_id FROM raw_rows",
    "default_fill": f"SELECT row_index, CASE WHEN {sql_has('question')} THEN question ELSE 'What is shown in the picture?' END AS question, CASE WHEN {sql_has('model_answer')} THEN model_answer ELSE 'No caption.' END AS answer FROM raw_rows",
    "list_caption": "SELECT row_index, w[1] AS caption, CASE WHEN w IS NULL THEN NULL ELSE len(w) END AS captions FROM (SELECT row_index, list_filter(string_split(answer, '. '), lambda x: length(x) > 0) AS w FROM samples)",
    "validate_keep": f"SELECT row_index, sample_id, question, answer FROM samples WHERE {_VALID}",
    "reject_reasons": "SELECT reason, count(*) AS rows FROM ("
    + " UNION ALL ".join(
        f"SELECT '{n}' AS reason FROM samples WHERE NOT ({c})"
        for n, c in [
            ("sample_id", "coalesce(length(sample_id) > 0, false)"),
            ("image_bytes", "coalesce(octet_length(image_bytes) > 0, false)"),
            ("image_width", "coalesce(image_width >= 1, false)"),
            ("image_height", "coalesce(image_height >= 1, false)"),
            ("question", sql_has("question")),
            ("answer", sql_has("answer")),
        ]
    )
    + ") GROUP BY reason",
    "metadata_json": f"SELECT row_index, sample_id, CASE WHEN {sql_has('r')} THEN r END AS model_reasoning, image_width AS orig_width FROM (SELECT *, metadata['model_reasoning'] AS r FROM samples)",
    "nested_json": "SELECT row_index, json_extract_string(e, '$.layout.cells.ok') AS ok, CAST(json_extract_string(e, '$.layout.cells.mix[0]') AS INTEGER) AS first_mix FROM (SELECT row_index, metadata['extra'] AS e FROM samples) WHERE e IS NOT NULL",
    "max_samples_limit": f"SELECT row_index, sample_id FROM (SELECT * FROM samples ORDER BY row_index LIMIT 500) WHERE {_VALID}",
    "sample_summary": "SELECT row_index, sample_id, octet_length(image_bytes) AS image_bytes_len, image_width, image_height, length(question) AS question_len, length(answer) AS answer_len, dataset_name FROM samples",
    "raw_vs_samples": "SELECT r.question IS NOT DISTINCT FROM s.question AS same_question, r.model_answer IS NOT DISTINCT FROM s.answer AS same_answer, count(*) AS rows FROM raw_rows r JOIN samples s ON r.row_index = s.row_index GROUP BY 1, 2",
    "late_arrivals": "SELECT CAST(floor((epoch_us(ingested_at) - epoch_us(captured_at)) / 86400000000) AS BIGINT) AS days_late, count(*) AS rows FROM samples GROUP BY 1",
    "dataset_counts": f"SELECT CASE WHEN {sql_has('dataset_name')} THEN lower(trim(dataset_name)) ELSE 'unknown' END AS dataset, count(*) AS rows, count(image_bytes) AS images FROM samples GROUP BY 1",
    "tokenize_static": f"SELECT row_index, array_to_string(list_resize(list_transform(t, lambda x: {_ID.format(t='x')}), {TOKEN_LENGTH}, 0), ',') AS input_ids, least(len(t), {TOKEN_LENGTH}) AS length FROM (SELECT row_index, {_TOK.format(c='question')} AS t FROM samples)",
    "tokenize_lengths": f"SELECT doc_id, len(t) AS actual_length, least(len(t), 512) AS kept_length FROM (SELECT doc_id, {_TOK.format(c='text')} AS t FROM documents)",
    "detokenize_roundtrip": f"""WITH f AS (SELECT row_index, unnest(t) AS tok, generate_subscripts(t, 1) AS pos FROM (SELECT row_index, {_TOK.format(c='question')} AS t FROM samples)),
g AS (SELECT row_index, pos, tok, {_ID.format(t='tok')} AS id FROM f), v AS (SELECT id, min(tok) AS word FROM g GROUP BY id)
SELECT row_index, string_agg(word, ' ' ORDER BY pos) AS text FROM g JOIN v USING (id) GROUP BY row_index""",
}
