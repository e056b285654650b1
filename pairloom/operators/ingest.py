"""Rows to canonical samples: column mapping, defaults, validation, rejects."""

from __future__ import annotations

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from pairloom.functions.text import has_text

#: Canonical name -> name at the source.
DEFAULT_MAPPING = {"image": "image", "question": "question", "answer": "model_answer", "id": "id", "reasoning": "model_reasoning"}


def map_columns(df: DataFrame, mapping: dict[str, str] | None = None, row_index: str = "row_index") -> DataFrame:
    """Canonical columns of a source; columns that the source lacks are null strings.

    An image may be bytes or a structure with a field ``bytes``, ``path`` or both (the
    file is read where there are no bytes; one that cannot be read is null); of a
    question or answer that is a list, the first entry is taken. Without the id's
    column ``image_id`` serves, if there is one.
    """
    mapping = {**DEFAULT_MAPPING, **(mapping or {})}
    if mapping["id"] not in df.columns and "image_id" in df.columns:
        mapping["id"] = "image_id"
    return df.select(F.col(row_index).alias("row_index"), *[_canonical(df, c, s).alias(c) for c, s in mapping.items()])


def _canonical(df: DataFrame, name: str, source: str) -> Column:
    if source not in df.columns:
        return F.lit(None).cast("string")
    kind, value = df.schema[source].dataType, F.col(source)
    if name == "image" and isinstance(kind, StructType) and {"bytes", "path"} & set(kind.names):
        given = value["bytes"] if "bytes" in kind.names else F.lit(None).cast("binary")
        if "path" not in kind.names:
            return given
        # Only paths of images without bytes go to Python.
        return F.coalesce(given, F.pandas_udf(_contents, "binary")(F.when(given.isNull(), value["path"])))
    if name in ("question", "answer") and isinstance(kind, ArrayType):
        return F.get(value, F.lit(0))
    return value


def _contents(paths: pd.Series) -> pd.Series:
    def read(path: str | None) -> bytes | None:
        try:
            with open(path.removeprefix("file://"), "rb") as f:
                return f.read()
        except (OSError, AttributeError):
            return None

    return pd.Series([read(p) for p in paths], dtype=object)


def sample_id(id_: Column, row_index: Column) -> Column:
    """The source's id as a string, or ``row_<index>``."""
    return F.coalesce(id_.cast("string"), F.concat(F.lit("row_"), row_index.cast("string")))


def filled(text: Column, default: str) -> Column:
    """The text, or the default for null and blank ones."""
    return F.when(has_text(text), text).otherwise(F.lit(default))


def sample_errors(sample: Column, image: Column, width: Column, height: Column, question: Column, answer: Column) -> Column:
    """Names of all violated invariants, in fixed order; empty for a valid sample. Nulls violate."""
    rules = [
        ("sample_id", F.coalesce(F.length(sample) > 0, F.lit(False))),
        ("image_bytes", F.coalesce(F.octet_length(image) > 0, F.lit(False))),
        ("image_width", F.coalesce(width >= 1, F.lit(False))),
        ("image_height", F.coalesce(height >= 1, F.lit(False))),
        ("question", has_text(question)),
        ("answer", has_text(answer)),
    ]
    return F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules]), lambda e: e.isNotNull())


def with_errors(samples: DataFrame) -> DataFrame:
    """``samples`` with the column ``errors``."""
    c = F.col
    return samples.withColumn("errors", sample_errors(c("sample_id"), c("image_bytes"), c("image_width"), c("image_height"), c("question"), c("answer")))


def valid(samples: DataFrame, fail_fast: bool = False) -> DataFrame:
    """Samples without errors. ``fail_fast`` raises at the first that has one."""
    checked = with_errors(samples)
    if fail_fast:
        bad = F.raise_error(F.concat(F.lit("sample "), F.coalesce(F.col("sample_id"), F.lit("null")), F.lit(": "), F.array_join("errors", ", ")))
        checked = checked.withColumn("errors", F.when(F.size("errors") > 0, bad.cast("array<string>")).otherwise(F.col("errors")))
    return checked.where(F.size("errors") == 0).drop("errors")


def reject_counts(samples: DataFrame) -> DataFrame:
    """(reason, rows): each reason counts every row that it applies to."""
    return with_errors(samples).select(F.explode("errors").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def first_rows(df: DataFrame, n: int, row_index: str = "row_index") -> DataFrame:
    """The first ``n`` rows in the source's order, before any validation."""
    return df.orderBy(row_index).limit(n)


def metadata_json(sample: Column, reasoning: Column, **numbers: Column) -> Column:
    """JSON text of a sample's metadata; blank and null entries are left out."""
    return F.to_json(F.struct(sample.alias("sample_id"), F.when(has_text(reasoning), reasoning).alias("model_reasoning"), *[v.alias(k) for k, v in numbers.items()]))


def summary(samples: DataFrame) -> DataFrame:
    """Samples without their bytes, for logs."""
    return samples.select("row_index", "sample_id", F.octet_length("image_bytes").alias("image_bytes_len"), "image_width", "image_height", F.length("question").alias("question_len"), F.length("answer").alias("answer_len"), "dataset_name")


def first_with_rows(candidates: list) -> DataFrame:
    """The first of several sources that can be read and has rows.

    ``candidates`` are functions that give a DataFrame; a source that cannot be
    read is passed over. ValueError if none has rows; it carries the last reason.
    """
    last: Exception | None = None
    for source in candidates:
        try:
            df = source()
            if not df.isEmpty():
                return df
        except (AnalysisException, OSError, ValueError) as why:
            last = why
    raise ValueError(f"no source has rows{'' if last is None else f': {last}'}") from last


def sampled(df: DataFrame, n: int, seed: int, row_index: str = "row_index") -> DataFrame:
    """``n`` rows, or all if there are fewer, by seeded hash of their number: the head of a shuffle."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(row_index)), row_index).limit(n)
