"""Problem 6: mixing sources to target weights.

Tokens are aggregated by source (a few numbers), repetition rates are derived,
and each document is emitted floor(rate) times plus once more if its seeded hash
falls under the fraction. No document is shuffled: the rates are broadcast, their
number is that of the mixtures' rows.

The size of a mixture is the one asked for; a source that its greatest number of
repetitions keeps from its share falls short, and the report says by how much. Where
no size is asked for it is the largest at which all sources can meet their weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pairloom.llm.packing import sized
from pairloom.llm.tokens import TOKENIZERS, VOCABULARY
from pairloom.storage import materialize

#: A mixture table of more rows than this is refused; it is broadcast.
MOST_TARGETS = 100_000


def source_key(name: Column) -> Column:
    """Source name without case, with one kind of separator."""
    return F.regexp_replace(F.lower(F.trim(name)), r"[\s_\-]+", "-")


def rates(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """(mix_id, source, weight, max_repeats, tokens, rate, target_share, wanted_tokens, shortfall_tokens) for each
    source of each mixture.

    Weights are relative. A source without documents, or of no positive weight,
    has rate 0 and its weight is left out of the total, so the others share it. A
    source named twice in a mixture counts once, with its weights added and the
    lower greatest number. A null greatest number means 1.
    """
    have = sizes.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("tokens"))
    wanted = (
        targets.select("mix_id", source_key(F.col("source_name")).alias("source"), F.col("target_weight").cast("double").alias("w"), F.coalesce("max_repeats", F.lit(1)).alias("m"))
        .where("mix_id is not null and source is not null")
        .groupBy("mix_id", "source")
        .agg(F.sum(F.when(F.col("w") > 0, F.col("w")).otherwise(0.0)).alias("weight"), F.greatest(F.min("m"), F.lit(0)).alias("max_repeats"))
    )
    joined = wanted.join(have, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    usable = (F.col("weight") > 0) & (F.col("tokens") > 0) & (F.col("max_repeats") > 0)
    mix = Window.partitionBy("mix_id")
    return (
        joined.withColumn("target_share", F.try_divide(F.when(usable, F.col("weight")).otherwise(0.0), F.sum(F.when(usable, F.col("weight"))).over(mix)))
        .withColumn("size", F.lit(float(total_tokens)) if total_tokens is not None else F.min(F.when(usable, F.try_divide(F.col("tokens") * F.col("max_repeats"), F.col("target_share")))).over(mix))
        .withColumn("rate", F.when(usable, F.least(F.try_divide(F.col("target_share") * F.col("size"), F.col("tokens")), F.col("max_repeats").cast("double"))).otherwise(0.0))
        .withColumn("wanted_tokens", F.coalesce(F.col("target_share") * F.col("size"), F.lit(0.0)))
        .select(
            "mix_id", "source", "weight", "max_repeats", "tokens", "rate", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), "wanted_tokens",
            F.greatest(F.lit(0.0), F.col("wanted_tokens") - F.col("tokens") * F.col("rate")).alias("shortfall_tokens"),
        )
    )


def seeded_unit(seed: int, *columns: Column) -> Column:
    """Number in [0, 1) that depends on the seed and the columns only."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 40)) / F.lit(float(1 << 40))


def mix(documents: DataFrame, targets: DataFrame, seed: int = 42, total_tokens: int | None = None, text: str = "text", id_col: str = "doc_id", source: str = "source", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(uses, rates). ``uses``: mix_id, id, source, tokens, copies of each document that is used.

    Documents of null source, of no mixture, and null or blank texts (no tokens)
    are not used. Copies never exceed ``max_repeats``. ``total_tokens`` is the size
    asked for, of each mixture. Empty tables give empty results.
    """
    sizes = sized(documents.withColumn("__source", source_key(F.col(source))), text, id_col, keep=("__source",), folder=folder, vocabulary=vocabulary).withColumnRenamed("__source", "source")
    plan = materialize(rates(sizes, targets, total_tokens), "mix-rates")
    if targets.limit(MOST_TARGETS + 1).count() > MOST_TARGETS:
        raise ValueError(f"more than {MOST_TARGETS} targets")
    whole, part = F.floor("rate"), F.col("rate") - F.floor("rate")
    copies = (whole + (seeded_unit(seed, F.col("mix_id"), F.col(id_col)) < part).cast("long")).alias("copies")
    uses = sizes.where("tokens > 0").join(F.broadcast(plan.where("rate > 0").select("mix_id", "source", "rate")), "source").select("mix_id", id_col, "source", "tokens", copies)
    return uses.where("copies > 0"), plan


def shares(uses: DataFrame, plan: DataFrame) -> DataFrame:
    """(mix_id, source, target_share, actual_share, rate, max_repeats, most_copies, documents, used_tokens,
    wanted_tokens, shortfall_tokens) of each source of each mixture.

    Pre-aggregated by source before the shuffle; a source that gives nothing has share 0.
    """
    got = uses.groupBy("mix_id", "source").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("copies") * F.col("tokens")).alias("used_tokens"), F.max("copies").alias("most_copies"))
    total = F.sum("used_tokens").over(Window.partitionBy("mix_id"))
    return (
        plan.join(got, ["mix_id", "source"], "left")
        .fillna(0, ["documents", "used_tokens", "most_copies"])
        .select("mix_id", "source", "target_share", F.coalesce(F.try_divide(F.col("used_tokens"), total), F.lit(0.0)).alias("actual_share"), "rate", "max_repeats", "most_copies", "documents", "used_tokens", "wanted_tokens", "shortfall_tokens")
    )


def audit(uses: DataFrame, plan: DataFrame) -> DataFrame:
    """(mix_id, source, target_share, usable, out_of_range) of each source of each mixture.

    ``out_of_range`` counts documents used less often than floor(rate) allows, more
    often than floor(rate) + 1 or than ``max_repeats``; it should be 0. Documents that
    are used not at all have floor(rate) = 0 or are missing, which ``shares`` shows.
    """
    joined = uses.select("mix_id", "source", "copies").join(plan.select("mix_id", "source", "rate", "max_repeats"), ["mix_id", "source"])
    wrong = joined.groupBy("mix_id", "source").agg(F.count_if((F.col("copies") < F.floor("rate")) | (F.col("copies") > F.floor("rate") + 1) | (F.col("copies") > F.col("max_repeats"))).alias("out_of_range"))
    return plan.join(wrong, ["mix_id", "source"], "left").select("mix_id", "source", F.round("target_share", 9).alias("target_share"), (F.col("rate") > 0).alias("usable"), F.coalesce("out_of_range", F.lit(0)).alias("out_of_range"))
