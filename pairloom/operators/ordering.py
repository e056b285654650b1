"""Positions and shuffles without a task that sees all rows.

Keys are MD5 of seed, epoch and id, so an order depends on the data only. A
position is the row's rank in its key bucket plus the rows of the buckets before;
only the bucket counts (a bounded table) are ordered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: Hexadecimal digits of a key that choose its bucket: 4096 buckets.
KEY_DIGITS = 3


def shuffle_key(seed: int, epoch: int, id_: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{epoch}:"), id_.cast("string")))


def with_position(df: DataFrame, bucket: Column, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with each row's place, from 0, in the order (bucket, order).

    ``bucket`` must not fall as the order rises and should split rows evenly; it
    may be null (first). Ties in ``order`` take any place among themselves.
    """
    keyed = df.withColumn("__b", bucket)
    counts = keyed.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy(F.asc_nulls_first("__b")).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col("__b").alias("__ob"), F.coalesce(before, F.lit(0)).alias("__o"))
    ranked = keyed.withColumn("__r", F.row_number().over(Window.partitionBy("__b").orderBy(*order)))
    joined = ranked.join(offsets, F.col("__b").eqNullSafe(F.col("__ob")))
    return joined.withColumn(name, F.col("__o") + F.col("__r") - 1).drop("__b", "__ob", "__o", "__r")


def global_shuffle(df: DataFrame, id_col: str, seed: int, epoch: int = 0, name: str = "position") -> DataFrame:
    """A permutation of all rows; ids should be unique, else equal rows share neighbouring places."""
    keyed = df.withColumn("__k", shuffle_key(seed, epoch, F.col(id_col)))
    return with_position(keyed, F.substring("__k", 1, KEY_DIGITS), [F.col("__k"), F.col(id_col)], name).drop("__k")


def sequential(df: DataFrame, id_col: str, buckets: int = 4096, rows_per_bucket: int = 16_384, name: str = "position") -> DataFrame:
    """Places in the order of a whole-number id, whatever numbers the ids are.

    The ids' range is cut at approximate quantiles, so that sparse ids do not make a
    bucket for each row, nor dense ones one bucket for all.
    """
    low, high, rows = df.agg(F.min(id_col), F.max(id_col), F.count(F.lit(1))).first()
    if low is None or high == low:
        return with_position(df, F.lit(0), [F.asc_nulls_first(id_col)], name)
    wanted = max(1, min(buckets, rows // rows_per_bucket))
    if high - low < 4 * rows:  # about dense: ranges of equal width hold about equally many
        bucket = F.floor((F.col(id_col) - F.lit(low)) / F.lit(max(1, -(-(high - low + 1) // wanted))))
    else:
        cuts = sorted(set(df.agg(F.percentile_approx(id_col, [(i + 1) / wanted for i in range(wanted - 1)], 10 * wanted)).first()[0] or [])) if wanted > 1 else []
        bucket = F.size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda c: c < F.col(id_col))) if cuts else F.lit(0)
        bucket = F.when(F.col(id_col).isNotNull(), bucket)
    return with_position(df, bucket, [F.asc_nulls_first(id_col)], name)


def local_shuffle(df: DataFrame, group: str, id_col: str, seed: int, name: str = "position") -> DataFrame:
    """Places within each group, in shuffled order. Groups are shards, which have a bounded size."""
    w = Window.partitionBy(group).orderBy(shuffle_key(seed, 0, F.col(id_col)), F.col(id_col))
    return df.withColumn(name, F.row_number().over(w) - 1)


def block_shuffle(df: DataFrame, position: str, block: int, id_col: str, seed: int, name: str = "shuffled") -> DataFrame:
    """Shuffle inside blocks of ``block`` rows: no row moves further than a buffer of that size lets it."""
    w = Window.partitionBy("__block").orderBy(shuffle_key(seed, 0, F.col(id_col)), F.col(id_col))
    return df.withColumn("__block", F.floor(F.col(position) / F.lit(block))).withColumn(name, F.col("__block") * block + F.row_number().over(w) - 1).drop("__block")


def buffer_order(n: int, size: int, rng: np.random.Generator) -> np.ndarray:
    """Input indices in the order in which a shuffle buffer of ``size`` gives them out."""
    if size <= 0 or n <= 1:
        return np.arange(n)
    if size >= n:
        return rng.permutation(n)
    held = list(range(size))
    out = np.empty(n, dtype=np.int64)
    for i in range(n):
        at = int(rng.integers(len(held)))
        out[i] = held[at]
        if size + i < n:
            held[at] = size + i
        else:
            held[at] = held[-1]
            held.pop()
    return out


def shuffle_buffer(df: DataFrame, size: int, seed: int, group: str, order: str) -> DataFrame:
    """(all columns, in_pos, out_pos): a streaming shuffle of each ``group``, in the order of ``order``, through a buffer.

    Positions count from 0 in each group; out_pos >= in_pos - size + 1. The random
    numbers are seeded by the group's name, so groups differ from each other and
    results do not depend on tasks or Arrow batches. Sequential inside a group by
    its nature; ``size`` rows are held.
    """
    schema = StructType([*df.schema.fields, StructField("in_pos", LongType()), StructField("out_pos", LongType())])
    names = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        current, rng, seen, given = None, np.random.default_rng(seed), 0, 0
        out: list[tuple] = []

        def give(at: int) -> None:
            nonlocal given
            out.append((*held[at], given))
            given += 1

        def flush() -> None:
            for at in rng.permutation(len(held)):
                give(int(at))
            held.clear()

        key = names.index(group)
        for pdf in batches:
            for row in pdf.itertuples(index=False, name=None):
                if (name := f"{seed}:{row[key]}") != current:
                    flush()
                    current, rng, seen, given = name, np.random.default_rng(list(name.encode())), 0, 0
                if len(held) >= max(size, 1):
                    at = int(rng.integers(len(held)))
                    give(at)
                    held[at] = (*row, seen)
                else:
                    held.append((*row, seen))
                seen += 1
            yield pd.DataFrame(out, columns=[*names, "in_pos", "out_pos"])
            out.clear()
        flush()
        yield pd.DataFrame(out, columns=[*names, "in_pos", "out_pos"])

    return df.repartition(group).sortWithinPartitions(group, order).mapInPandas(run, schema)
