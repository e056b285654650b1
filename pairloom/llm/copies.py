"""Problem 2: records that are copies but for case, spacing, punctuation or field order.

An incremental ledger. The ledger is a bucketed table (canonical key, number of
copies, earliest representative). Each batch of deliveries is keyed and
aggregated by key (partial sums before the shuffle, so a hot key is one row per
task), full-outer-joined with the ledger buckets that its keys fall into, and the
new state of exactly those buckets is written; the other buckets keep their files.

The ledger lives in a folder. A version is a small file that lists each bucket's
place; it is written last and under its final name by one rename, so a lost
executor or driver leaves the former version whole, and :meth:`Ledger.open` finds
the newest one from another session. The former version's files stay until the
next one is committed.

A key's bucket is where Spark's own hash partitioning puts it, so a task of the
join holds one bucket and writes one file; the state is shuffled once a batch.

The image bytes are read once and only their digest is moved.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.storage import delete_path, list_names, materialize, new_path, read_text, write_text

#: Letter case, white space, punctuation and invisible controls make no difference.
NOISE = r"[\p{P}\p{Z}\s\p{C}]+"


def plain(text: Column) -> Column:
    """Text without case, white space and punctuation; null counts as empty."""
    return F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), NOISE, "")


def canonical_key(image: Column, texts: Sequence[Column]) -> Column:
    """128-bit key of the exact bytes of ``image`` and the plain form of ``texts``.

    A null image differs from an empty one. The separator cannot occur in a
    plain text.
    """
    parts: list[Column] = [F.when(image.isNull(), F.lit("null")).otherwise(F.md5(image))]
    for t in texts:
        parts += [F.lit("\x01"), plain(t)]
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


def keyed(df: DataFrame, id_col: str = "row_index", image: str = "image_bytes", texts: Sequence[str] = ("sample_id", "question"), order: str | None = None) -> DataFrame:
    """(key, id[, at]) of each row. Ids may be null or repeated; nothing is dropped."""
    columns = [canonical_key(F.col(image), [F.col(t) for t in texts]).alias("key"), F.col(id_col).cast("long").alias("id")]
    return df.select(*columns, *([F.col(order).alias("at")] if order else []))


@dataclass
class Ledger:
    """Bucketed counts of canonical keys in the folder ``root``.

    ``buckets`` is the number of key ranges that are rewritten independently; see
    :func:`bucket_count`. ``files`` has the place and the keys of the current version
    of each bucket that is not empty (a list bounded by ``buckets``). Buckets are cut
    anew when they have grown to more than twice ``keys_per_bucket``.
    """

    spark: SparkSession
    root: str
    buckets: int = 64
    version: int = 0
    files: dict[int, tuple[str, int]] = field(default_factory=dict)
    keys_per_bucket: int = 500_000

    @staticmethod
    def open(spark: SparkSession, root: str) -> Ledger:
        """The newest version in ``root``. FileNotFoundError if there is none."""
        versions = list_names(spark, f"{root}/versions")
        numbers = sorted(int(n.removesuffix(".json")) for n in versions if n.endswith(".json") and not n.startswith("."))
        if not numbers:
            raise FileNotFoundError(root)
        m = json.loads(read_text(spark, f"{root}/versions/{numbers[-1]:08d}.json"))
        return Ledger(spark, root, m["buckets"], m["version"], {int(b): (p, n) for b, (p, n) in m["files"].items()}, m["keys_per_bucket"])

    @property
    def keys(self) -> int:
        return sum(n for _, n in self.files.values())

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.hash(key), F.lit(self.buckets))

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """Rows (key, copies, first_id, bucket) of all or of some buckets."""
        schema = "key binary, copies bigint, first_id bigint"
        wanted = [b for b in sorted(self.files) if only is None or b in set(only)]
        if not wanted:
            return self.spark.createDataFrame([], schema + ", bucket int")
        rows = self.spark.read.schema(schema).parquet(*[f"{self.files[b][0]}/bucket={b}" for b in wanted])
        return rows.withColumn("bucket", self.bucket(F.col("key")))

    def fold(self, batch: DataFrame) -> None:
        """Add the rows (key, id) of ``batch`` and commit the new version.

        The smallest id represents a key; rows of null id count but never
        represent, unless there is no other.
        """
        counted = materialize(batch.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id")), "ledger-batch")
        new_keys = counted.count()
        if not new_keys:
            return
        grown = self.keys + new_keys > 2 * self.buckets * self.keys_per_bucket
        old = self.read() if grown else None
        if grown:
            self.buckets = bucket_count(self.keys + new_keys, self.keys_per_bucket)
        else:
            touched = [r.bucket for r in counted.select(self.bucket(F.col("key")).alias("bucket")).distinct().collect()]  # at most ``buckets`` numbers
            old = self.read(touched) if any(b in self.files for b in touched) else None
        merged = counted.repartition(self.buckets, "key")
        if old is not None:
            new = merged.alias("n")
            merged = old.drop("bucket").repartition(self.buckets, "key").alias("o").join(new, F.col("o.key") == F.col("n.key"), "full_outer").select(
                F.coalesce("o.key", "n.key").alias("key"),
                (F.coalesce("o.copies", F.lit(0)) + F.coalesce("n.copies", F.lit(0))).alias("copies"),
                F.least("o.first_id", "n.first_id").alias("first_id"),
            )
        path = f"{self.root}/data-{uuid.uuid4().hex}"
        merged.withColumn("bucket", self.bucket(F.col("key"))).write.partitionBy("bucket").parquet(path)
        counts = self.spark.read.schema("bucket int").parquet(path).groupBy("bucket").count().collect()
        self._commit(({} if grown else self.files) | {r["bucket"]: (path, r["count"]) for r in counts})

    def _commit(self, files: dict[int, tuple[str, int]]) -> None:
        former = self.files
        self.version, self.files = self.version + 1, files
        m = {"version": self.version, "buckets": self.buckets, "keys_per_bucket": self.keys_per_bucket, "files": {str(b): list(f) for b, f in sorted(files.items())}}
        write_text(self.spark, f"{self.root}/versions/{self.version:08d}.json", json.dumps(m))
        # Readers of the former version may still be at work; what is older goes.
        kept = {p.rsplit("/", 1)[-1] for p, _ in [*files.values(), *former.values()]}
        for name in list_names(self.spark, self.root):
            if name.startswith("data-") and name not in kept:
                delete_path(self.spark, f"{self.root}/{name}")
        for name in list_names(self.spark, f"{self.root}/versions"):
            if name.endswith(".json") and name.removesuffix(".json").isdigit() and int(name.removesuffix(".json")) < self.version - 1:
                delete_path(self.spark, f"{self.root}/versions/{name}")


def bucket_count(rows: int, keys_per_bucket: int = 500_000) -> int:
    """Buckets of about ``keys_per_bucket`` keys (some 15 MB), 8 at least and 65,536 at most."""
    return max(8, min(65_536, -(-rows // keys_per_bucket)))


def build_ledger(rows: DataFrame, batch: Column, batches: int, buckets: int | None = None, root: str | None = None) -> Ledger:
    """Fold the rows (key, id, ..) into a new ledger, batch after batch.

    ``batch`` gives each row's batch, 0 to ``batches`` - 1. A null counts as the last
    batch. Without ``root`` the ledger goes when the driver ends.
    """
    buckets = buckets or bucket_count(rows.count())
    ledger = Ledger(rows.sparkSession, root or new_path(rows.sparkSession, "ledger"), buckets)
    numbered = rows.withColumn("batch", F.coalesce(batch.cast("int"), F.lit(batches - 1)))
    for b in range(batches):
        ledger.fold(numbered.where(F.col("batch") == b))
    return ledger


def copy_pairs(rows: DataFrame, ledger: Ledger, hot: int = 1000) -> DataFrame:
    """(keep id, copy id) of each row that is not its set's representative.

    Only keys with copies are joined. A key that holds more than 1/``hot`` of all
    rows is hot; there are fewer than ``hot`` of them whatever the data, so these
    are broadcast (their rows never move); all others are joined by a shuffle
    whose largest group is bounded by the same share. Rows repeated with the same
    id give a row each, but for the first; null ids are copies of themselves.
    """
    repeated = ledger.read().where("copies > 1").select("key", "copies", "first_id")
    total = ledger.read().agg(F.sum("copies")).first()[0] or 0
    limit = max(total // hot, 1)
    heavy, light = repeated.where(F.col("copies") > limit), repeated.where(F.col("copies") <= limit)
    pairs = rows.join(F.broadcast(heavy), "key").unionByName(rows.join(light, "key"), allowMissingColumns=True)
    return pairs.where(F.col("first_id") < F.col("id")).select(F.col("first_id").alias("keep_id"), F.col("id").alias("copy_id"))


def delivery_batches(df: DataFrame, at: str, batches: int) -> Column:
    """Batch number by arrival: equal spans between the first and the last time of ``df``."""
    low, high = df.agg(F.min(F.unix_micros(at)), F.max(F.unix_micros(at))).first()
    if low is None or low == high:
        return F.lit(0)
    return F.least(F.floor((F.unix_micros(F.col(at)) - F.lit(low)) * F.lit(batches) / F.lit(high - low)), F.lit(batches - 1))


def samples_ledger(samples: DataFrame, batches: int = 3, buckets: int | None = None) -> tuple[DataFrame, Ledger]:
    """(rows with key, id, at; ledger) of the samples table, delivered in ``batches``."""
    rows = materialize(keyed(samples, order="ingested_at"), "sample-keys")
    return rows, build_ledger(rows, delivery_batches(rows, "at", batches), batches, buckets)


def collapsed(samples: DataFrame, batches: int = 3) -> DataFrame:
    """One row per record: (row_index of the earliest representative, copies).

    Null row ids represent only sets that have no other id.
    """
    _, ledger = samples_ledger(samples, batches)
    return ledger.read().select(F.col("first_id").alias("keep_row_index"), "copies")
