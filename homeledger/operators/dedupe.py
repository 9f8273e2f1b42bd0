"""Keep-first duplicates.

"First" is the smallest of ``order`` columns, so the survivor does not depend on
partitioning. Equal nulls are equal keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from homeledger import schema as S
from homeledger.session import drop_folder


KEY_DIGEST = "_key_digest"


def source_rank(c: Column) -> Column:
    """Position of a source in the union order."""
    ranks = F.lit(len(S.SOURCES))
    for i, name in reversed(list(enumerate(S.SOURCES))):
        ranks = F.when(c == name, F.lit(i)).otherwise(ranks)
    return ranks


def listing_order() -> list[Column]:
    return [F.col("published_at"), source_rank(F.col("source")), F.col("row_id")]


def _order_columns(order: Sequence[str | Column] | None) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in (order or listing_order())]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """First row per key, as an aggregate.

    ``min_by`` is partial: however many copies a key has, each map task sends one. Its buffer is
    a row, so Spark aggregates by sorting each task's rows by key, before and after the shuffle;
    both sorts spill.
    The order is a struct because a null order value alone would be skipped.
    """
    first = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(_order_columns(order))])
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), first).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
    )


class FirstTable:
    """Keep-first over loads that come one after another: a bucketed table of the first row of each key.

    A load is cut to one row per key, shuffled into the table's buckets and joined bucket to bucket: the stored rows
    are not shuffled, whatever their number. Each merge writes a new version and drops the version before the last one,
    so a merge that fails leaves the table as it was. ``folder`` lies in the shared folder. Keys are compared by 16 bytes of
    a SHA-256 digest of their JSON, in which null and empty differ. The table has as many buckets as the session has shuffle
    partitions when it begins, ``buckets`` at least: the aggregate of a load then leaves its rows in the table's buckets, and what a task
    sorts is bounded by the setting that bounds every other shuffle.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str, keys: Sequence[str],
                 order: Sequence[str | Column] | None = None, buckets: int = 200):
        self.spark, self.name, self.folder, self.keys, self.order = spark, name, folder, list(keys), order
        self.buckets = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.version = 0

    def _table(self, version: int) -> str:
        return f"{self.name}_{version}"

    def rows(self) -> DataFrame:
        """The first rows of all loads so far."""
        return self.spark.table(self._table(self.version)).drop(KEY_DIGEST)

    def joined(self, load: DataFrame) -> DataFrame:
        """First rows of the stored table and ``load`` together."""
        types = dict(load.dtypes)
        # equal keys have one text: zero has no sign, and JSON would round times
        whole = load.withColumns({k: F.col(k) + F.lit(0).cast(types[k]) for k in self.keys if types[k] in ("double", "float")})
        texts = [F.col(k).cast("string").alias(k) if types[k].startswith("timestamp") else F.col(k) for k in self.keys]
        digest = F.sha2(F.to_json(F.struct(*texts), {"ignoreNullFields": "false"}), 256)
        first = keep_first(whole.withColumn(KEY_DIGEST, F.substring(F.unhex(digest), 1, 16)), [KEY_DIGEST], self.order)
        if not self.version:
            return first
        names = first.columns
        rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(_order_columns(self.order))])
        one, other = (df.select(KEY_DIGEST, F.struct(*names).alias(side), rank.alias(f"{side}_rank"))
                      for df, side in ((self.spark.table(self._table(self.version)), "old"), (first, "new")))
        both = one.hint("merge").join(other, KEY_DIGEST, "full")
        earlier = F.when(F.col("old").isNull() | (F.col("new_rank") < F.col("old_rank")), F.col("new")).otherwise(F.col("old"))
        return both.select(earlier.alias("row")).select("row.*")

    def merge(self, load: DataFrame) -> DataFrame:
        """Take in a load; the rows as of now."""
        (self.joined(load).write.bucketBy(self.buckets, KEY_DIGEST).sortBy(KEY_DIGEST).format("parquet").mode("overwrite")
         .option("path", f"{self.folder}/{self.version + 1}").saveAsTable(self._table(self.version + 1)))
        self.version += 1
        if self.version > 2:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(self.version - 2)}")
            drop_folder(self.spark, f"{self.folder}/{self.version - 2}")
        return self.rows()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """The same rows by ranking.

    Spark limits each key to one row before the shuffle (window group limit), so a hot
    key is cut down in the map tasks here too.
    """
    window = Window.partitionBy(*keys).orderBy(*_order_columns(order))
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def duplicates_removed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before, rows after and the difference; counts are pre-aggregated per key."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("c"))
    return per_key.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
    ).withColumn("removed", F.col("rows_before") - F.col("rows_after"))
