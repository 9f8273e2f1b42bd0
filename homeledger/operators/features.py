"""Imputation, rare categories and scaling, as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from homeledger import schema as S
from homeledger.operators.joins import attach
from homeledger.operators.selection import exact_quantiles
from homeledger.session import cut_lineage

# fixed values
MIN_FREQUENCY = 20
INFREQUENT = "__infrequent__"


def unpivot(df: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    """(feature, value) pairs of several columns from one scan."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast(cast).alias("value")) for c in columns])
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull())


def impute_median(df: DataFrame, columns: Sequence[str] = S.NUMERIC_FEATURES) -> DataFrame:
    """Exact median per feature; a feature without any value has no row."""
    medians = exact_quantiles(unpivot(df, columns, "double"), "value", [0.5], ["feature"], few_groups=True)
    return medians.select("feature", F.col("quantile").alias("median"))


def category_counts(df: DataFrame, columns: Sequence[str] = S.CATEGORICAL_FEATURES) -> DataFrame:
    """Rows per feature and category; counted in the map tasks before the shuffle."""
    return (unpivot(df, columns, "string").groupBy("feature", F.col("value").alias("category"))
            .agg(F.count("*").alias("rows")))


def category_frequency(df: DataFrame, columns: Sequence[str] = S.CATEGORICAL_FEATURES,
                       min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """Category counts with the bucket each goes to: itself, or the shared rare one."""
    bucket = F.when(F.col("rows") >= min_frequency, F.col("category")).otherwise(F.lit(INFREQUENT))
    return category_counts(df, columns).withColumn("bucket", bucket)


def impute_mode(counts: DataFrame) -> DataFrame:
    """Most frequent category per feature from ``category_counts``; ties: the smallest."""
    first = F.struct((-F.col("rows")).alias("r"), F.col("category").alias("c"))
    return counts.groupBy("feature").agg(F.min_by("category", first).alias("mode"))


def lookup_infrequent(df: DataFrame, frequency: DataFrame, column: str) -> DataFrame:
    """Replace the categories of one column by their bucket; unseen ones become null.

    The values of ``df`` are counted first, so the rows of a hot one, seen before or not, stay
    where they are. ``df`` is read twice: pass a written table or a cheap scan.
    """
    own = frequency.where(F.col("feature") == column).select(F.col("category").alias(column), F.col("bucket").alias("_bucket"))
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    facts = cut_lineage(values.join(own, column, "left"), "buckets")
    found = attach(df.where(F.col(column).isNotNull()), facts, column, "_n").withColumn(column, F.col("_bucket")).select(*df.columns)
    return found.unionByName(df.where(F.col(column).isNull()))


def scale_by_std(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Divide by the population standard deviation, no centring; a constant column stays."""
    spread = df.agg(F.struct(*[F.stddev_pop(c).alias(c) for c in columns]).alias("s")).scalar()
    return df.withColumns({
        c: F.col(c) / F.coalesce(F.nullif(spread[c], F.lit(0.0)), F.lit(1.0)) for c in columns})
