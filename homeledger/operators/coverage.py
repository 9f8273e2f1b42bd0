"""Row counts over time and source."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from homeledger.functions import dates


def time_range(df: DataFrame, column: str = "published_at") -> DataFrame:
    return df.agg(F.min(column).alias("first_time"), F.max(column).alias("last_time"))


def count_values(df: DataFrame, column: str, null_as: str | None = None) -> DataFrame:
    """Rows per value, most first, ties by value. Null is left out or counted as a word."""
    value = F.col(column) if null_as is None else F.coalesce(F.col(column).cast("string"), F.lit(null_as))
    counted = df.select(value.alias(column)).where(F.col(column).isNotNull())
    return counted.groupBy(column).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), column)


def rows_by_source(df: DataFrame) -> DataFrame:
    return count_values(df, "source")


def rows_by_month(df: DataFrame, column: str = "published_at") -> DataFrame:
    """Rows per month, oldest first; rows without a time are left out."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(dates.month_label(F.col(column)).alias("month"))
            .agg(F.count("*").alias("rows")).orderBy("month"))


def rows_by_day(df: DataFrame, column: str = "published_at") -> DataFrame:
    return (df.where(F.col(column).isNotNull())
            .groupBy(dates.day_label(F.col(column)).alias("day"))
            .agg(F.count("*").alias("rows")).orderBy("day"))


def rows_by_month_and_source(df: DataFrame) -> DataFrame:
    return (df.where(F.col("published_at").isNotNull())
            .groupBy(dates.month_label(F.col("published_at")).alias("month"), "source")
            .agg(F.count("*").alias("rows")).orderBy("month", "source"))


def _require(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValueError(f"no column {column!r} among {df.columns}")


def time_coverage(df: DataFrame, column: str = "published_at") -> DataFrame:
    """Rows, rows with a time, first and last time."""
    _require(df, column)
    return df.agg(F.count("*").alias("rows"), F.count(column).alias("valid_dates"),
                  F.min(column).alias("first_time"), F.max(column).alias("last_time"))


def coverage_report(df: DataFrame, column: str = "published_at") -> DataFrame:
    """The whole coverage as (section, label, rows), from one scan.

    The table is first counted per day; months and totals are sums over that result.
    """
    _require(df, column)
    days = df.groupBy(dates.day_label(F.col(column)).alias("day")).agg(F.count("*").alias("c"))
    day = F.date_format("day", "yyyy-MM-dd")
    month = F.date_format("day", "yyyy-MM")
    dated = F.col("day").isNotNull()
    cells = F.array(
        F.struct(F.lit("rows").alias("section"), F.lit("all").alias("label")),
        F.when(dated, F.struct(F.lit("rows").alias("section"), F.lit("valid").alias("label"))),
        F.when(dated, F.struct(F.lit("month").alias("section"), month.alias("label"))),
        F.when(dated, F.struct(F.lit("day").alias("section"), day.alias("label"))))
    return (days.select(F.explode(F.array_compact(cells)).alias("k"), "c")
            .groupBy("k.section", "k.label").agg(F.sum("c").alias("rows"))
            .orderBy("section", "label"))


def source_distribution(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows per split and source in one aggregate."""
    both = train.select(F.lit("Train").alias("split"), "source").unionByName(
        test.select(F.lit("Test").alias("split"), "source"))
    return (both.where(F.col("source").isNotNull()).groupBy("split", "source")
            .agg(F.count("*").alias("rows")).orderBy("split", F.desc("rows"), "source"))


def any_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: does each column hold a value."""
    return df.agg(*[(F.count(c) > 0).alias(c) for c in columns])


def latest_month_rows(df: DataFrame, time: str = "published_at") -> DataFrame:
    """Rows of the last month present; the bound is one value, found by a small aggregate."""
    first = df.agg(F.date_trunc("month", F.max(time)).cast("timestamp_ntz")).scalar()
    return df.where(F.col(time) >= first)
