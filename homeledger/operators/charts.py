"""The tables behind the report charts. Each is small; only point sets follow the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from homeledger.functions import dates
from homeledger.operators import coverage
from homeledger.operators.metrics import union_all
from homeledger.operators.selection import exact_quantiles
from homeledger.session import cut_lineage

# fixed values: chart limits
MAX_PRICE_BILLION = 50
MAX_AREA = 300
BINS = 50
SOURCE_COLUMNS = ["chotot", "huggingface", "mogi"]
SPLIT_COLUMNS = ["Test", "Train"]


def chart_trim(df: DataFrame, *columns: str) -> DataFrame:
    """Rows within the chart limits of the named columns; null is outside."""
    limits = {"price_billion": MAX_PRICE_BILLION, "predicted_billion": MAX_PRICE_BILLION, "area": MAX_AREA}
    for c in columns:
        df = df.where(F.col(c) <= limits[c])
    return df


def scatter_points(df: DataFrame, kind: str = "area_price") -> DataFrame:
    """All points of a scatter chart, within its limits."""
    x, y = ("area", "price_billion") if kind == "area_price" else ("price_billion", "predicted_billion")
    return chart_trim(df, x, y).select(F.col(x).alias("x"), F.col(y).alias("y"))


def scatter_bins(points: DataFrame, width_x: float, width_y: float) -> DataFrame:
    """The same points counted on a grid: what a drawing can show of a large table."""
    return (points.groupBy(F.floor(F.col("x") / width_x).alias("x_bin"),
                           F.floor(F.col("y") / width_y).alias("y_bin"))
            .agg(F.count("*").alias("rows")))


def histogram(df: DataFrame, column: str, bins: int = BINS) -> DataFrame:
    """Equal bins over [min, max]: ``bin`` from 1, ``low``, ``high``, ``rows``.

    The last bin is closed, empty bins are listed, one repeated value gets ±0.5.
    """
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    span = ends.select(F.struct(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi")).alias("s")).scalar()
    lo, width = span["lo"], span["hi"] - span["lo"]
    place = F.least(F.floor((F.col(column) - lo) * bins / width), F.lit(bins - 1)) + 1
    counted = (df.where(F.col(column).isNotNull()).groupBy(place.cast("int").alias("bin"))
               .agg(F.count("*").alias("rows")))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    step = width / bins
    return (every.join(F.broadcast(counted), "bin", "left")  # at most one row per bin
            .select("bin", (lo + (F.col("bin") - 1) * step).alias("low"),
                    (lo + F.col("bin") * step).alias("high"),
                    F.coalesce("rows", F.lit(0)).alias("rows")))


def trim_above_quantile(df: DataFrame, column: str, prob: float = 0.99) -> DataFrame:
    """Rows at or below the exact quantile of a column."""
    cut = exact_quantiles(df, column, [prob]).select("quantile").scalar()
    return df.where(F.col(column) <= cut)


def error_histogram(df: DataFrame) -> DataFrame:
    return histogram(trim_above_quantile(df, "error_billion"), "error_billion")


def top_districts(df: DataFrame, n: int = 15) -> DataFrame:
    """The districts with most rows; a missing name counts as ``nan``."""
    return coverage.count_values(df, "district_name", null_as="nan").limit(n)


def in_top_districts(df: DataFrame, n: int = 10) -> DataFrame:
    """Rows of the ``n`` largest districts; the joined side has ``n`` rows at most."""
    named = df.withColumn("district_name", F.coalesce("district_name", F.lit("nan")))
    top = top_districts(df, n).select("district_name")
    return named.join(F.broadcast(top), "district_name", "left_semi")


def boxplot_by_district(df: DataFrame, n: int = 10) -> DataFrame:
    """Quartiles and whiskers of the price per large district, without outliers.

    A whisker ends at the last value within 1.5 interquartile ranges, and never inside
    the box.
    """
    kept = in_top_districts(chart_trim(df, "price_billion"), n)
    wide = exact_quantiles(kept, "price_billion", [0.25, 0.5, 0.75], ["district_name"], few_groups=True)

    def at(p: float) -> Column:
        return F.max(F.when(F.col("prob") == p, F.col("quantile")))

    box = wide.groupBy("district_name").agg(
        F.max("n").alias("rows"), at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    price = F.col("price_billion")
    ends = (kept.select("district_name", "price_billion").join(F.broadcast(box), "district_name")
            .groupBy("district_name", "rows", "q1", "median", "q3")
            .agg(F.min(F.when(price >= F.col("q1") - reach, price)).alias("lo"),
                 F.max(F.when(price <= F.col("q3") + reach, price)).alias("hi")))
    return ends.select("district_name", "rows", "q1", "median", "q3",
                       F.least("lo", "q1").alias("whisker_low"),
                       F.greatest("hi", "q3").alias("whisker_high"))


def _month_pivot(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    timed = df.where(F.col("published_at").isNotNull())
    month = dates.month_label(F.col("published_at")).alias("month")
    # the column list is known, so the pivot is one pass with one counter per value
    return timed.groupBy(month).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values]).orderBy("month")


def union_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("split", F.lit("Train")).unionByName(
        test.withColumn("split", F.lit("Test")), allowMissingColumns=True)


def pivot_month_split(both: DataFrame) -> DataFrame:
    return _month_pivot(both, "split", SPLIT_COLUMNS)


def pivot_month_source(both: DataFrame, sources: list[str] = SOURCE_COLUMNS) -> DataFrame:
    return _month_pivot(both, "source", sources)


def axis_bounds(df: DataFrame) -> DataFrame:
    """Ends of the diagonal of actual against predicted."""
    kept = chart_trim(df, "price_billion", "predicted_billion")
    return kept.agg(
        F.least(F.min("price_billion"), F.min("predicted_billion")).alias("low"),
        F.greatest(F.max("price_billion"), F.max("predicted_billion")).alias("high"))


def value_ranges(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"),
                  F.min("price_billion").alias("price_min"), F.max("price_billion").alias("price_max"),
                  F.min("area").alias("area_min"), F.max("area").alias("area_max"))


def _long(df: DataFrame, chart: str, label: Column, value: str) -> DataFrame:
    return df.select(F.lit(chart).alias("chart"), label.cast("string").alias("label"),
                     F.col(value).cast("double").alias("value"))


def _unpivot(pivot: DataFrame, values: list[str]) -> DataFrame:
    """(chart, label, value) of a month pivot, one chart per column."""
    return pivot.select(F.inline(F.array(*[
        F.struct(F.lit(f"month_{v}").alias("chart"), F.col("month").alias("label"), F.col(v).cast("double").alias("value"))
        for v in values])))


def report_tables(predictions: DataFrame, train: DataFrame, test: DataFrame, metrics: DataFrame) -> DataFrame:
    """The counted charts and the model comparison in one long table.

    The few columns that the charts need are written once and read by each; a pivot is made once
    for all its columns.
    """
    needed = ["price_billion", "predicted_billion", "error_billion", "area", "district_name", "source", "published_at"]
    predictions = cut_lineage(predictions.select(*needed), "charts")
    month = dates.month_label(F.col("published_at")).alias("month")
    narrow = [df.select(month, *["source"] * ("source" in df.columns)) for df in (train, test)]
    both = cut_lineage(union_splits(*narrow).groupBy("month", "source", "split").agg(F.count("*").alias("rows")), "months")

    def pivot(column: str, values: list[str]) -> DataFrame:
        counts = [F.coalesce(F.sum(F.when(F.col(column) == v, F.col("rows"))), F.lit(0)).alias(v) for v in values]
        return both.where(F.col("month").isNotNull()).groupBy("month").agg(*counts)

    bins = F.format_string("%02d", F.col("bin"))
    parts = [
        _long(histogram(chart_trim(predictions, "price_billion"), "price_billion"), "price", bins, "rows"),
        _long(histogram(chart_trim(predictions, "area"), "area"), "area", bins, "rows"),
        _long(error_histogram(predictions), "error", bins, "rows"),
        _long(top_districts(predictions), "districts", F.col("district_name"), "rows"),
        _long(boxplot_by_district(predictions), "box_median", F.col("district_name"), "median"),
        _long(coverage.count_values(predictions, "source", "nan"), "test_source", F.col("source"), "rows"),
        _long(coverage.rows_by_month(predictions), "test_month", F.col("month"), "rows"),
        _unpivot(pivot("split", SPLIT_COLUMNS), SPLIT_COLUMNS),
        _unpivot(pivot("source", SOURCE_COLUMNS), SOURCE_COLUMNS)]
    for chart, column in (("mae", "MAE_BILLION_VND"), ("rmse", "RMSE_BILLION_VND"), ("r2", "R2")):
        parts.append(_long(metrics, chart, F.col("Model"), column))
    return union_all(parts)
