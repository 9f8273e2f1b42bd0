"""Sinks and the scans that read their files back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from homeledger.functions import dates, numbers
from homeledger.sources.listings import read_headered_csv

# --- fixed values: required columns and preferred model ---
PREDICTION_REQUIRED = [
    "price", "predicted_price", "absolute_error", "area", "district_name", "source", "published_at",
]
METRIC_REQUIRED = ["Model", "MAE_BILLION_VND", "RMSE_BILLION_VND", "R2"]
METRIC_VALUES = ["MAE_VND", "RMSE_VND", "R2", "MAE_BILLION_VND", "RMSE_BILLION_VND"]
MAIN_MODEL = "Random_Forest"
# --- end of fixed values ---
PACKED_ROWS = 250_000  # rows of a packed CSV file, which only one task can read


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = (), packed: bool = False) -> str:
    """Overwrite one table. CSV has a header, no byte-order mark, and is for export.

    ``packed`` compresses CSV with gzip. Such files cannot be split, so they have at most ``PACKED_ROWS`` rows, each with its header.
    """
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        if packed:
            # the fastest level: the default one takes a quarter off the files but half as much time again
            writer = writer.options(**{"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": PACKED_ROWS})
        # without the last two, Spark would cut outer spaces and line breaks off the values
        writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    else:
        if partition_by:
            # gathers each month, and lets Spark split one that is far larger than others
            writer = df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
        writer.format(fmt).save(path)
    return path


def write_counted(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> tuple[dict[str, str], dict[str, int]]:
    """Each named table below ``folder``, and its number of rows as the writing tasks counted them: no scan counts again.

    The tables are written as they come, without gathering months, so that the counts are of the last stage.
    """
    paths, counts = {}, {}
    for name, df in tables.items():
        rows = Observation()
        paths[name] = write_table(df.observe(rows, F.count(F.lit(1)).alias("rows")), f"{folder}/{name}", fmt)
        counts[name] = rows.get["rows"]
    return paths, counts


def write_datasets(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet", packed: bool = True) -> dict[str, str]:
    """Each named table below ``folder``. Cleaned tables are partitioned by month. CSV, some seven times as large as the
    same rows in parquet, is packed unless the caller wants plain text."""
    written = {}
    for name, df in tables.items():
        by = ("posted_year", "posted_month")
        by = by if fmt == "parquet" and set(by) <= set(df.columns) else ()
        written[name] = write_table(df, f"{folder}/{name}", fmt, by, packed)
    return written


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def read_any(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".csv") or path.endswith("_csv"):
        return read_headered_csv(spark, path)
    return spark.read.parquet(path)


def billion_units(df: DataFrame) -> DataFrame:
    """Price, prediction and error in billions, and the month."""
    return df.withColumns({
        "price_billion": F.col("price") / numbers.BILLION,
        "predicted_billion": F.col("predicted_price") / numbers.BILLION,
        "error_billion": F.col("absolute_error") / numbers.BILLION,
        "month": dates.month_label(F.col("published_at")),
    })


def prepare_predictions(df: DataFrame) -> DataFrame:
    """Required columns, coerced; rows without a value in five of them go."""
    require_columns(df, PREDICTION_REQUIRED)
    number = ["price", "predicted_price", "absolute_error", "area"]
    typed = df.withColumns({
        **{c: numbers.try_number(F.col(c)) if not numbers.is_numeric(df.schema[c].dataType)
           else numbers.nan_to_null(F.col(c).cast("double")) for c in number},
        "published_at": dates.published_at_of(F.col("published_at"), df.schema["published_at"].dataType),
    })
    return billion_units(typed.dropna(subset=[*number, "published_at"]))


def scan_predictions(spark: SparkSession, path: str) -> DataFrame:
    return prepare_predictions(read_any(spark, path))


def _split_side(spark: SparkSession, path: str, label: str) -> DataFrame | None:
    try:
        df = read_any(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    when = dates.published_at_of(F.col("published_at"), df.schema["published_at"].dataType)
    return df.withColumn("published_at", when).withColumn("split", F.lit(label))


def scan_split_tables(spark: SparkSession, train_path: str, test_path: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Train and test tables, tagged; an absent one is None."""
    return _split_side(spark, train_path, "Train"), _split_side(spark, test_path, "Test")


def scan_metrics(df: DataFrame) -> DataFrame:
    """Metrics with numbers coerced: what is missing or no number is null."""
    require_columns(df, METRIC_REQUIRED)
    return df.withColumns({
        c: (numbers.nan_to_null(F.col(c).cast("double")) if numbers.is_numeric(df.schema[c].dataType)
            else numbers.try_number(F.col(c))) if c in df.columns else F.lit(None).cast("double")
        for c in METRIC_VALUES})


def pick_metrics(metrics: DataFrame, order: str | None = None) -> DataFrame:
    """The forest's row if there is one, else the first row in ``order``.

    ``order`` defaults to the error by which a metrics table is written.
    """
    first = F.col(order) if order else F.col("MAE_VND")
    return metrics.orderBy((F.col("Model") != MAIN_MODEL).cast("int"), first, "Model").limit(1)
