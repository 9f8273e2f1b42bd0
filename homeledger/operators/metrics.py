"""Regression errors, the median baseline and the choice of a model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from homeledger.functions.numbers import BILLION
from homeledger.operators.selection import exact_median

BASELINE, FOREST, RIDGE = "Baseline_Median", "Random_Forest", "Ridge_Regression"  # fixed values
# chart -> (metric column, descending)
RANKINGS = {"mae": ("MAE_BILLION_VND", False), "rmse": ("RMSE_BILLION_VND", False), "r2": ("R2", True)}


def target_median(df: DataFrame, column: str = "price") -> DataFrame:
    """Exact interpolated median: one row, column ``median``."""
    return exact_median(df, column)


def baseline_median(train: DataFrame, test: DataFrame) -> DataFrame:
    """The test rows with the train median as prediction."""
    return test.withColumn("predicted_price", target_median(train).scalar())


def regression_metrics(df: DataFrame, model: str, actual: str = "price",
                       predicted: str = "predicted_price") -> DataFrame:
    """MAE, RMSE and R² in one aggregate.

    A constant target has R² 1 when predicted exactly, else 0.
    """
    y, p = F.col(actual), F.col(predicted)
    err = y - p
    sums = df.agg(
        F.avg(F.abs(err)).alias("MAE_VND"), F.sqrt(F.avg(err * err)).alias("RMSE_VND"),
        F.sum(err * err).alias("sse"), (F.var_pop(y) * F.count(y)).alias("sst"))
    r2 = (F.when(F.col("sst") > 0, 1 - F.try_divide(F.col("sse"), F.col("sst")))
          .when(F.col("sse") == 0, F.lit(1.0)).when(F.col("sse") > 0, F.lit(0.0)))
    return sums.select(
        F.lit(model).alias("Model"), "MAE_VND", "RMSE_VND", r2.alias("R2"),
        (F.col("MAE_VND") / BILLION).alias("MAE_BILLION_VND"),
        (F.col("RMSE_VND") / BILLION).alias("RMSE_BILLION_VND"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def rank_models(metrics: DataFrame, column: str = "MAE_VND", descending: bool = False) -> DataFrame:
    order = F.col(column).desc() if descending else F.col(column).asc()
    return metrics.orderBy(order, "Model")


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the lowest MAE; when that is the baseline, the forest."""
    top = F.min_by("Model", F.struct("MAE_VND", "Model"))
    return metrics.agg(F.when(top == BASELINE, F.lit(FOREST)).otherwise(top).alias("best_model"))
