"""Row filters, derived columns and the cleaning funnel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from homeledger import schema as S
from homeledger.functions import dates, text


@dataclass(frozen=True)
class Limits:
    """Inclusive ranges: VND, square metres, VND per square metre."""

    # fixed values: defaults
    min_price: float = 100_000_000
    max_price: float = 100_000_000_000
    min_area: float = 10
    max_area: float = 500
    min_price_per_m2: float = 5_000_000
    max_price_per_m2: float = 1_000_000_000


DEFAULT_LIMITS = Limits()
REQUIRED = ["price", "area", "published_at"]


def drop_required_nulls(df: DataFrame, columns: list[str] = REQUIRED) -> DataFrame:
    return df.dropna(subset=columns)


def price_area_ok(limits: Limits = DEFAULT_LIMITS) -> Column:
    return (F.col("price").between(limits.min_price, limits.max_price)
            & F.col("area").between(limits.min_area, limits.max_area))


def filter_price_area(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    return df.where(price_area_ok(limits))


def price_per_m2() -> Column:
    return F.try_divide(F.col("price"), F.col("area"))


def price_per_m2_filter(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    return df.withColumn("price_per_m2", price_per_m2()).where(
        F.col("price_per_m2").between(limits.min_price_per_m2, limits.max_price_per_m2))


def with_date_parts(df: DataFrame) -> DataFrame:
    return df.withColumns(dates.date_parts(F.col("published_at")))


def fill_categories(df: DataFrame) -> DataFrame:
    """The milder text cleaning of the single-source run."""
    return df.withColumns({c: text.fill_category(F.col(c)) for c in S.CATEGORICAL_FEATURES})


def clean_for_model(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Required values, price and area ranges, price per m², date parts.

    Rows are not sorted: order is an explicit column here, and sinks sort.
    """
    kept = filter_price_area(drop_required_nulls(df), limits)
    return with_date_parts(price_per_m2_filter(kept, limits))


def filter_segment(df: DataFrame, province: str = "", property_type: str = "",
                   mode: str = "fixed") -> DataFrame:
    """Rows of one province and property type.

    ``fixed`` normalises both and requires both; ``merge`` normalises and treats an
    empty argument as no filter; ``single`` only trims, and an empty argument is no filter.
    """
    if mode == "single":
        values = text.filter_text(F.col("province_name")), text.filter_text(F.col("property_type_name"))
    elif mode in ("fixed", "merge"):
        values = (text.normalize_province(F.col("province_name"), mode),
                  text.clean_text(F.col("property_type_name")))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    for value, wanted in zip(values, (province, property_type)):
        if wanted or mode == "fixed":
            df = df.where(value == wanted)
    return df


def _funnel_steps(limits: Limits) -> list[tuple[str, Column]]:
    present = F.lit(True)
    for c in REQUIRED:
        present = present & F.col(c).isNotNull()
    priced = present & F.col("price").between(limits.min_price, limits.max_price)
    sized = priced & F.col("area").between(limits.min_area, limits.max_area)
    rated = sized & price_per_m2().between(limits.min_price_per_m2, limits.max_price_per_m2)
    return [("input", F.lit(True)), ("required", present), ("price", priced),
            ("area", sized), ("price_per_m2", rated)]


def cleaning_funnel(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Rows left after each cleaning step, in one pass: ``step_no``, ``step``, ``rows``."""
    steps = _funnel_steps(limits)
    counts = df.agg(*[F.count_if(cond).alias(name) for name, cond in steps])
    rows = F.array(*[
        F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.col(name).alias("rows"))
        for i, (name, _) in enumerate(steps)])
    return counts.select(F.inline(rows))


def observed_funnel(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> tuple[DataFrame, Observation]:
    """The cleaned rows, and an observation that has the funnel's counts once they have been written.

    The counts are taken by the tasks that write, so the funnel costs no scan of its own. Write without a
    shuffle in between: a task of an earlier stage that runs again after a lost executor would count twice.
    """
    counts = Observation()
    seen = df.observe(counts, *[F.count_if(cond).alias(name) for name, cond in _funnel_steps(limits)])
    return clean_for_model(seen, limits), counts


def funnel_table(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """``step_no``, ``step``, ``rows`` from the counts of an observation."""
    return spark.createDataFrame([(i, name, counts[name]) for i, (name, _) in enumerate(_funnel_steps(DEFAULT_LIMITS))],
                                 "step_no int, step string, rows bigint")
