"""Scoring requests: form text to features, price, error band, formatted answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from homeledger import schema as S
from homeledger.functions import numbers, text
from homeledger.operators.models import PriceModel

# --- fixed values: form fields and what an absent field stands for ---
NUMBER_FIELDS = {
    "area": "area", "floor_count": "floor_count", "frontage_width": "frontage_width",
    "house_depth": "house_depth", "road_width": "road_width",
    "bedrooms": "bedroom_count", "bathrooms": "bathroom_count",
}
DATE_DEFAULTS = {"published_year": 2026, "published_month": 5, "published_day": 1}
TEXT_FIELDS = {
    "property_type": "property_type_name", "province": "province_name", "district": "district_name",
    "ward": "ward_name", "street": "street_name", "project_name": "project_name",
    "house_direction": "house_direction", "balcony_direction": "balcony_direction",
}
TEXT_DEFAULTS = {
    "property_type": S.APARTMENT, "province": S.HCMC, "district": "", "ward": "", "street": "",
    "project_name": "", "house_direction": S.UNKNOWN, "balcony_direction": S.UNKNOWN,
}
REQUEST_FIELDS = [*NUMBER_FIELDS, *TEXT_FIELDS, *DATE_DEFAULTS]
# --- end of fixed values ---


def _weekday(year: Column, month: Column, day: Column) -> Column:
    """0 is Monday; a date that does not exist counts as 0."""
    joined = F.format_string("%04d-%02d-%02d", year, month, day)
    return F.coalesce(F.weekday(joined.try_cast("date")), F.lit(0))


def request_features(requests: DataFrame, variant: str = "web") -> DataFrame:
    """Model features beside the other columns of the request table.

    ``web`` parses and normalises form text. ``cli`` takes the values as they are, with
    the weekday given by the caller, 0 if not.
    """
    have = set(requests.columns)
    web = variant == "web"

    def field(name: str) -> Column:
        # an absent form column is an absent field, a null in a present one likewise
        default = F.lit(TEXT_DEFAULTS[name])
        return F.coalesce(F.col(name), default) if name in have else default

    out: dict[str, Column] = {}
    for name, feature in NUMBER_FIELDS.items():
        given = F.col(name).cast("string") if name in have else F.lit(None).cast("string")
        out[feature] = numbers.parse_or_default(given)
    year, month, day = (
        numbers.parse_or_default(F.col(n).cast("string") if n in have else F.lit(None).cast("string"), "int", d)
        for n, d in DATE_DEFAULTS.items())
    out |= {"posted_year": year, "posted_month": month, "posted_day": day}
    if web:
        out["posted_dayofweek"] = _weekday(year, month, day)
    else:
        given = F.col("published_dayofweek").cast("int") if "published_dayofweek" in have else F.lit(0)
        out["posted_dayofweek"] = F.coalesce(given, F.lit(0))
    rules = {
        "province": lambda c: text.normalize_province(c, "web"),
        "district": lambda c: text.normalize_district(c, "web"),
        "ward": lambda c: text.normalize_ward(c, "web"),
        "house_direction": lambda c: text.normalize_direction(c, "web"),
        "balcony_direction": lambda c: text.normalize_direction(c, "web"),
    }
    for name, feature in TEXT_FIELDS.items():
        rule = rules.get(name, text.clean_text) if web else (lambda c: c)
        out[feature] = rule(field(name))
    rest = [c for c in requests.columns if c not in REQUEST_FIELDS and c not in out]
    return requests.select(*rest, *[out[c].alias(c) for c in S.NUMERIC_FEATURES + S.CATEGORICAL_FEATURES])


def band_columns(df: DataFrame, mae: Column) -> DataFrame:
    lower, upper = numbers.prediction_band(F.col("predicted_price"), mae)
    return df.withColumns({"lower": lower, "upper": upper})


def format_answer(df: DataFrame) -> DataFrame:
    """Text columns of an answer from its numbers; null stays null."""
    return df.withColumns({
        "price_vnd": numbers.format_vnd(F.col("predicted_price")),
        "price_billion": numbers.format_billion(F.col("predicted_price")),
        "lower_text": numbers.format_billion(F.col("lower")),
        "upper_text": numbers.format_billion(F.col("upper")),
    })


def score_requests(requests: DataFrame, model: PriceModel, metrics: DataFrame | None = None,
                   variant: str = "web") -> DataFrame:
    """Batch answer to a table of requests.

    ``metrics`` is the one row of ``pick_metrics``; without it the band is null.
    """
    scored = model.predict(request_features(requests, variant), floor=variant == "web")
    if metrics is None:
        known = {c: F.lit(None).cast("double") for c in ("MAE_VND", "RMSE_VND", "R2")}
    else:
        row = metrics.select(F.struct("MAE_VND", "RMSE_VND", "R2").alias("m")).scalar()
        known = {c: row[c] for c in ("MAE_VND", "RMSE_VND", "R2")}
    scored = scored.withColumns({
        "mae_vnd": numbers.format_vnd(known["MAE_VND"]), "rmse_vnd": numbers.format_vnd(known["RMSE_VND"]),
        "r2": numbers.fixed(known["R2"], 3)})
    return format_answer(band_columns(scored, known["MAE_VND"]))
