"""Schemas, column lists and thresholds shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

UNKNOWN = "Unknown"

# --- fixed values: column names and their order are part of the data contract ---
TEXT_COLUMNS = [
    "name", "description", "property_type_name", "province_name",
    "district_name", "ward_name", "street_name", "project_name",
]
NUMERIC_COLUMNS = [
    "floor_count", "frontage_width", "house_depth", "road_width",
    "bedroom_count", "bathroom_count",
]
DIRECTION_COLUMNS = ["house_direction", "balcony_direction"]
COMMON_COLUMNS = (
    TEXT_COLUMNS + ["price", "area"] + NUMERIC_COLUMNS + DIRECTION_COLUMNS
    + ["published_at", "source"]
)
DERIVED_COLUMNS = [
    "price_per_m2", "posted_year", "posted_month", "posted_day", "posted_dayofweek",
]
NUMERIC_FEATURES = ["area"] + NUMERIC_COLUMNS + [
    "posted_year", "posted_month", "posted_day", "posted_dayofweek",
]
CATEGORICAL_FEATURES = [
    "property_type_name", "province_name", "district_name", "ward_name",
    "street_name", "project_name", "house_direction", "balcony_direction",
]
NEVER_FEATURES = ["price", "price_per_m2", "name", "description", "source"]
POSITIONAL_COLUMNS = [
    "name", "description", "property_type_name", "province_name", "district_name",
    "ward_name", "street_name", "price", "area", "bedroom_count", "bathroom_count",
    "published_at", "url",
]
FLAT_AD_COLUMNS = [
    "AdId", "ListId", "Subject", "Address", "Ward", "District", "Region", "PriceVND",
    "PriceString", "AreaM2", "BedRooms", "BathRooms", "Floor", "PropertyStatus", "Type",
    "LegalStatus", "Interior", "MainDirection", "BalconyDirection", "SellerType",
    "PostDateText", "ListTimeRaw", "NgayDang", "CrawlDate", "Link",
]
# Sources in the order in which they are united; the order also breaks time ties.
SOURCES = ["huggingface", "chotot", "mogi"]
APARTMENT = "Căn hộ chung cư"
HCMC = "Hồ Chí Minh"

# Duplicate keys per stage.
DEDUPE_KEYS = {
    "chotot": ["name", "price", "area", "district_name", "ward_name"],
    "mogi": ["name", "price", "area", "district_name", "ward_name", "published_at"],
    "merged": ["name", "price", "area", "district_name", "ward_name", "published_at", "source"],
    "crawl": ["AdId", "ListId", "Subject"],
}
# --- end of fixed values ---

DOUBLE_COLUMNS = {"price", "area", *NUMERIC_COLUMNS, "price_per_m2"}


def common_type(column: str) -> T.DataType:
    if column in DOUBLE_COLUMNS:
        return T.DoubleType()
    if column == "published_at":
        return T.TimestampNTZType()
    return T.StringType()


COMMON_SCHEMA = T.StructType([T.StructField(c, common_type(c)) for c in COMMON_COLUMNS])
POSITIONAL_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in POSITIONAL_COLUMNS])
