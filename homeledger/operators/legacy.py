"""The older, alias-tolerant cleaner of flat ads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from homeledger.functions import dates, numbers, text
from homeledger.operators.standardize import evaluate_once, first_existing

# --- fixed values: column names that older files use, in order of preference ---
DATE_FALLBACKS = ["CrawlDate", "crawl_date", "created_at", "date"]
PRICE_NAMES = ["PriceVND", "price", "Gia", "price_vnd"]
NUMBER_NAMES = {
    "AreaM2": ["AreaM2", "DienTich", "area", "size", "area_m2"],
    "BedRooms": ["BedRooms", "Phongngu", "bedrooms", "rooms"],
    "BathRooms": ["BathRooms", "PhongTam", "bathrooms", "toilets"],
    "Floor": ["Floor", "SoTang", "floor"],
}
ADDRESS_NAMES = ["Address", "DiaChi", "address"]
DISTRICT_NAMES = ["District", "district", "area_name"]
CATEGORY_NAMES = {
    "Ward": ["Ward", "ward", "ward_name"],
    "PropertyStatus": ["PropertyStatus", "TinhTrangBDS", "property_status", "condition_ad"],
    "Type": ["Type", "Loai", "type", "category_name"],
    "LegalStatus": ["LegalStatus", "GiayTo", "legal_status"],
    "Interior": ["Interior", "TinhTrangNoiThat", "interior"],
    "MainDirection": ["MainDirection", "HuongCuaChinh", "direction"],
    "BalconyDirection": ["BalconyDirection", "HuongBanCong", "balcony_direction"],
    "Characteristic": ["Characteristic", "DacDiem", "characteristic"],
    "SellerType": ["SellerType", "seller_type", "account_type"],
}
MIN_PRICE, MAX_PRICE = 100_000_000, 200_000_000_000
MIN_AREA, MAX_AREA = 10, 1000
LEGACY_NUMERIC = ["AreaM2", "BedRooms", "BathRooms", "Floor", "PostedYear", "PostedMonth"]
LEGACY_CATEGORICAL = [
    "District", "Ward", "PropertyStatus", "Type", "LegalStatus", "Interior",
    "MainDirection", "BalconyDirection", "Characteristic", "SellerType",
]
# --- end of fixed values ---


def strip_names(df: DataFrame) -> DataFrame:
    """Column names without outer spaces."""
    return df.toDF(*[c.strip() for c in df.columns])


def resolve_aliases(df: DataFrame, date_column: str = "NgayDang") -> DataFrame:
    """Every target column from the first of its names that exists, typed and cleaned."""
    df = strip_names(df)
    types: dict[str, T.DataType] = {f.name: f.dataType for f in df.schema.fields}
    when = date_column if date_column in types else first_existing(df.columns, DATE_FALLBACKS)
    if when is None:
        raise ValueError(f"no date column: neither {date_column!r} nor one of {DATE_FALLBACKS}")
    price = first_existing(df.columns, PRICE_NAMES)
    if price is None:
        raise ValueError(f"no price column among {PRICE_NAMES}")

    out: dict[str, Column] = {
        "NgayDang": dates.published_at_of(F.col(when), types[when]),
        "PriceVND": numbers.parse_price_legacy(F.col(price), numbers.is_numeric(types[price])),
    }
    for target, names in NUMBER_NAMES.items():
        c = first_existing(df.columns, names)
        out[target] = (numbers.parse_float_vn(F.col(c), numbers.is_numeric(types[c])) if c
                       else F.lit(None).cast("double"))
    district, address = (first_existing(df.columns, n) for n in (DISTRICT_NAMES, ADDRESS_NAMES))
    if district:
        out["District"] = text.normalize_text(F.col(district).cast("string"))
    elif address:
        out["District"] = text.extract_district(F.col(address))
    else:
        out["District"] = F.lit(None).cast("string")
    for target, names in CATEGORY_NAMES.items():
        c = first_existing(df.columns, names)
        out[target] = text.normalize_text(F.col(c).cast("string")) if c else F.lit(None).cast("string")
    rest = [c for c in df.columns if c not in out]
    parsed = {c: out.pop(c) for c in ("NgayDang", "PriceVND", "AreaM2")}
    typed = F.struct(*[v.alias(f"_{k}") for k, v in parsed.items()])
    resolved = evaluate_once(df, {"_parsed": typed})
    resolved = resolved.select(*rest, *[F.col(f"_parsed._{c}").alias(c) for c in parsed],
                               *[v.alias(k) for k, v in out.items()])
    return resolved.withColumns({"PostedYear": F.year("NgayDang"), "PostedMonth": F.month("NgayDang")})


def legacy_filter(df: DataFrame) -> DataFrame:
    """Time and price present and plausible; an area, where known, plausible too."""
    return df.where(
        F.col("NgayDang").isNotNull() & F.col("PriceVND").between(MIN_PRICE, MAX_PRICE)
        & (F.col("AreaM2").isNull() | F.col("AreaM2").between(MIN_AREA, MAX_AREA)))


def legacy_clean(df: DataFrame, date_column: str = "NgayDang") -> DataFrame:
    return legacy_filter(resolve_aliases(df, date_column))


def filled_features(df: DataFrame) -> DataFrame:
    """Values per candidate feature: ``feature``, ``kind``, ``filled``; one pass."""
    kinds = {**{c: "numeric" for c in LEGACY_NUMERIC}, **{c: "categorical" for c in LEGACY_CATEGORICAL}}
    present = [c for c in kinds if c in df.columns]
    counts = df.agg(*[F.count(c).alias(c) for c in present])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(kinds[c]).alias("kind"), F.col(c).alias("filled"))
        for c in present])))


def prune_null_features(df: DataFrame) -> tuple[list[str], list[str]]:
    """The numeric and categorical features that exist and hold a value."""
    kept = {r["feature"] for r in filled_features(df).where("filled > 0").collect()}  # 16 rows at most
    return [c for c in LEGACY_NUMERIC if c in kept], [c for c in LEGACY_CATEGORICAL if c in kept]
