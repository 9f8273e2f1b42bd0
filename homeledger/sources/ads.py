"""Nested ad JSON to flat ads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from homeledger import schema as S
from homeledger.functions.dates import epoch_to_timestamp

# --- fixed values: names in the ad documents ---
PARAM_CONTAINERS = ["ad_params", "parameters", "params"]
PARAM_FIELDS = ["id", "name", "label", "key", "value", "value_name"]
AD_PARAMS = {
    "AreaM2": ["size", "area", "living_size", "m2"],
    "BedRooms": ["rooms", "bedrooms", "apartment_bedroom"],
    "BathRooms": ["toilets", "bathrooms", "apartment_toilet"],
    "Floor": ["floors", "floor", "apartment_floor"],
    "PropertyStatus": ["condition_ad", "property_status", "condition"],
    "Type": ["apartment_type", "type", "category"],
    "LegalStatus": ["property_legal_document", "legal_status", "legal"],
    "Interior": ["furnishing_sell", "interior", "furnishing"],
    "MainDirection": ["direction", "house_direction"],
    "BalconyDirection": ["balcony_direction"],
}
AD_FIELDS = [
    "ad_id", "list_id", "subject", "address", "ward_name", "ward", "area_name", "area",
    "region_name", "region", "price", "price_string", "list_time", "date_timestamp",
    "created_at", "account_type", "seller_type", "date", "ad_link", "webp_image", "url",
]
KEY_FIELDS = {"AdId": "ad_id", "ListId": "list_id", "Subject": "subject"}
URL_FIELDS = ["ad_link", "webp_image", "url"]
AD_URL = ("https://www.chotot.com/", ".htm")
# --- end of fixed values ---

_TOP = list(dict.fromkeys([*AD_FIELDS, *[k for keys in AD_PARAMS.values() for k in keys]]))
_PARAM = T.StructType([T.StructField(f, T.StringType()) for f in PARAM_FIELDS])
# Elements stay JSON text at first, so one element of another kind spoils no list and no page.
_LISTS = [T.StructField(c, T.ArrayType(T.StringType())) for c in PARAM_CONTAINERS]
_AD_TEXT = T.StructType([*(T.StructField(f, T.StringType()) for f in _TOP), *_LISTS])
# The same fields read as booleans: text has lost whether ``false`` was in quotes.
_AD_FLAGS = T.StructType([T.StructField(f, T.BooleanType()) for f in _TOP])
_PARAM_FLAGS = T.StructType([T.StructField(f, T.BooleanType()) for f in PARAM_FIELDS])
PAGE_SCHEMA = T.StructType([
    T.StructField("ads", T.ArrayType(T.StringType())),
    T.StructField("data", T.ArrayType(T.StringType()))])


def truthy(c: Column) -> Column:
    """Null for what counts as absent: null, empty text, zero, an empty object or list."""
    return F.when(~c.isin("", "0", "0.0", "{}", "[]"), c)


def truthy_coalesce(*columns: Column) -> Column:
    return F.coalesce(*[truthy(c) for c in columns])


def _false_names(flags: Column, names: Sequence[str]) -> Column:
    """The fields whose JSON value is the literal false; none without flags."""
    named = F.array(*[F.when(~flags[n], F.lit(n)) for n in names])
    return F.filter(named, lambda n: n.isNotNull())


def first_true(record: Column, *names: str) -> Column:
    """The first field of ``record`` that counts as present."""
    return F.coalesce(*[F.when(~F.array_contains(record["untrue"], n), truthy(record[n])) for n in names])


def _parsed_or_null(text: Column, flags: T.StructType) -> Column:
    """The booleans among the fields, parsed only where the word ``false`` occurs at all."""
    return F.when(F.contains(text, F.lit("false")), F.from_json(text, flags))


def _details(ad: Column) -> Column:
    """The items of the detail lists in order: their names in lower case, and their value.

    Each item is parsed once: the first ``transform`` makes structs, and the next one reads fields
    of those. An expression inside a lambda is evaluated wherever it stands, so a parser must not
    stand in one more than once.
    """
    empty = F.array().cast("array<string>")
    texts = F.filter(F.concat(*[F.coalesce(ad[c], empty) for c in PARAM_CONTAINERS]), lambda t: F.ltrim(t).startswith("{"))
    items = F.transform(texts, lambda t: F.struct(F.from_json(t, _PARAM).alias("item"), _parsed_or_null(t, _PARAM_FLAGS).alias("flags")))

    def detail(x: Column) -> Column:
        item, flags = x["item"], x["flags"]
        record = [F.when(F.coalesce(flags[f], F.lit(True)), item[f]) for f in ("value", "value_name", "label")]
        names = F.array(*[F.lower(item[f]) for f in ("id", "name", "label", "key")])
        return F.struct(names.alias("names"), truthy_coalesce(*record).alias("value"))

    return F.transform(items, detail)


def parse_ads(df: DataFrame, text: str = "ad_json") -> DataFrame:
    """Column ``text`` of ad objects replaced by ``ad``: the fields as text, the names of those that are
    ``false`` in ``untrue``, and the items of the detail lists in ``details``.

    An item's value is the first truthy of its value, value name and label, even if none is. Items that
    are no object are skipped. Each step passes an ``inline`` of one element, behind which its result is a column,
    not an expression to be evaluated again.
    """
    rest = [F.col(c) for c in df.columns if c != text]
    parsed = df.select(*rest, F.inline(F.array(F.struct(
        F.from_json(F.col(text), _AD_TEXT).alias("_ad"), _parsed_or_null(F.col(text), _AD_FLAGS).alias("_flags")))))
    ad = F.col("_ad")
    return parsed.select(*rest, F.inline(F.array(F.struct(F.struct(
        *[ad[f].alias(f) for f in _TOP], _false_names(F.col("_flags"), _TOP).alias("untrue"), _details(ad).alias("details")).alias("ad")))))


def read_ad_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Captured pages, one document per line; with ``multi_line`` one per file, which is one task
    whatever its size."""
    return spark.read.schema(PAGE_SCHEMA).option("multiLine", multi_line).json(path)


def parse_pages(df: DataFrame, text: str = "page_text") -> DataFrame:
    """Column ``text`` of captured answers replaced by ``ads``, ``data`` and ``failed``, which marks what is no JSON object."""
    rest = [F.col(c) for c in df.columns if c != text]
    whole = F.ltrim(F.coalesce(F.col(text), F.lit(""))).startswith("{") & F.try_parse_json(F.col(text)).isNotNull()
    parsed = df.select(*rest, F.inline(F.array(F.struct(F.from_json(F.col(text), PAGE_SCHEMA).alias("_page"), (~whole).alias("failed")))))
    return parsed.select(*rest, "_page.ads", "_page.data", "failed")


def read_page_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(crawl, page, ads, data, failed) of folders of captured answers, a file a page: the page is the last number in the
    file's name, the crawl is its folder."""
    name = F.col("_metadata.file_path")
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True)
    return parse_pages(files.select(
        F.regexp_extract(name, "^(.*)/[^/]*$", 1).alias("crawl"),
        F.regexp_extract(name, r"(\d+)\D*$", 1).cast("bigint").alias("page"), F.col("value").alias("page_text")))


def until_empty(pages: DataFrame, crawl: Sequence[str] = ("crawl",), page: str = "page", first: int = 0) -> DataFrame:
    """The pages that a crawl takes, from page ``first`` on: failed ones are skipped, and the first answer without ads ends it.

    One number a crawl is aggregated and joined back; a crawl goes on later from ``crawl_ends``.
    """
    taken = pages.where(F.col(page) >= first)
    ends = crawl_ends(pages, crawl, page, first).select(*crawl, "stopped_at")
    return taken.join(ends, list(crawl), "left").where(
        ~F.col("failed") & (F.col("stopped_at").isNull() | (F.col(page) < F.col("stopped_at")))).drop("stopped_at", "failed")


def crawl_ends(pages: DataFrame, crawl: Sequence[str] = ("crawl",), page: str = "page", first: int = 0) -> DataFrame:
    """Per crawl: ``stopped_at``, its first empty page or null, and ``next_page``, where to go on."""
    empty = ~F.col("failed") & ~(F.coalesce(F.size("ads") > 0, F.lit(False)) | F.coalesce(F.size("data") > 0, F.lit(False)))
    ends = pages.where(F.col(page) >= first).groupBy(*crawl).agg(
        F.min(F.when(empty, F.col(page))).alias("stopped_at"), F.max(page).alias("_last"))
    return ends.select(*crawl, "stopped_at", F.coalesce("stopped_at", F.col("_last") + 1).alias("next_page"))


def ad_texts(pages: DataFrame, place: str | None = None) -> DataFrame:
    """One row per ad object, its JSON text in ``ad_json``: of ``ads`` if it has elements, else of ``data``.

    Other columns of ``pages`` stay. Elements that are no object are skipped. ``place`` names a
    column for the ad's place in its page.
    """
    chosen = F.when(F.size("ads") > 0, F.col("ads")).otherwise(F.col("data"))
    rest = [c for c in pages.columns if c not in ("ads", "data")]
    found = F.posexplode(chosen).alias(place, "ad_json") if place else F.explode(chosen).alias("ad_json")
    return pages.select(*rest, found).where(F.ltrim("ad_json").startswith("{"))


def explode_ad_pages(pages: DataFrame, place: str | None = None) -> DataFrame:
    """The ads of ``ad_texts``, parsed."""
    return parse_ads(ad_texts(pages, place))


def with_ad_keys(texts: DataFrame, text: str = "ad_json") -> DataFrame:
    """What tells ads apart (AdId, ListId, Subject) beside their text, without parsing the rest of it."""
    keys = F.from_json(F.col(text), T.StructType([T.StructField(f, T.StringType()) for f in KEY_FIELDS.values()]))
    parsed = texts.select(*texts.columns, F.inline(F.array(keys)).alias(*[f"_{k}" for k in KEY_FIELDS]))
    return parsed.select(*texts.columns, *[F.col(f"_{k}").alias(k) for k in KEY_FIELDS])


def extract_param(ad: Column, keys: Sequence[str]) -> Column:
    """A detail by any of its names.

    A top-level field wins if it is neither null nor empty, zero included. Otherwise the
    first item of the parameter lists that carries one of the names decides, by the
    first truthy of its value, value name and label, even when that is null.
    """
    top = [F.nullif(ad[k], F.lit("")) for k in keys if k in _TOP]
    wanted = F.array(*[F.lit(k.lower()) for k in keys])
    found = F.filter(ad["details"], lambda e: F.arrays_overlap(e["names"], wanted))
    return F.coalesce(*top, F.get(found, F.lit(0))["value"])


def build_ad_url(ad: Column) -> Column:
    links = [F.when(ad[f].startswith("http"), ad[f]) for f in URL_FIELDS]
    number = first_true(ad, "list_id", "ad_id")
    return F.coalesce(*links, F.concat(F.lit(AD_URL[0]), number, F.lit(AD_URL[1])))


def flatten_ad(ads: DataFrame, crawl_time: Column, zone: str | None = None) -> DataFrame:
    """Column ``ad`` to 25 flat text columns, in one projection."""
    ad = F.col("ad")
    listed = first_true(ad, "list_time", "date_timestamp", "created_at")
    flat = {
        **{name: ad[f] for name, f in KEY_FIELDS.items()},
        "Address": ad["address"],
        "Ward": first_true(ad, "ward_name", "ward"),
        "District": first_true(ad, "area_name", "area"),
        "Region": first_true(ad, "region_name", "region"),
        "PriceVND": ad["price"], "PriceString": ad["price_string"],
        **{name: extract_param(ad, keys) for name, keys in AD_PARAMS.items()},
        "SellerType": first_true(ad, "account_type", "seller_type"),
        "PostDateText": ad["date"], "ListTimeRaw": listed,
        "NgayDang": epoch_to_timestamp(listed, zone), "CrawlDate": crawl_time,
        "Link": build_ad_url(ad),
    }
    rest = [c for c in ads.columns if c != "ad"]
    return ads.select(*rest, *[flat[c].alias(c) for c in S.FLAT_AD_COLUMNS])
