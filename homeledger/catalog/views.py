"""Listing views over the star-schema test tables.

Each view is one SQL text that both Spark and the checking database run, so both sides
start from the same rows. Only spelling differences and the order of joins are filled in per engine. Views read
whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "part", "orders", "lineitem", "events", "documents"]


class Engine:
    """The few spellings that differ."""

    def __init__(self, name: str):
        self.spark = name == "spark"

    def hex_long(self, e: str) -> str:
        return f"CAST(conv({e}, 16, 10) AS BIGINT)" if self.spark else f"CAST(('0x' || {e}) AS BIGINT)"

    def epoch_days(self, e: str) -> str:
        if self.spark:
            return f"CAST(datediff(CAST({e} AS DATE), DATE '1970-01-01') AS BIGINT)"
        return f"date_diff('day', DATE '1970-01-01', CAST({e} AS DATE))"


SPARK, DUCK = Engine("spark"), Engine("duck")


def pick(key: str, values: list[str | None]) -> str:
    """One of ``values`` by ``key`` modulo their number."""
    def lit(v: str | None) -> str:
        return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "''") + "'"
    whens = " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values))
    return f"CASE ({key}) % {len(values)} {whens} END"


def text(e: str) -> str:
    return f"CAST({e} AS STRING)"


# ---- typed listings, from lineitem --------------------------------------------------

def _facts(e: Engine) -> dict[str, str]:
    key = " || '-' || ".join([
        text("l_orderkey"), text("l_partkey"), text("l_suppkey"), text("l_linenumber"),
        text("CAST(round(l_extendedprice * 100) AS BIGINT)"), text("CAST(l_shipdate AS DATE)")])
    md5 = f"substr(md5({key}), 1, 14)"
    return {
        "row_id": f"{e.hex_long(md5)} * 2",
        "price": "l_extendedprice * 100000",
        "area": "CAST(12 + (l_partkey % 97) * 6 AS DOUBLE)",
        "floor_count": "CAST(CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_linenumber * 5 END AS DOUBLE)",
        "bedroom_count": "CAST(1 + l_partkey % 4 AS DOUBLE)",
        "bathroom_count": "CAST(CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE 1 + l_suppkey % 3 END AS DOUBLE)",
        "frontage_width": "CAST(NULL AS DOUBLE)",
        "house_depth": "CAST(NULL AS DOUBLE)",
        "house_direction": pick("l_partkey", [
            "Đông", "Tây", "Nam", "Bắc", "Đông Nam", "Đông Bắc", "Tây Nam", "Tây Bắc", "5", "Hướng lạ"]),
        "balcony_direction": pick("l_suppkey", ["Nam", "5.0", None, "Bắc", "nan"]),
        "published_at": "l_shipdate",
        "source": "CASE l_returnflag WHEN 'R' THEN 'huggingface' WHEN 'A' THEN 'chotot' ELSE 'mogi' END",
        "partkey": "l_partkey",
    }


_DIMS = {
    "name": "p_name", "description": "p_type || ' ' || p_brand", "property_type_name": "p_type",
    "project_name": "p_brand", "province_name": "r_name", "district_name": "n_name",
    "ward_name": "c_mktsegment", "street_name": "o_orderpriority",
    "road_width": "CAST(p_size AS DOUBLE)",
}
_JOINS = """ JOIN {part} ON l_partkey = p_partkey JOIN {orders} ON l_orderkey = o_orderkey
 JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
 JOIN {region} ON n_regionkey = r_regionkey"""
# the same joins with the places brought to the orders first: the lines, by far the most rows, move once less
_PLACED_JOINS = """ JOIN {part} ON l_partkey = p_partkey JOIN (
 SELECT o_orderkey, o_orderpriority, c_mktsegment, n_name, r_name FROM {orders} JOIN {customer} ON o_custkey = c_custkey
 JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey) AS o ON l_orderkey = o_orderkey"""


def _joins(e: Engine) -> str:
    return _PLACED_JOINS if e.spark else _JOINS


def facts_sql(e: Engine) -> str:
    """Listings without place or text, from lineitem alone."""
    cols = ", ".join(f"{v} AS {k}" for k, v in _facts(e).items())
    return f"SELECT {cols} FROM {{lineitem}}"


def listings_sql(e: Engine) -> str:
    """Typed listings with every common column."""
    cols = ", ".join(f"{v} AS {k}" for k, v in {**_facts(e), **_DIMS}.items())
    return f"SELECT {cols} FROM {{lineitem}}{_joins(e)}"


def doubled_sql(e: Engine) -> str:
    """Typed listings and, for one in twenty, a later copy described ``dup``."""
    facts = {**_facts(e), **_DIMS}
    facts["row_id"] = f"{facts['row_id']} + copy"
    facts["description"] = f"CASE copy WHEN 1 THEN 'dup' ELSE {facts['description']} END"
    cols = ", ".join(f"{v} AS {k}" for k, v in facts.items())
    lines = ("(SELECT *, 0 AS copy FROM {lineitem} UNION ALL SELECT *, 1 AS copy FROM {lineitem} "
             "WHERE (l_orderkey + l_partkey) % 20 = 0) AS l")
    return f"SELECT {cols} FROM {lines}{_joins(e)}"


def predictions_sql(e: Engine) -> str:
    """Typed listings with a predicted price a known share off."""
    inner = listings_sql(e)
    return (f"SELECT *, abs(price - predicted_price) AS absolute_error FROM ("
            f"SELECT *, price * (0.9e0 + CAST(partkey % 21 AS DOUBLE) / 100e0) AS predicted_price "
            f"FROM ({inner}) AS l) AS p")


def prediction_facts_sql(e: Engine) -> str:
    return predictions_sql(e).replace(listings_sql(e), facts_sql(e))


# ---- raw text listings, from orders -------------------------------------------------

_B = text("CAST(floor(o_totalprice / 10000) AS BIGINT)")
_M = text("CAST(floor(o_totalprice) AS BIGINT) % 1000")
_N = text("20 + o_custkey % 180")
PROVINCES = ["TPHCM", "TP.HCM", " Tp  Hồ Chí Minh", "Hà Nội", None, "HCM", "Hồ Chí Minh cũ",
             "TP. Hồ Chí Minh", "", "Hồ Chí Minh"]
DISTRICTS = ["Q.1", "Q 7", "Quận 2 (TP. Thủ Đức)", "TP. Thủ Đức", "TP Thủ Đức", "Quận", "Huyện Nhà Bè",
             "Quận Huyện X", "  Bình   Thạnh ", None, "Thị xã Dĩ An", "Quận 2 (TP. Thủ Đức) cũ"]
WARDS = ["Phường 22", "Xã Tân Kiên", "Thị trấn Hóc Môn (cũ)", "Bến Nghé", "", None, "Phường Xã Y"]
DIRECTIONS = ["5", "5.0", "Đông Nam", " Tây ", "Hướng lạ", "nan", None, "Bắc"]
ADDRESSES = ["12 Lê Lợi, Phường 3, Quận Bình Thạnh, TP HCM", "quận 7 TP.HCM", "Hà Nội", None,
             "Q. 10, Huyện Củ Chi", "1 Kha Vạn Cân, TP. Thủ Đức", "huyện  Nhà Bè. Quận 4"]
KINDS = ["Căn hộ chung cư", " Căn hộ  chung cư ", "Nhà phố", "Căn hộ chung cư", "nan"]

_RAW = {
    "row_id": "o_orderkey",
    "name": f"'  Căn hộ   ' || {text('o_custkey')} || ' '",
    "description": pick("o_orderkey", ["a  b", None, "", "  ", "nan", "tầng  cao"]),
    "property_type_name": pick("o_orderkey", KINDS),
    "province_name": pick("o_orderkey + o_custkey", PROVINCES),
    "district_name": pick("o_custkey", DISTRICTS),
    "ward_name": pick("o_custkey", WARDS),
    "street_name": "o_orderpriority",
    "address": pick("o_custkey", ADDRESSES),
    "house_direction": pick("o_custkey", DIRECTIONS),
    "price": (
        f"CASE o_orderkey % 15 WHEN 0 THEN {_B} || ' tỷ ' || {_M} || ' triệu' "
        f"WHEN 1 THEN {_B} || ',' || {_M} || ' tỷ' WHEN 2 THEN {_B} || '.' || {_M} || 'tỷ' "
        f"WHEN 3 THEN {_M} || ' triệu' WHEN 4 THEN {_B} || ' TỶ' WHEN 5 THEN {_B} || ' tỉ' "
        f"WHEN 6 THEN {_B} || ' ty' WHEN 7 THEN {text('CAST(floor(o_totalprice) AS BIGINT) * 1000')} "
        f"WHEN 8 THEN {_B} || ' tỷ- 62 m2đ' WHEN 9 THEN 'Thỏa thuận' WHEN 10 THEN '' WHEN 11 THEN NULL "
        f"WHEN 12 THEN {_M} || ' trieu VNĐ' WHEN 13 THEN '1.234,5 tỷ' ELSE '-' || {_B} END"),
    "area": (
        f"CASE o_orderkey % 7 WHEN 0 THEN {_N} || ' m²' WHEN 1 THEN {_N} || ',5 m2' WHEN 2 THEN '1.250 m2' "
        f"WHEN 3 THEN {_N} WHEN 4 THEN '2 PN ' || {_N} || 'm2' WHEN 5 THEN 'khoảng' ELSE '0' END"),
    "floor_count": pick("o_orderkey", ["5", "1e1", " 7 ", "1d", "1_000", "1,5", None, "-3.5", ".5"]),
    "bedroom_count": pick("o_custkey", ["1", "2", "3", "x"]),
    "published_at": (
        f"CASE o_orderkey % 3 WHEN 2 THEN {text('day(o_orderdate)')} || '/' || {text('month(o_orderdate)')} "
        f"|| '/' || {text('year(o_orderdate)')} WHEN 1 THEN {text('CAST(o_orderdate AS DATE)')} || ' 10:20:30' "
        f"ELSE CASE WHEN o_orderkey % 30 = 0 THEN 'Hôm nay' ELSE {text('CAST(o_orderdate AS DATE)')} END END"),
    "source": "CASE o_orderkey % 3 WHEN 0 THEN 'huggingface' WHEN 1 THEN 'chotot' ELSE 'mogi' END",
    "posted": "o_orderdate",
    "total": "o_totalprice",
    "custkey": "o_custkey",
    "link": f"'https://example.org/' || {text('o_orderkey')}",
}


def raw_sql(e: Engine) -> str:
    """Listings as text: money, area, dates and places in many spellings."""
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in _RAW.items()) + " FROM {orders}"


# ---- ad pages, from orders ----------------------------------------------------------

def _ad_text(e: Engine) -> str:
    key, cust = text("o_orderkey"), text("o_custkey")
    secs = f"({e.epoch_days('o_orderdate')} * 86400 + o_orderkey % 86400)"
    stamp = f"CASE o_orderkey % 2 WHEN 0 THEN {text(secs)} ELSE {text(secs + ' * 1000 + 123')} END"
    size = text("30 + o_custkey % 90")
    details = (
        f"CASE o_orderkey % 3 WHEN 0 THEN '\"ad_params\":[\"x\",7,null,[1],{{{{\"id\":\"other\",\"value\":1}}}},"
        f"{{{{\"id\":\"Size\",\"value\":' || {size} || '}}}},{{{{\"id\":\"size\",\"value\":999}}}}]' "
        f"WHEN 1 THEN '\"size\":' || {size} || ',\"rooms\":0,\"area\":\"Quận 3\"' "
        f"ELSE '\"parameters\":[{{{{\"key\":\"rooms\",\"value\":false,\"value_name\":\"2 phòng\"}}}},"
        f"{{{{\"label\":\"direction\",\"value\":\"\"}}}}],\"params\":[{{{{\"name\":\"floor\",\"value\":\"7\"}}}}],"
        f"\"area\":' || {size} END")
    links = (
        f"CASE o_orderkey % 4 WHEN 0 THEN '\"url\":\"http://u/' || {key} || '\"' "
        f"WHEN 1 THEN '\"ad_link\":\"ftp://x\",\"webp_image\":\"https://w/' || {key} || '\",\"url\":\"http://u\"' "
        f"WHEN 2 THEN '\"url\":null' ELSE '\"ad_link\":\"\"' END")
    when = f"CASE WHEN o_orderkey % 5 = 0 THEN '\"list_time\":0,\"created_at\":' ELSE '\"list_time\":' END || {stamp}"
    return (
        f"'{{{{\"ad_id\":' || {key} || ',\"list_id\":' || {text('o_orderkey * 10')} || ',\"subject\":\"Căn hộ ' || "
        f"{cust} || '\",\"address\":\"' || o_orderpriority || '\",\"ward\":\"P. ' || {text('o_custkey % 20')} || "
        f"'\",\"ward_name\":\"\",\"area_name\":false,\"account_type\":{{{{}}}},\"seller_type\":false,\"region_name\":\"TPHCM\",\"price\":' || "
        f"{text('CAST(floor(o_totalprice) AS BIGINT) * 10000')} || ',\"price_string\":\"x đ\",\"date\":\"hôm qua\",' || "
        f"{details} || ',' || {links} || ',' || {when} || '}}}}'")


def pages_sql(e: Engine) -> str:
    """One captured page document per order, in the shapes the scan must tell apart."""
    ad = _ad_text(e)
    return (
        "SELECT o_orderkey AS page_id, "
        f"CASE o_orderkey % 4 WHEN 0 THEN '{{{{\"ads\":[' || {ad} || '],\"data\":[]}}}}' "
        f"WHEN 1 THEN '{{{{\"ads\":[],\"data\":[' || {ad} || ',\"junk\",5,null]}}}}' "
        f"WHEN 2 THEN '{{{{\"data\":[' || {ad} || ']}}}}' ELSE '{{{{\"ads\":[]}}}}' END AS page FROM {{orders}}")


# ---- scoring requests, from orders --------------------------------------------------

def requests_sql(e: Engine) -> str:
    """Form submissions, all text, with blanks, bad numbers and impossible dates."""
    fields = {
        "row_id": "o_orderkey",
        "area": pick("o_orderkey", ["70", " 55.5 ", "", "abc", None, "1e2", "1_20"]),
        "floor_count": pick("o_custkey", ["15", "", "12"]),
        "frontage_width": "''", "house_depth": "''", "road_width": pick("o_custkey", ["", "4.5"]),
        "bedrooms": text("1 + o_orderkey % 4"), "bathrooms": pick("o_custkey", ["2", "1", None]),
        "property_type": pick("o_orderkey", KINDS), "province": pick("o_orderkey + o_custkey", PROVINCES),
        "district": pick("o_custkey", DISTRICTS), "ward": pick("o_custkey", WARDS),
        "street": pick("o_custkey", ["", "  Lê   Lợi "]), "project_name": pick("o_custkey", ["The Marq", ""]),
        "house_direction": pick("o_custkey", DIRECTIONS),
        "balcony_direction": pick("o_orderkey", DIRECTIONS),
        "published_year": text("year(o_orderdate)"),
        "published_month": pick("o_orderkey", ["2", "5", "", "13", "11"]),
        "published_day": pick("o_custkey", ["30", "1", "x", "25"]),
    }
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in fields.items()) + " FROM {orders}"


# ---- running them -------------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, make: Callable[[Engine], str]) -> DataFrame:
    sql = make(SPARK)
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def cte(make: Callable[[Engine], str]) -> str:
    """The same view as SQL text for the checking database."""
    sql = make(DUCK)
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql.replace("{{", "{").replace("}}", "}")
