"""Building blocks for the checking SQL, written from the rules, one step per SELECT."""

from __future__ import annotations

from homeledger import schema as S
from homeledger.catalog import views as V

WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
FLOAT = r"(?i)[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|[+-]?inf(inity)?"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words(values: list[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


# --- fixed values, written out a second time: a wrong one in the library must not pass here ---
_CITY = ["Tp Hồ Chí Minh", "TP Hồ Chí Minh", "TP. Hồ Chí Minh", "Thành phố Hồ Chí Minh", "TP.HCM", "HCM"]
CITY = {"fixed": [*_CITY, "TPHCM", "Hồ Chí Minh cũ"], "merge": _CITY, "web": _CITY}
DISTRICT_SPELLINGS = [("Q.", "Quận "), ("Q ", "Quận "), ("Tp.", "Thành phố "), ("TP.", "Thành phố ")]
DISTRICT_WORDS = ["Quận ", "Huyện ", "Thành phố ", "Thị xã "]
WARD_WORDS = ["Phường ", "Xã ", "Thị trấn "]
DIRECTIONS = ["Đông", "Tây", "Nam", "Bắc", "Đông Nam", "Đông Bắc", "Tây Nam", "Tây Bắc"]
DISTRICT_IN_ADDRESS = [r"(Quận\s+[\p{L}\p{N}_À-ỹ\s]+)", r"(Q\.\s*\d+)", r"(Huyện\s+[\p{L}\p{N}_À-ỹ\s]+)",
                       r"(Thành phố\s+Thủ Đức)", r"(TP\.\s*Thủ Đức)"]
MONEY_SPELLINGS = [("tỉ", "tỷ"), ("ty", "tỷ"), ("tri\u00ea\u0323u", "tri\u1ec7u"), ("trieu", "tri\u1ec7u"),
                   ("vnd", ""), ("vnđ", ""), ("đ", "")]
OLD_UNITS = ["m²", "m2", "triệu", "trieu", "tỷ", "ty"]
# --- end of fixed values ---


def put(sql: str, column: str, expr: str) -> str:
    """Replace a column by an expression over it."""
    return f"SELECT * REPLACE ({expr} AS {column}) FROM ({sql})"


def add(sql: str, **exprs: str) -> str:
    return f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in exprs.items())} FROM ({sql})"


def squeeze(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, '{WS}+', ' ', 'g')), '')"


def clean(x: str) -> str:
    return f"coalesce({squeeze(x)}, 'Unknown')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def province(sql: str, c: str, variant: str = "fixed") -> str:
    sql = put(sql, c, clean(c))
    if variant == "merge":
        sql = put(sql, c, f"replace({c}, 'TP.', 'TP')")
    return put(sql, c, f"CASE WHEN {c} IN {words(CITY[variant])} THEN {q(S.HCMC)} ELSE {c} END")


def _prefixed(sql: str, c: str, prefixes: list[str]) -> str:
    for p in prefixes:
        sql = put(sql, c, f"CASE WHEN starts_with({c}, {q(p)}) THEN trim(substr({c}, {len(p) + 1})) ELSE {c} END")
    return put(sql, c, f"CASE WHEN {c} = '' THEN 'Unknown' ELSE {c} END")


def _unbracketed(sql: str, c: str) -> str:
    return put(sql, c, rf"trim(regexp_replace({c}, '\s*\(.*?\)\s*', '', 'g'))")


def district(sql: str, c: str, variant: str = "fixed") -> str:
    sql = put(sql, c, clean(c))
    if variant == "fixed":
        sql = _unbracketed(sql, c)
    for old, new in DISTRICT_SPELLINGS:
        sql = put(sql, c, f"replace({c}, {q(old)}, {q(new)})")
    return _prefixed(sql, c, DISTRICT_WORDS)


def ward(sql: str, c: str, variant: str = "fixed") -> str:
    sql = put(sql, c, clean(c))
    if variant == "fixed":
        sql = _unbracketed(sql, c)
    return _prefixed(sql, c, WARD_WORDS)


def direction(sql: str, c: str, variant: str = "fixed") -> str:
    sql = put(sql, c, clean(c))
    if variant == "merge":
        return put(sql, c, rf"CASE WHEN regexp_full_match({c}, '\d+(\.0)?') OR lower({c}) IN ('nan', 'none') "
                           f"THEN 'Unknown' ELSE {c} END")
    return put(sql, c, f"CASE WHEN {c} IN {words(DIRECTIONS)} THEN {c} ELSE 'Unknown' END")


def number(sql: str, c: str) -> str:
    """Strictly numeric text to double."""
    sql = put(sql, c, strip(c))
    return put(sql, c, f"CASE WHEN regexp_full_match({c}, '{FLOAT}') THEN try_cast({c} AS DOUBLE) END")


def _one_number(x: str) -> str:
    return f"try_cast(replace(nullif({x}, ''), ',', '.') AS DOUBLE)"


def price(sql: str, c: str) -> str:
    """Compound money text to VND."""
    sql = put(sql, c, f"lower({c})")
    for old, new in MONEY_SPELLINGS:
        sql = put(sql, c, f"replace({c}, {q(old)}, {q(new)})")
    shape = r"(\d+(?:[,.]\d+)?)"
    bn, ml = rf"(?s){shape}\s*tỷ(.*)$", rf"{shape}\s*triệu"
    sql = add(sql, bn=_one_number(f"regexp_extract({c}, '{bn}', 1)"), tail=f"regexp_extract({c}, '{bn}', 2)",
              ml=_one_number(f"regexp_extract({c}, '{ml}', 1)"), bare=_one_number(f"regexp_extract({c}, '{shape}', 1)"))
    sql = add(sql, tail_ml=_one_number(f"regexp_extract(tail, '{ml}', 1)"))
    value = ("CASE WHEN bn IS NOT NULL THEN nullif(bn * 1e9 + coalesce(tail_ml * 1e6, 0), 0) "
             "WHEN ml IS NOT NULL THEN ml * 1e6 WHEN bare >= 1e8 THEN bare WHEN bare < 1000 THEN bare * 1e9 END")
    return f"SELECT * EXCLUDE (bn, tail, ml, bare, tail_ml) FROM ({put(sql, c, value)})"


def area(sql: str, c: str) -> str:
    sql = put(sql, c, f"replace(replace(replace(lower({c}), 'm²', ''), 'm2', ''), '㎡', '')")
    return put(sql, c, _one_number(rf"regexp_extract({c}, '\d+(?:[,.]\d+)?')"))


def float_vn(sql: str, c: str) -> str:
    sql = put(sql, c, f"lower({c})")
    for unit in OLD_UNITS:
        sql = put(sql, c, f"replace({c}, {q(unit)}, '')")
    sql = put(sql, c, rf"nullif(regexp_extract(replace({c}, '/', ' '), '[-+]?\d[\d.,]*'), '')")
    sql = put(sql, c, f"CASE WHEN contains({c}, ',') THEN replace(replace({c}, '.', ''), ',', '.') ELSE {c} END")
    return put(sql, c, f"try_cast({c} AS DOUBLE)")


def price_legacy(sql: str, c: str) -> str:
    sql = put(sql, c, f"replace(replace(split_part({strip(f'lower({c})')}, '-', 1), 'đ', ''), 'vnd', '')")
    sql = float_vn(add(sql, plain=f"strip_accents({c})"), c)
    value = (f"CASE WHEN contains(plain, 'ty') THEN {c} * 1e9 WHEN contains(plain, 'trieu') THEN {c} * 1e6 "
             f"WHEN {c} < 1000 THEN {c} * 1e9 ELSE {c} END")
    return f"SELECT * EXCLUDE (plain) FROM ({put(sql, c, value)})"


def when(sql: str, c: str) -> str:
    """Day-first slashes or year-first text to timestamp."""
    return put(sql, c, rf"CASE WHEN regexp_full_match({c}, '\d+/\d+/\d{{4}}') THEN strptime({c}, '%d/%m/%Y') "
                       f"ELSE try_cast({c} AS TIMESTAMP) END")


def raw_standard(variant: str = "fixed") -> str:
    """The raw listings, standardised."""
    sql = f"SELECT * FROM ({V.cte(V.raw_sql)})"
    for c in ("frontage_width", "house_depth", "road_width", "bathroom_count"):
        sql = add(sql, **{c: "CAST(NULL AS DOUBLE)"})
    sql = add(sql, project_name="'Unknown'", balcony_direction="'Unknown'")
    for c in ("name", "description", "property_type_name", "street_name"):
        sql = put(sql, c, clean(c))
    sql = direction(ward(district(province(
        sql, "province_name", variant), "district_name", variant), "ward_name", variant), "house_direction", variant)
    for c in ("floor_count", "bedroom_count"):
        sql = number(sql, c)
    if variant == "fixed":
        sql = area(price(sql, "price"), "area")
    else:
        sql = number(number(sql, "price"), "area")
    return f"SELECT {', '.join(S.COMMON_COLUMNS)}, row_id FROM ({when(sql, 'published_at')})"


def raw_mogi() -> str:
    """The raw listings as the ragged source lands them, standardised as that source."""
    sql = f"SELECT * FROM ({V.cte(V.raw_sql)})"
    sql = put(sql, "source", "'mogi'")
    for c in ("frontage_width", "house_depth", "road_width"):
        sql = add(sql, **{c: "CAST(NULL AS DOUBLE)"})
    sql = add(put(sql, "floor_count", "CAST(NULL AS DOUBLE)"), bathroom_count="2.0::DOUBLE",
              project_name="'Unknown'", balcony_direction="'Unknown'")
    sql = put(sql, "house_direction", "'Unknown'")
    for c in ("name", "property_type_name", "street_name"):
        sql = put(sql, c, clean(c))
    sql = ward(district(province(sql, "province_name"), "district_name"), "ward_name")
    return when(area(price(number(sql, "bedroom_count"), "price"), "area"), "published_at")


def typed_standard(view: str, variant: str = "fixed") -> str:
    """Typed listings, standardised: only directions and the sign of money change."""
    sql = f"SELECT * FROM ({view})"
    for c in S.DIRECTION_COLUMNS:
        sql = direction(sql, c, variant)
    return f"SELECT {', '.join(S.COMMON_COLUMNS)}, row_id FROM ({sql})"


KEEP = ("price BETWEEN 1e8 AND 1e11 AND area BETWEEN 10 AND 500 AND published_at IS NOT NULL "
        "AND price / area BETWEEN 5e6 AND 1e9")
PARTS = ("CAST(year(published_at) AS INTEGER) AS posted_year, CAST(month(published_at) AS INTEGER) AS posted_month, "
         "CAST(day(published_at) AS INTEGER) AS posted_day, "
         "CAST(isodow(published_at) - 1 AS INTEGER) AS posted_dayofweek")


def cleaned(sql: str) -> str:
    return f"SELECT *, price / area AS price_per_m2, {PARTS} FROM ({sql}) WHERE {KEEP}"


def first_of(sql: str, keys: list[str], order: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {order}) AS rn FROM ({sql})) WHERE rn = 1")


SOURCE_RANK = "CASE source WHEN 'huggingface' THEN 0 WHEN 'chotot' THEN 1 WHEN 'mogi' THEN 2 ELSE 3 END"
LISTING_ORDER = f"published_at, {SOURCE_RANK}, row_id"


def flat_ads() -> str:
    """The 25 flat columns straight from the orders that the ad documents describe."""
    k = "o_orderkey"
    size = "CAST(30 + o_custkey % 90 AS VARCHAR)"
    secs = f"(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400 + {k} % 86400)"
    none = "CAST(NULL AS VARCHAR)"
    cols = {
        "AdId": f"CAST({k} AS VARCHAR)", "ListId": f"CAST({k} * 10 AS VARCHAR)",
        "Subject": "'Căn hộ ' || CAST(o_custkey AS VARCHAR)", "Address": "o_orderpriority",
        "Ward": "'P. ' || CAST(o_custkey % 20 AS VARCHAR)",
        "District": f"CASE {k} % 3 WHEN 1 THEN 'Quận 3' WHEN 2 THEN {size} END", "Region": "'TPHCM'",
        "PriceVND": "CAST(CAST(floor(o_totalprice) AS BIGINT) * 10000 AS VARCHAR)", "PriceString": "'x đ'",
        "AreaM2": size, "BedRooms": f"CASE {k} % 3 WHEN 1 THEN '0' WHEN 2 THEN '2 phòng' END",
        "BathRooms": none, "Floor": f"CASE {k} % 3 WHEN 2 THEN '7' END", "PropertyStatus": none, "Type": none,
        "LegalStatus": none, "Interior": none,
        "MainDirection": f"CASE {k} % 3 WHEN 2 THEN 'direction' END", "BalconyDirection": none,
        "SellerType": none, "PostDateText": "'hôm qua'",
        "ListTimeRaw": f"CASE {k} % 2 WHEN 0 THEN CAST({secs} AS VARCHAR) ELSE CAST({secs} * 1000 + 123 AS VARCHAR) END",
        "NgayDang": f"strftime(CAST(o_orderdate AS DATE) + to_seconds({k} % 86400), '%Y-%m-%d %H:%M:%S')",
        "CrawlDate": "'2026-05-31 00:00:00'",
        "Link": f"CASE {k} % 4 WHEN 0 THEN 'http://u/' || CAST({k} AS VARCHAR) "
                f"WHEN 1 THEN 'https://w/' || CAST({k} AS VARCHAR) "
                f"ELSE 'https://www.chotot.com/' || CAST({k} * 10 AS VARCHAR) || '.htm' END",
    }
    assert list(cols) == S.FLAT_AD_COLUMNS
    return f"SELECT {k} AS page_id, {', '.join(f'{v} AS {n}' for n, v in cols.items())} FROM orders WHERE {k} % 4 <> 3"


def ads_standard() -> str:
    """The flat ads as common listings."""
    sql = (f"SELECT Subject AS name, Subject AS description, {q(S.APARTMENT)} AS property_type_name, "
           f"{q(S.HCMC)} AS province_name, coalesce(District, 'Unknown') AS district_name, Ward AS ward_name, "
           "Address AS street_name, 'Unknown' AS project_name, CAST(PriceVND AS DOUBLE) AS price, "
           "CAST(AreaM2 AS DOUBLE) AS area, CAST(Floor AS DOUBLE) AS floor_count, "
           "CAST(NULL AS DOUBLE) AS frontage_width, CAST(NULL AS DOUBLE) AS house_depth, "
           "CAST(NULL AS DOUBLE) AS road_width, try_cast(BedRooms AS DOUBLE) AS bedroom_count, "
           "CAST(NULL AS DOUBLE) AS bathroom_count, 'Unknown' AS house_direction, 'Unknown' AS balcony_direction, "
           "CAST(NgayDang AS TIMESTAMP) AS published_at, 'chotot' AS source, AdId AS source_ad_id, "
           f"ListId AS source_list_id, Link AS source_link FROM ({flat_ads()})")
    sql = f"SELECT * REPLACE (CASE WHEN price > 0 THEN price END AS price) FROM ({sql})"
    return _prefixed(sql, "district_name", DISTRICT_WORDS)
