"""Scalar rules over whole columns of the raw listings, documents and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeledger.catalog import duck as D, inputs as I, views as V
from homeledger.catalog.registry import query
from homeledger.functions import dates, numbers, sql as sqlf, text
from homeledger.operators import scoring
from homeledger.sources import ads

RAW = V.cte(V.raw_sql)
ADS = V.cte(V.pages_sql)


def _on_raw(name, column, rule, step, extra=()):
    """One rule over a raw column: (row_id, given, result)."""
    base = f"SELECT row_id, {column} AS given, {column} AS result FROM ({RAW})"
    out = step(base, "result")

    @query(name, f"SELECT row_id, given, result FROM ({out})")
    def run(spark, sf):
        df = I.raw(spark, sf)
        return df.select("row_id", F.col(column).alias("given"), rule(F.col(column)).alias("result"))


def _put(expr):
    return lambda sql, c: D.put(sql, c, expr(c))


_on_raw("normalize_province", "province_name", text.normalize_province, D.province)
_on_raw("normalize_province_merge", "province_name", lambda c: text.normalize_province(c, "merge"),
        lambda s, c: D.province(s, c, "merge"))
_on_raw("normalize_province_web", "province_name", lambda c: text.normalize_province(c, "web"),
        lambda s, c: D.province(s, c, "web"))
_on_raw("lookup_province", "province_name",
        lambda c: text.lookup(text.clean_text(c), {"Hà Nội": "HN", "HCM": "Hồ Chí Minh"}),
        lambda s, c: D.put(D.put(s, c, D.clean(c)), c,
                           f"CASE {c} WHEN 'Hà Nội' THEN 'HN' WHEN 'HCM' THEN 'Hồ Chí Minh' ELSE {c} END"))
_on_raw("normalize_district", "district_name", text.normalize_district, D.district)
_on_raw("normalize_district_merge", "district_name", lambda c: text.normalize_district(c, "merge"),
        lambda s, c: D.district(s, c, "merge"))
_on_raw("normalize_ward", "ward_name", text.normalize_ward, D.ward)
_on_raw("normalize_ward_merge", "ward_name", lambda c: text.normalize_ward(c, "merge"),
        lambda s, c: D.ward(s, c, "merge"))
_on_raw("normalize_direction", "house_direction", text.normalize_direction, D.direction)
_on_raw("normalize_direction_merge", "house_direction", lambda c: text.normalize_direction(c, "merge"),
        lambda s, c: D.direction(s, c, "merge"))
_on_raw("fill_category", "description", text.fill_category,
        _put(lambda c: f"CASE WHEN {c} IS NULL OR {D.strip(c)} IN ('', 'nan') THEN 'Unknown' ELSE {D.strip(c)} END"))
_on_raw("filter_text", "description", text.filter_text, _put(lambda c: f"coalesce({D.strip(c)}, '')"))
_on_raw("try_number", "floor_count", numbers.try_number, D.number)
_on_raw("parse_number_vn", "area", numbers.parse_number_vn, lambda s, c: D.put(D.put(
    s, c, f"regexp_replace({c}, '[^0-9,.]', '', 'g')"), c,
    f"try_cast(CASE WHEN contains({c}, ',') THEN replace(replace({c}, '.', ''), ',', '.') ELSE {c} END AS DOUBLE)"))
_on_raw("parse_price_vnd", "price", numbers.parse_price_vnd, D.price)
_on_raw("parse_price_legacy", "price", numbers.parse_price_legacy, D.price_legacy)
_on_raw("parse_float_vn", "area", numbers.parse_float_vn, D.float_vn)
_on_raw("parse_area_m2", "area", numbers.parse_area_m2, D.area)
_on_raw("extract_district", "address", text.extract_district, lambda s, c: D.put(D.put(s, c, D.squeeze(c)), c, (
    "CASE " + " ".join(
        f"WHEN regexp_matches({c}, '(?i){p}') THEN trim(regexp_extract({c}, '(?i){p}', 1))"
        for p in D.DISTRICT_IN_ADDRESS) + " END")))
_on_raw("parse_or_default", "floor_count", lambda c: numbers.parse_or_default(c, "int", 7), lambda s, c: D.put(D.put(
    s, c, f"replace({D.strip(c)}, '_', '')"), c,
    f"CASE WHEN regexp_full_match({c}, '[+-]?\\d+') THEN CAST({c} AS INTEGER) ELSE 7 END"))


@query("clean_text", f"SELECT doc_id, {D.clean('text')} AS result FROM documents")
def clean_text(spark, sf):
    return I.documents(spark, sf).select("doc_id", text.clean_text(F.col("text")).alias("result"))


@query("normalize_text", f"SELECT doc_id, {D.squeeze('text')} AS result FROM documents")
def normalize_text(spark, sf):
    return I.documents(spark, sf).select("doc_id", text.normalize_text(F.col("text")).alias("result"))


@query("strip_accents", "SELECT doc_id, strip_accents(text) AS result FROM documents")
def strip_accents(spark, sf):
    return I.documents(spark, sf).select("doc_id", text.strip_accents(F.col("text")).alias("result"))


@query("parse_published_at", "SELECT row_id, given, published_at FROM (" + D.when(
    f"SELECT row_id, published_at AS given, published_at FROM ({RAW})", "published_at") + ")")
def parse_published_at(spark, sf):
    c = F.col("published_at")
    parsed = F.when(F.col("source") == "mogi", dates.parse_published_at(c, day_first=True)) \
        .otherwise(dates.parse_published_at(c))
    return I.raw(spark, sf).select("row_id", c.alias("given"), parsed.alias("published_at"))


@query("date_parts", f"SELECT row_id, {D.PARTS} FROM ({V.cte(V.facts_sql)})")
def date_parts(spark, sf):
    df = I.facts(spark, sf)
    return df.select("row_id", *[c.alias(n) for n, c in dates.date_parts(F.col("published_at")).items()])


@query("epoch_to_timestamp", "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + to_seconds(o_orderkey % 86400), "
       "'%Y-%m-%d %H:%M:%S') AS utc_time, strftime(CAST(o_orderdate AS DATE) + to_seconds(o_orderkey % 86400 + 25200), "
       "'%Y-%m-%d %H:%M:%S') AS local_time FROM orders")
def epoch_to_timestamp(spark, sf):
    orders = V.table(spark, sf, "orders")
    days = F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = days * 86400 + F.col("o_orderkey") % 86400
    stamp = F.when(F.col("o_orderkey") % 2 == 0, seconds.cast("string")).otherwise((seconds * 1000 + 123).cast("string"))
    return orders.select("o_orderkey", dates.epoch_to_timestamp(stamp, "UTC").alias("utc_time"),
                         dates.epoch_to_timestamp(stamp, "Asia/Ho_Chi_Minh").alias("local_time"))


@query("month_label", "SELECT event_id, strftime(ts, '%Y-%m') AS month FROM events")
def month_label(spark, sf):
    return V.table(spark, sf, "events").select("event_id", dates.month_label(F.col("ts")).alias("month"))


@query("day_label", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def day_label(spark, sf):
    return V.table(spark, sf, "events").select("event_id", dates.day_label(F.col("ts")).alias("day"))


@query("end_of_day_bound", "SELECT event_id, ts FROM events WHERE ts <= TIMESTAMP '2024-01-10 23:59:59'")
def end_of_day_bound(spark, sf):
    events = V.table(spark, sf, "events")
    return events.where(F.col("ts") <= dates.end_of_day("2024-01-10")).select("event_id", "ts")


def _from_ads(name, columns):
    @query(name, f"SELECT page_id, {', '.join(columns)} FROM ({D.flat_ads()})")
    def run(spark, sf):
        ad = F.col("ad")
        made = {
            **{n: ads.extract_param(ad, keys) for n, keys in ads.AD_PARAMS.items()},
            "Link": ads.build_ad_url(ad),
            "Ward": ads.first_true(ad, "ward_name", "ward"),
            "District": ads.first_true(ad, "area_name", "area"),
            "ListTimeRaw": ads.first_true(ad, "list_time", "date_timestamp", "created_at"),
        }
        return I.ad_objects(spark, sf).select("page_id", *[made[c].alias(c) for c in columns])


_from_ads("extract_param", list(ads.AD_PARAMS))
_from_ads("build_ad_url", ["Link"])
_from_ads("truthy_coalesce", ["Ward", "District", "ListTimeRaw"])


@query("log_target", f"SELECT row_id, round(ln(1 + price), 9) AS log_price, round(exp(ln(1 + price)) - 1, 0) AS price_back, "
       f"round(exp(-area) - 1, 9) AS unfloored, 0.0::DOUBLE AS floored FROM ({V.cte(V.facts_sql)})")
def log_target(spark, sf):
    logged = numbers.log_target(F.col("price"))
    return I.facts(spark, sf).select(
        "row_id", F.round(logged, 9).alias("log_price"), F.round(numbers.price_of_log(logged), 0).alias("price_back"),
        F.round(numbers.price_of_log(-F.col("area"), floor=False), 9).alias("unfloored"),
        numbers.price_of_log(-F.col("area")).alias("floored"))


@query("abs_error", "SELECT row_id, round(abs(price - predicted_price), 2) AS absolute_error, "
       "round(abs(price - predicted_price) / 1e9, 9) AS absolute_error_billion "
       f"FROM ({V.cte(V.prediction_facts_sql)})")
def abs_error(spark, sf):
    err = numbers.abs_error(F.col("price"), F.col("predicted_price"))
    return I.predictions(spark, sf).select(
        "row_id", F.round(err, 2).alias("absolute_error"),
        F.round(err / numbers.BILLION, 9).alias("absolute_error_billion"))


@query("format_money", "SELECT row_id, format('{:,.0f} VND', price) AS vnd, printf('%.3f tỷ VNĐ', price / 1e9) AS billion "
       f"FROM (SELECT row_id, round(price) AS price FROM ({V.cte(V.facts_sql)}))")
def format_money(spark, sf):
    df = I.facts(spark, sf).withColumn("price", F.round("price"))
    return df.select("row_id", numbers.format_vnd(F.col("price")).alias("vnd"),
                     numbers.format_billion(F.col("price")).alias("billion"))


@query("prediction_band", "SELECT row_id, round(greatest(predicted_price - mae, 0), 2) AS lower, "
       "round(predicted_price + mae, 2) AS upper FROM (SELECT row_id, predicted_price, "
       f"CASE WHEN area < 100 THEN NULL ELSE area * 1e7 END AS mae FROM ({V.cte(V.prediction_facts_sql)}))"
       .replace("greatest(predicted_price - mae, 0)",
                "CASE WHEN mae IS NOT NULL THEN greatest(predicted_price - mae, 0) END"))
def prediction_band(spark, sf):
    mae = F.when(~(F.col("area") < 100), F.col("area") * 1e7)
    df = scoring.band_columns(I.predictions(spark, sf), mae)
    return df.select("row_id", F.round("lower", 2).alias("lower"), F.round("upper", 2).alias("upper"))


def _request_sql(cli: bool = False) -> str:
    sql = V.cte(V.requests_sql)

    def num(c, kind="DOUBLE", default="NULL"):
        t = f"replace({D.strip(c)}, '_', '')"
        shape = D.FLOAT if kind == "DOUBLE" else r"[+-]?\d+"
        return f"coalesce(CASE WHEN regexp_full_match({t}, '{shape}') THEN try_cast({t} AS {kind}) END, {default})"

    sql = D.add(sql, **{f"n_{n}": num(n) for n in scoring.NUMBER_FIELDS},
                posted_year=num("published_year", "INTEGER", "2026"),
                posted_month=num("published_month", "INTEGER", "5"),
                posted_day=num("published_day", "INTEGER", "1"))
    day = "try_cast(printf('%04d-%02d-%02d', posted_year, posted_month, posted_day) AS DATE)"
    sql = D.add(sql, posted_dayofweek="CAST(0 AS INTEGER)" if cli else f"CAST(coalesce(isodow({day}) - 1, 0) AS INTEGER)")
    for c, default in scoring.TEXT_DEFAULTS.items():
        sql = D.put(sql, c, f"coalesce({c}, {D.q(default)})")
    if not cli:
        for c in ("property_type", "street", "project_name"):
            sql = D.put(sql, c, D.clean(c))
        sql = D.ward(D.district(D.province(sql, "province", "web"), "district", "web"), "ward", "web")
        sql = D.direction(D.direction(sql, "house_direction"), "balcony_direction")
    names = [f"n_{n} AS {f}" for n, f in scoring.NUMBER_FIELDS.items()] + [
        "posted_year", "posted_month", "posted_day", "posted_dayofweek"] + [
        f"{n} AS {f}" if n != f else n for n, f in scoring.TEXT_FIELDS.items()]
    return f"SELECT row_id, {', '.join(names)} FROM ({sql})"


@query("request_features", _request_sql())
def request_features(spark, sf):
    return scoring.request_features(I.requests(spark, sf))


@query("request_features_cli", _request_sql(cli=True))
def request_features_cli(spark, sf):
    return scoring.request_features(I.requests(spark, sf), "cli")


_PRICE = D.price(f"SELECT row_id, price, area, province_name, district_name, ward_name, house_direction, description FROM ({RAW})", "price")
_SQL = D.put(D.direction(D.ward(D.district(D.province(D.area(_PRICE, "area"), "province_name"), "district_name"), "ward_name"),
             "house_direction"), "description", D.clean("description"))


@query("sql_functions", f"SELECT row_id, price, area, province_name, district_name, ward_name, house_direction, description FROM ({_SQL})")
def sql_functions(spark, sf):
    sqlf.register_sql_functions(spark)
    return I.raw(spark, sf).selectExpr(
        "row_id", "parse_price_vnd(price) AS price", "parse_area_m2(area) AS area",
        "normalize_province(province_name) AS province_name", "normalize_district(district_name) AS district_name",
        "normalize_ward(ward_name) AS ward_name", "normalize_direction(house_direction) AS house_direction",
        "clean_text(description) AS description")
