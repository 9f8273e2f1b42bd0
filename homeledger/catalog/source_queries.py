"""Scans, sinks and column mapping. Files are derived from the tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeledger import schema as S
from homeledger.catalog import duck as D, inputs as I, views as V
from homeledger.catalog.registry import query
from homeledger.operators import cleaning, coverage, dedupe, metrics, models, selection, splits, standardize as std
from homeledger.plans import runs
from homeledger.session import scratch_path
from homeledger.sources import ads, listings, outputs

RAW = V.cte(V.raw_sql)
FACTS = V.cte(V.facts_sql)
LISTINGS = V.cte(V.listings_sql)
PRED = V.cte(V.predictions_sql)
PRED_FACTS = V.cte(V.prediction_facts_sql)
AD_COLUMNS = ", ".join(S.FLAT_AD_COLUMNS)
COMMON = ", ".join(S.COMMON_COLUMNS)


@query("scan_listing_csv", f"SELECT {COMMON}, source_ad_id, source_list_id, source_link FROM ({D.ads_standard()})")
def scan_listing_csv(spark, sf):
    return listings.scan_listing_csv(spark, I.ads_csv(spark, sf)).drop("row_id")


@query("map_ad_columns", "SELECT page_id AS row_id, Subject AS name, Subject AS description, "
       f"{D.q(S.APARTMENT)} AS property_type_name, Region AS province_name, District AS district_name, "
       "Ward AS ward_name, Address AS street_name, 'Unknown' AS project_name, PriceVND AS price, AreaM2 AS area, "
       "Floor AS floor_count, CAST(NULL AS DOUBLE) AS frontage_width, CAST(NULL AS DOUBLE) AS house_depth, "
       "CAST(NULL AS DOUBLE) AS road_width, BedRooms AS bedroom_count, BathRooms AS bathroom_count, "
       "MainDirection AS house_direction, BalconyDirection AS balcony_direction, NgayDang AS published_at, "
       "'chotot' AS source, AdId AS source_ad_id, ListId AS source_list_id, Link AS source_link "
       f"FROM ({D.flat_ads()})")
def map_ad_columns(spark, sf):
    return listings.map_ad_columns(I.flat_ads(spark, sf).withColumnRenamed("page_id", "row_id"))


_RAGGED_KEEP = "row_id % 10 > 2"


def ragged_sql() -> str:
    sql = f"SELECT * REPLACE ('x, \"y\" ' || coalesce(description, '') AS description) FROM ({D.raw_mogi()})"
    return f"SELECT {COMMON}, link AS source_link FROM ({D.put(sql, 'description', D.clean('description'))}) WHERE {_RAGGED_KEEP}"


@query("scan_ragged_csv", ragged_sql())
def scan_ragged_csv(spark, sf):
    return listings.scan_ragged_csv(spark, I.ragged_csv(spark, sf)).drop("row_id")


@query("ragged_profile", "SELECT count(*) FILTER (row_id % 10 > 2) AS valid_rows, "
       "count(*) FILTER (row_id % 10 = 2) AS header_rows, "
       f"count(*) FILTER (row_id % 10 < 2) AS skipped_rows FROM ({RAW})")
def ragged_profile(spark, sf):
    return listings.ragged_profile(listings.read_ragged_csv(spark, I.ragged_csv(spark, sf)))


@query("map_positional_columns", "SELECT row_id, name, description, property_type_name, province_name, district_name, "
       "ward_name, street_name, price, area, bedroom_count, '2' AS bathroom_count, published_at, "
       "'Unknown' AS project_name, CAST(NULL AS DOUBLE) AS floor_count, CAST(NULL AS DOUBLE) AS frontage_width, "
       "CAST(NULL AS DOUBLE) AS house_depth, CAST(NULL AS DOUBLE) AS road_width, 'Unknown' AS house_direction, "
       f"'Unknown' AS balcony_direction, 'mogi' AS source, link AS source_link FROM ({RAW})")
def map_positional_columns(spark, sf):
    landed = I.raw(spark, sf).withColumns({"bathroom_count": F.lit("2"), "url": F.col("link")})
    return listings.map_positional_columns(landed)


@query("bounded_filtered_scan", f"""
SELECT row_id, province_name, property_type_name FROM (
  SELECT * FROM (SELECT * FROM ({RAW}) ORDER BY row_id LIMIT 9000)
  WHERE province_name IS NOT NULL AND row_id IN (SELECT row_id FROM (
    {D.province(f"SELECT row_id, province_name FROM ({RAW})", "province_name")}) WHERE province_name = {D.q(S.HCMC)})
  AND {D.clean('property_type_name')} = {D.q(S.APARTMENT)}
) ORDER BY row_id LIMIT 1500""")
def bounded_filtered_scan(spark, sf):
    kept = listings.bounded_filtered_scan(I.raw(spark, sf), max_rows=1500, scan_limit=9000)
    return kept.select("row_id", "province_name", "property_type_name")


# a number of zero or less is no price and no area, however its text was read at first
@query("scan_clean_cache", D.put(D.put(D.put(D.raw_standard(), "source", "'huggingface'"),
       "area", "CASE WHEN area > 0 THEN area END"), "price", "CASE WHEN price > 0 THEN price END"))
def scan_clean_cache(spark, sf):
    path = outputs.write_table(I.raw_standard(spark, sf), scratch_path(spark, "cache"))
    return listings.scan_clean_cache(spark, path)


@query("explode_ad_pages", f"SELECT page_id, AdId, ListId FROM ({D.flat_ads()})")
def explode_ad_pages(spark, sf):
    return I.ad_objects(spark, sf).select("page_id", F.col("ad.ad_id").alias("AdId"), F.col("ad.list_id").alias("ListId"))


@query("flatten_ad", f"SELECT page_id, {AD_COLUMNS} FROM ({D.flat_ads()})")
def flatten_ad(spark, sf):
    return I.flat_ads(spark, sf)


_KINDS = {c: "string" for c in ("name", "description", "property_type_name", "project_name", "province_name", "district_name",
                                "ward_name", "street_name", "house_direction", "balcony_direction", "source")} | {
    c: "double" for c in ("price", "area", "floor_count", "bedroom_count", "bathroom_count", "frontage_width", "house_depth", "road_width")
} | {"row_id": "bigint", "published_at": "timestamp_ntz"}


@query("profile_schema", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{k}' AS type, count({c}) AS filled FROM ({LISTINGS})" for c, k in _KINDS.items()))
def profile_schema(spark, sf):
    """All columns; their positions are checked in the tests."""
    return listings.profile_schema(I.listings(spark, sf)).drop("position")


@query("sample_rows", f"SELECT count(*) AS \"rows\", count(price) AS known FROM (SELECT price FROM ({FACTS}) LIMIT 20)")
def sample_rows(spark, sf):
    """Twenty rows, whichever come first, all of them rows of the table."""
    df = I.facts(spark, sf)
    taken = listings.sample_rows(df, 20, ["row_id", "price", "nothing"])
    known = F.broadcast(taken).join(df.select("row_id", F.col("price").alias("p")), "row_id").where("price = p")  # 20 rows
    return taken.agg(F.count("*").alias("rows")).withColumn("known", known.agg(F.count("*")).scalar())


@query("scan_ad_pages", f"SELECT {AD_COLUMNS} FROM ({D.flat_ads()})")
def scan_ad_pages(spark, sf):
    """Captured pages as files, one document per line."""
    landed = scratch_path(spark, "pages")
    I.page_texts(spark, sf).select(F.col("page").alias("value")).write.text(landed)
    return ads.flatten_ad(ads.explode_ad_pages(ads.read_ad_pages(spark, landed)), F.lit(I.CRAWL_TIME), zone="UTC")


@query("scan_crawls", """
WITH p AS (SELECT o_orderkey AS page, o_orderkey // 64 AS crawl, o_orderkey % 4 = 3 AND o_orderkey % 9 <> 0 AS empty,
 o_orderkey % 9 = 0 AS failed FROM orders),
e AS (SELECT crawl, min(page) FILTER (empty) AS stopped_at FROM p GROUP BY crawl)
SELECT p.crawl, p.page, stopped_at FROM p JOIN e USING (crawl) WHERE NOT failed AND (stopped_at IS NULL OR page < stopped_at)""")
def scan_crawls(spark, sf):
    """Crawls of up to 64 pages: a page in nine is no JSON, and the first page without ads ends its crawl."""
    text = F.when(F.col("page_id") % 9 == 0, F.concat(F.lit('<html>'), "page")).otherwise(F.col("page"))
    captured = I.page_texts(spark, sf).select(
        F.expr("page_id div 64").alias("crawl"), F.col("page_id").alias("number"), text.alias("page_text"))
    pages = ads.parse_pages(captured).withColumnRenamed("number", "page")
    return ads.until_empty(pages).join(ads.crawl_ends(pages), "crawl").select("crawl", "page", "stopped_at")


@query("scan_csv_order", f"""SELECT price, arg_min(published_at, k) AS published_at, arg_min(row_id, k) AS row_id FROM (
SELECT *, CASE WHEN row_id % 7 = 0 THEN 1180591620717411303424::HUGEINT ELSE 0 END + row_id AS k FROM ({FACTS})) GROUP BY price""")
def scan_csv_order(spark, sf):
    """Files of unequal size with duplicates across them: the first in file order stays."""
    folder = scratch_path(spark, "ordered")
    df = I.facts(spark, sf).select("price", "published_at", F.col("row_id").alias("number"))
    for name, side in (("a", F.col("number") % 7 != 0), ("b", F.col("number") % 7 == 0)):
        outputs.write_table(df.where(side).orderBy("number"), f"{folder}/{name}", "csv")
    scanned = listings.read_headered_csv(spark, f"{folder}/*", numbered=True)
    return dedupe.keep_first(scanned, ["price"], ["row_id"]).select(
        F.col("price").cast("double").alias("price"), F.col("published_at").cast("timestamp_ntz").alias("published_at"),
        F.col("number").cast("bigint").alias("row_id"))


_NOTE = "'row ' || row_id || CASE row_id % 5 WHEN 0 THEN chr(10) || 'second, \"line\"' WHEN 1 THEN ', comma' WHEN 2 THEN chr(10) || chr(10) || '\",' || chr(10) ELSE '' END"


@query("scan_csv_records", f"SELECT row_id, {_NOTE} AS note, published_at FROM ({FACTS})")
def scan_csv_records(spark, sf):
    """Fields with line breaks, commas and quotes, in files that are split within records."""
    df = I.facts(spark, sf).select("row_id", F.expr(_NOTE.replace("chr(10)", "char(10)").replace(" || ", "||")).alias("note"), "published_at")
    path = outputs.write_table(df, scratch_path(spark, "records"), "csv")
    return listings.read_headered_csv(spark, path).select(
        F.col("row_id").cast("bigint").alias("row_id"), "note", F.col("published_at").cast("timestamp_ntz").alias("published_at"))


@query("write_datasets", f"""
WITH c AS ({D.cleaned(D.typed_standard(LISTINGS))})
SELECT 'clean' AS name, posted_year, posted_month, count(*) AS "rows", round(sum(price), 0) AS money FROM c GROUP BY ALL
UNION ALL SELECT 'copy', posted_year, posted_month, count(*), round(sum(price), 0) FROM c GROUP BY ALL""")
def write_datasets(spark, sf):
    clean = I.clean_listings(spark, sf)
    folder = scratch_path(spark, "datasets")
    paths = outputs.write_datasets({"clean": clean}, folder)
    # the export format, written from the table just stored
    paths |= outputs.write_datasets({"copy": spark.read.parquet(paths["clean"])}, f"{folder}/csv", "csv")
    tables = {
        "clean": spark.read.parquet(paths["clean"]),
        "copy": listings.type_numbers(listings.read_headered_csv(spark, paths["copy"]), ["price"])}
    return metrics.union_all([
        df.groupBy(F.lit(name).alias("name"), F.col("posted_year").cast("int").alias("posted_year"),
                   F.col("posted_month").cast("int").alias("posted_month"))
        .agg(F.count("*").alias("rows"), F.round(F.sum("price"), 0).alias("money")) for name, df in tables.items()])


_METRIC = """SELECT '{name}' AS "Model", round(avg(abs(price - p)), 2) AS "MAE_VND",
round(sqrt(avg((price - p) * (price - p))), 2) AS "RMSE_VND",
round(1 - sum((price - p) * (price - p)) / (var_pop(price) * count(*)), 9) AS "R2",
round(avg(abs(price - p)) / 1e9, 9) AS "MAE_BILLION_VND",
round(sqrt(avg((price - p) * (price - p))) / 1e9, 9) AS "RMSE_BILLION_VND"
FROM (SELECT price, {p} AS p FROM ({facts}))"""
METRICS = " UNION ALL ".join(_METRIC.format(name=n, p=p, facts=PRED_FACTS) for n, p in (
    ("Random_Forest", "predicted_price"), ("Ridge_Regression", "price * 0.98::DOUBLE"),
    ("Baseline_Median", "price * 0.5::DOUBLE")))


def rounded(df):
    return df.withColumns({
        "MAE_VND": F.round("MAE_VND", 2), "RMSE_VND": F.round("RMSE_VND", 2), "R2": F.round("R2", 9),
        "MAE_BILLION_VND": F.round("MAE_BILLION_VND", 9), "RMSE_BILLION_VND": F.round("RMSE_BILLION_VND", 9)})


@query("write_metrics", METRICS)
def write_metrics(spark, sf):
    path = outputs.write_table(I.metrics_table(spark, sf), scratch_path(spark, "metrics"))
    return rounded(outputs.scan_metrics(spark.read.parquet(path)))


@query("scan_metrics", METRICS)
def scan_metrics(spark, sf):
    path = outputs.write_table(I.metrics_table(spark, sf).coalesce(1), scratch_path(spark, "metrics") + ".csv", "csv")
    return rounded(outputs.scan_metrics(outputs.read_any(spark, path)))


@query("pick_metrics", f"SELECT * FROM ({METRICS}) WHERE \"Model\" = 'Random_Forest'")
def pick_metrics(spark, sf):
    return rounded(outputs.pick_metrics(I.metrics_table(spark, sf)))


_REPORT = ("published_at, source, property_type_name, province_name, district_name, ward_name, street_name, "
           "project_name, area, bedroom_count, bathroom_count, price, predicted_price, absolute_error, "
           "absolute_error / 1e9 AS absolute_error_billion")


@query("write_predictions", f"SELECT {_REPORT} FROM ({PRED})")
def write_predictions(spark, sf):
    report = models.prediction_report(I.predictions(spark, sf, facts_only=False))
    return spark.read.parquet(outputs.write_table(report, scratch_path(spark, "predictions")))


@query("prediction_report", f"SELECT {_REPORT} FROM ({PRED})")
def prediction_report(spark, sf):
    return models.prediction_report(I.predictions(spark, sf, facts_only=False))


_BILLIONS = ("price / 1e9 AS price_billion, predicted_price / 1e9 AS predicted_billion, "
             "absolute_error / 1e9 AS error_billion, strftime(published_at, '%Y-%m') AS month")


@query("scan_predictions", f"SELECT price, predicted_price, absolute_error, area, district_name, source, published_at, "
       f"{_BILLIONS} FROM ({PRED}) WHERE area < 400")
def scan_predictions(spark, sf):
    wide = I.predictions(spark, sf, facts_only=False)
    landed = wide.select(*[c for c in outputs.PREDICTION_REQUIRED if c != "area"],
                         F.when(F.col("area") < 400, F.col("area")).alias("area"))
    path = outputs.write_table(landed, scratch_path(spark, "predictions") + ".csv", "csv")
    return outputs.scan_predictions(spark, path)


@query("scan_split_tables", f"""
SELECT split, source, count(*) AS "rows", min(published_at) AS first_time FROM (
SELECT *, CASE WHEN published_at < TIMESTAMP '2000-01-01' THEN 'Train' ELSE 'Test' END AS split FROM ({FACTS}))
GROUP BY split, source""")
def scan_split_tables(spark, sf):
    df = I.facts(spark, sf).select("row_id", "published_at", "source")
    cut = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    folder = scratch_path(spark, "split_csv")
    for name, side in (("train_csv", F.col("published_at") < cut), ("test_csv", F.col("published_at") >= cut)):
        outputs.write_table(df.where(side), f"{folder}/{name}", "csv")
    train, test = outputs.scan_split_tables(spark, f"{folder}/train_csv", f"{folder}/test_csv")
    return (train.unionByName(test).groupBy("split", "source")
            .agg(F.count("*").alias("rows"), F.min("published_at").alias("first_time")))


@query("run_summary", f"""
SELECT 'fixed_train_1999-06-01_to_2000-02-28__test_2000-03-01_to_2000-05-31' AS split_strategy,
min(published_at) FILTER (tr) AS train_start, max(published_at) FILTER (tr) AS train_end, count(*) FILTER (tr) AS train_rows,
min(published_at) FILTER (te) AS test_start, max(published_at) FILTER (te) AS test_end, count(*) FILTER (te) AS test_rows,
(SELECT string_agg(source || '=' || c, ',' ORDER BY source) FROM (SELECT source, count(*) AS c FROM ({FACTS}) WHERE published_at
  BETWEEN TIMESTAMP '1999-06-01' AND TIMESTAMP '2000-02-28 23:59:59' GROUP BY source)) AS train_sources,
(SELECT string_agg(source || '=' || c, ',' ORDER BY source) FROM (SELECT source, count(*) AS c FROM ({FACTS}) WHERE published_at
  BETWEEN TIMESTAMP '2000-03-01' AND TIMESTAMP '2000-05-31 23:59:59' GROUP BY source)) AS test_sources,
'area,floor_count,frontage_width,house_depth,road_width,bedroom_count,bathroom_count,posted_year,posted_month,posted_day,posted_dayofweek'
  AS numeric_features,
'property_type_name,province_name,district_name,ward_name,street_name,project_name,house_direction,balcony_direction' AS categorical_features,
'the models learn log1p(price); errors are in VND' AS target_transform, 4 AS notes,
'Random_Forest' AS best_model FROM (SELECT published_at,
published_at BETWEEN TIMESTAMP '1999-06-01' AND TIMESTAMP '2000-02-28 23:59:59' AS tr,
published_at BETWEEN TIMESTAMP '2000-03-01' AND TIMESTAMP '2000-05-31 23:59:59' AS te FROM ({FACTS}))""")
def run_summary(spark, sf):
    train, test, label = splits.split_fixed_range(
        I.facts(spark, sf), "1999-06-01", "2000-02-28", "2000-03-01", "2000-05-31", check=False)
    path = outputs.write_table(runs.run_summary(train, test, label, "Random_Forest"), scratch_path(spark, "summary"))
    entries = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return spark.read.parquet(path).select(
        "split_strategy", "train_start", "train_end", "train_rows", "test_start", "test_end", "test_rows", "best_model",
        *[F.when(F.size(f"{side}_source_distribution") > 0, entries(f"{side}_source_distribution")).alias(f"{side}_sources")
          for side in ("train", "test")],
        *[F.array_join(c, ",").alias(c) for c in ("numeric_features", "categorical_features")], "target_transform",
        F.size("excluded_columns_note").alias("notes"))


# ---- projections and filters --------------------------------------------------------

@query("complete_schema", f"SELECT {COMMON.replace('road_width', 'CAST(NULL AS DOUBLE) AS road_width')}, row_id FROM "
       f"(SELECT *, 'x' AS dummy FROM ({LISTINGS}))".replace(
           "project_name,", "CAST(NULL AS VARCHAR) AS project_name,", 1))
def complete_schema(spark, sf):
    short = I.listings(spark, sf).drop("road_width", "project_name")
    return std.complete_schema(short).select(*S.COMMON_COLUMNS, "row_id")


@query("standardize_schema", D.raw_standard())
def standardize_schema(spark, sf):
    return I.raw_standard(spark, sf)


@query("standardize_schema_merge", f"SELECT * FROM ({D.raw_standard('merge')}) WHERE source <> 'mogi'")
def standardize_schema_merge(spark, sf):
    return I.raw_standard(spark, sf, "merge", S.SOURCES[:2])


@query("standardize_typed", D.typed_standard(LISTINGS))
def standardize_typed(spark, sf):
    return I.typed_standard(I.listings(spark, sf))


@query("source_tag", f"SELECT row_id, price, 'mogi' AS source, 'Train' AS split FROM ({FACTS})")
def source_tag(spark, sf):
    df = I.facts(spark, sf).select("row_id", "price")
    return std.tag(std.tag(df, "source", "mogi"), "split", "Train")


@query("drop_required_nulls", f"SELECT {COMMON}, row_id FROM ({D.raw_standard()}) "
       "WHERE price IS NOT NULL AND area IS NOT NULL AND published_at IS NOT NULL")
def drop_required_nulls(spark, sf):
    return cleaning.drop_required_nulls(I.raw_standard(spark, sf))


@query("filter_price_area", f"SELECT row_id, price, area FROM ({FACTS}) "
       "WHERE price BETWEEN 1e8 AND 1e11 AND area BETWEEN 10 AND 500")
def filter_price_area(spark, sf):
    return cleaning.filter_price_area(I.facts(spark, sf).select("row_id", "price", "area"))


@query("price_per_m2_filter", "SELECT row_id, price, area, price / area AS price_per_m2 "
       f"FROM ({FACTS}) WHERE price / area BETWEEN 5e6 AND 1e9")
def price_per_m2_filter(spark, sf):
    return cleaning.price_per_m2_filter(I.facts(spark, sf).select("row_id", "price", "area"))


def _segment(name, mode, province, kind, place, type_expr):
    sql = f"SELECT row_id, property_type_name, province_name AS p, province_name FROM ({RAW})"
    cond = [f"p = {D.q(province)}"] if province else []
    if kind:
        cond.append(f"{type_expr('property_type_name')} = {D.q(kind)}")

    @query(name, f"SELECT row_id, property_type_name, province_name FROM ({place(sql)}) WHERE {' AND '.join(cond)}")
    def run(spark, sf):
        df = I.raw(spark, sf).select("row_id", "property_type_name", "province_name")
        return cleaning.filter_segment(df, province, kind, mode)


_segment("filter_segment", "fixed", S.HCMC, S.APARTMENT, lambda s: D.province(s, "p"), D.clean)
_segment("filter_segment_merge", "merge", S.HCMC, "", lambda s: D.province(s, "p", "merge"), D.clean)
_segment("filter_segment_single", "single", "", S.APARTMENT, lambda s: s, D.strip)


@query("clean_for_model", D.cleaned(D.typed_standard(LISTINGS)))
def clean_for_model(spark, sf):
    return I.clean_listings(spark, sf)


@query("clean_raw_listings", D.cleaned(D.raw_standard()))
def clean_raw_listings(spark, sf):
    return cleaning.clean_for_model(I.raw_standard(spark, sf))


@query("keep_model_columns", f"SELECT {COMMON}, {', '.join(S.DERIVED_COLUMNS)} FROM "
       f"({D.cleaned(D.typed_standard(LISTINGS))})")
def keep_model_columns(spark, sf):
    return std.keep_columns(I.clean_listings(spark, sf).withColumn("source_link", F.lit("x")))


@query("billion_units", f"SELECT row_id, {_BILLIONS} FROM ({PRED_FACTS})")
def billion_units(spark, sf):
    return I.predictions(spark, sf).select("row_id", "price_billion", "predicted_billion", "error_billion", "month")


@query("sort_by_time", f"SELECT row_id, published_at, price FROM ({FACTS}) ORDER BY published_at, row_id")
def sort_by_time(spark, sf):
    return I.facts(spark, sf).select("row_id", "published_at", "price").orderBy("published_at", "row_id")


@query("limit_rows", f"SELECT row_id, published_at, price FROM ({FACTS}) ORDER BY row_id LIMIT 1000")
def limit_rows(spark, sf):
    return selection.first_rows(I.facts(spark, sf).select("row_id", "published_at", "price"), "row_id", 1000)


@query("union_sources", f"""
SELECT row_id, published_at, price, CAST(NULL AS VARCHAR) AS source_link, source FROM ({FACTS}) WHERE source = 'huggingface'
UNION ALL BY NAME SELECT row_id, published_at, price, 'a' AS source_link, source FROM ({FACTS}) WHERE source = 'chotot'
UNION ALL BY NAME SELECT row_id, published_at, price, 'b' AS source_link, source FROM ({FACTS}) WHERE source = 'mogi'""")
def union_sources(spark, sf):
    df = I.facts(spark, sf).select("row_id", "published_at", "price", "source")
    hf, chotot, mogi = (df.where(F.col("source") == s) for s in S.SOURCES)
    return std.union_sources(hf, chotot.withColumn("source_link", F.lit("a")), mogi.withColumn("source_link", F.lit("b")))


@query("union_two", f"SELECT {COMMON}, {', '.join(S.DERIVED_COLUMNS)} FROM "
       f"({D.cleaned(D.typed_standard(LISTINGS))}) WHERE source IN ('huggingface', 'chotot')")
def union_two(spark, sf):
    clean = std.keep_columns(I.clean_listings(spark, sf))
    return std.union_sources(*[clean.where(F.col("source") == s) for s in ("huggingface", "chotot")])


@query("clean_rows_by_month_and_source", f"""
SELECT strftime(published_at, '%Y-%m') AS month, source, count(*) AS "rows" FROM (
{D.first_of(D.cleaned(D.typed_standard(V.cte(V.doubled_sql))), S.DEDUPE_KEYS['merged'], D.LISTING_ORDER)})
GROUP BY ALL""")
def clean_rows_by_month_and_source(spark, sf):
    clean = cleaning.clean_for_model(I.typed_standard(I.doubled(spark, sf)))
    return coverage.rows_by_month_and_source(dedupe.keep_first(clean, S.DEDUPE_KEYS["merged"]))
