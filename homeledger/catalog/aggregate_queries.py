"""Aggregates, duplicates, ranks, charts and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeledger import schema as S
from homeledger.catalog import duck as D, inputs as I, views as V
from homeledger.catalog.registry import query
from homeledger.catalog.source_queries import METRICS, rounded
from homeledger.operators import charts, cleaning, coverage, dedupe, features, legacy, metrics, ranking, selection
from homeledger.session import scratch_path
from homeledger.sources import outputs

FACTS = V.cte(V.facts_sql)
LISTINGS = V.cte(V.listings_sql)
DOUBLED = V.cte(V.doubled_sql)
PRED = V.cte(V.predictions_sql)
PRED_FACTS = V.cte(V.prediction_facts_sql)
COMMON = ", ".join(S.COMMON_COLUMNS)
BILLIONS = f"SELECT *, price / 1e9 AS pb, predicted_price / 1e9 AS qb, absolute_error / 1e9 AS eb FROM ({PRED})"
BILLION_FACTS = BILLIONS.replace(PRED, PRED_FACTS)


# ---- coverage -----------------------------------------------------------------------

@query("cleaning_funnel", f"""
WITH s AS ({D.raw_standard()}), f AS (SELECT
 published_at IS NOT NULL AND price IS NOT NULL AND area IS NOT NULL AS a, price BETWEEN 1e8 AND 1e11 AS b,
 area BETWEEN 10 AND 500 AS c, price / nullif(area, 0) BETWEEN 5e6 AND 1e9 AS d FROM s)
SELECT 0 AS step_no, 'input' AS step, count(*) AS "rows" FROM f
UNION ALL SELECT 1, 'required', count(*) FILTER (a) FROM f
UNION ALL SELECT 2, 'price', count(*) FILTER (a AND b) FROM f
UNION ALL SELECT 3, 'area', count(*) FILTER (a AND b AND c) FROM f
UNION ALL SELECT 4, 'price_per_m2', count(*) FILTER (a AND b AND c AND d) FROM f""")
def cleaning_funnel(spark, sf):
    return cleaning.cleaning_funnel(I.raw_standard(spark, sf))


@query("observed_funnel", f"""
WITH s AS ({D.raw_standard()}), f AS (SELECT
 published_at IS NOT NULL AND price IS NOT NULL AND area IS NOT NULL AS a, price BETWEEN 1e8 AND 1e11 AS b,
 area BETWEEN 10 AND 500 AS c, price / nullif(area, 0) BETWEEN 5e6 AND 1e9 AS d FROM s)
SELECT 0 AS step_no, 'input' AS step, count(*) AS "rows", count(*) FILTER (a AND b AND c AND d) AS written FROM f
UNION ALL SELECT 1, 'required', count(*) FILTER (a), count(*) FILTER (a AND b AND c AND d) FROM f
UNION ALL SELECT 2, 'price', count(*) FILTER (a AND b), count(*) FILTER (a AND b AND c AND d) FROM f
UNION ALL SELECT 3, 'area', count(*) FILTER (a AND b AND c), count(*) FILTER (a AND b AND c AND d) FROM f
UNION ALL SELECT 4, 'price_per_m2', count(*) FILTER (a AND b AND c AND d), count(*) FILTER (a AND b AND c AND d) FROM f""")
def observed_funnel(spark, sf):
    """The funnel's counts, taken while the clean table is written, beside the rows written."""
    clean, funnel = cleaning.observed_funnel(I.raw_standard(spark, sf))
    _, rows = outputs.write_counted({"clean": clean}, scratch_path(spark, "counted"))
    return cleaning.funnel_table(spark, funnel.get).withColumn("written", F.lit(rows["clean"]).cast("bigint"))


@query("time_range", f"SELECT min(published_at) AS first_time, max(published_at) AS last_time FROM ({FACTS})")
def time_range(spark, sf):
    return coverage.time_range(I.facts(spark, sf))


@query("rows_by_source", f'SELECT source, count(*) AS "rows" FROM ({FACTS}) GROUP BY source')
def rows_by_source(spark, sf):
    return coverage.rows_by_source(I.facts(spark, sf))


@query("count_order", f'SELECT balcony_direction, count(*) AS "rows" FROM ({FACTS}) '
       "WHERE balcony_direction IS NOT NULL GROUP BY balcony_direction")
def count_order(spark, sf):
    return coverage.count_values(I.facts(spark, sf), "balcony_direction")


@query("rows_by_month", f"SELECT strftime(published_at, '%Y-%m') AS month, count(*) AS \"rows\" FROM ({FACTS}) GROUP BY 1")
def rows_by_month(spark, sf):
    return coverage.rows_by_month(I.facts(spark, sf))


@query("rows_by_day", 'SELECT CAST(ts AS DATE) AS day, count(*) AS "rows" FROM events GROUP BY 1')
def rows_by_day(spark, sf):
    return coverage.rows_by_day(V.table(spark, sf, "events"), "ts")


@query("time_coverage", f"""SELECT count(*) AS "rows", count(published_at) AS valid_dates, min(published_at) AS first_time,
max(published_at) AS last_time FROM ({D.raw_standard()})""")
def time_coverage(spark, sf):
    return coverage.time_coverage(I.raw_standard(spark, sf))


@query("coverage_report", f"""WITH s AS ({D.raw_standard()})
SELECT 'rows' AS section, 'all' AS label, count(*) AS "rows" FROM s
UNION ALL SELECT 'rows', 'valid', count(published_at) FROM s
UNION ALL SELECT 'month', strftime(published_at, '%Y-%m'), count(*) FROM s WHERE published_at IS NOT NULL GROUP BY 2
UNION ALL SELECT 'day', strftime(published_at, '%Y-%m-%d'), count(*) FROM s WHERE published_at IS NOT NULL GROUP BY 2""")
def coverage_report(spark, sf):
    return coverage.coverage_report(I.raw_standard(spark, sf))


@query("source_distribution", f"""SELECT CASE WHEN published_at < TIMESTAMP '2000-01-01' THEN 'Train' ELSE 'Test' END AS split,
source, count(*) AS "rows" FROM ({FACTS}) GROUP BY 1, 2""")
def source_distribution(spark, sf):
    df = I.facts(spark, sf)
    cut = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    return coverage.source_distribution(df.where(F.col("published_at") < cut), df.where(F.col("published_at") >= cut))


@query("any_not_null", f"SELECT count(frontage_width) > 0 AS frontage_width, count(floor_count) > 0 AS floor_count, "
       f"count(bathroom_count) > 0 AS bathroom_count FROM ({FACTS})")
def any_not_null(spark, sf):
    return coverage.any_not_null(I.facts(spark, sf), ["frontage_width", "floor_count", "bathroom_count"])


# ---- order statistics and errors ----------------------------------------------------

@query("target_median", f"SELECT median(price) AS median FROM ({FACTS})")
def target_median(spark, sf):
    return metrics.target_median(I.facts(spark, sf))


@query("exact_quantiles", f"""SELECT source, p AS prob, round(quantile_cont(price, p), 4) AS quantile, count(*) AS n FROM ({FACTS}),
(VALUES (0.0::DOUBLE), (0.1::DOUBLE), (0.5::DOUBLE), (0.99::DOUBLE), (1.0::DOUBLE)) AS v(p) GROUP BY source, p"""
       .replace("quantile_cont(price, p)", "CASE p WHEN 0 THEN quantile_cont(price, 0.0) WHEN 0.1 THEN quantile_cont(price, 0.1) "
                "WHEN 0.5 THEN quantile_cont(price, 0.5) WHEN 0.99 THEN quantile_cont(price, 0.99) ELSE quantile_cont(price, 1.0) END"))
def exact_quantiles(spark, sf):
    out = selection.exact_quantiles(I.facts(spark, sf), "price", [0.0, 0.1, 0.5, 0.99, 1.0], ["source"])
    return out.withColumn("quantile", F.round("quantile", 4))


@query("regression_metrics", f"SELECT * FROM ({METRICS}) WHERE \"Model\" = 'Random_Forest'")
def regression_metrics(spark, sf):
    return rounded(metrics.regression_metrics(I.predictions(spark, sf), "Random_Forest"))


@query("baseline_median", f"""SELECT row_id, price, (SELECT median(price) FROM ({FACTS}) WHERE source <> 'mogi') AS predicted_price
FROM ({FACTS}) WHERE source = 'mogi'""")
def baseline_median(spark, sf):
    df = I.facts(spark, sf).select("row_id", "price", "source")
    out = metrics.baseline_median(df.where("source <> 'mogi'"), df.where("source = 'mogi'"))
    return out.drop("source")


@query("rank_models", f"""
SELECT 'mae' AS chart, row_number() OVER (ORDER BY "MAE_BILLION_VND") AS place, "Model" FROM ({METRICS}) UNION ALL
SELECT 'rmse', row_number() OVER (ORDER BY "RMSE_BILLION_VND"), "Model" FROM ({METRICS}) UNION ALL
SELECT 'r2', row_number() OVER (ORDER BY "R2" DESC), "Model" FROM ({METRICS})""")
def rank_models(spark, sf):
    table = I.metrics_table(spark, sf)
    parts = []
    for chart, (column, descending) in metrics.RANKINGS.items():
        ordered = metrics.rank_models(table, column, descending)  # three rows
        place = F.monotonically_increasing_id()
        parts.append(ordered.coalesce(1).select(F.lit(chart).alias("chart"), (place + 1).alias("place"), "Model"))
    return metrics.union_all(parts)


@query("best_model", f"""SELECT CASE WHEN m = 'Baseline_Median' THEN 'Random_Forest' ELSE m END AS best_model FROM
(SELECT arg_min("Model", "MAE_VND") AS m FROM ({METRICS}))""")
def best_model(spark, sf):
    return metrics.best_model(I.metrics_table(spark, sf))


@query("scalar_attach", f"""SELECT row_id, price FROM ({FACTS})
WHERE strftime(published_at, '%Y-%m') = (SELECT strftime(max(published_at), '%Y-%m') FROM ({FACTS}))""")
def scalar_attach(spark, sf):
    return coverage.latest_month_rows(I.facts(spark, sf)).select("row_id", "price")


# ---- duplicates and ranks -----------------------------------------------------------

def _keep_first(name, stage, run_first=dedupe.keep_first):
    keys = S.DEDUPE_KEYS[stage]

    @query(name, D.first_of(f"SELECT {COMMON}, row_id FROM ({DOUBLED})", keys, D.LISTING_ORDER))
    def run(spark, sf):
        return run_first(I.doubled(spark, sf).select(*S.COMMON_COLUMNS, "row_id"), keys)


_keep_first("dedupe_keep_first", "merged")
_keep_first("dedupe_chotot_keys", "chotot")
_keep_first("distinct_by_key", "mogi")
_keep_first("first_per_key", "merged", dedupe.first_per_key)


@query("incremental_keep_first", D.first_of(f"SELECT {COMMON}, row_id FROM ({DOUBLED})", S.DEDUPE_KEYS["merged"], D.LISTING_ORDER))
def incremental_keep_first(spark, sf):
    """Three loads, the middle of the table first, merged bucket to bucket."""
    df = I.doubled(spark, sf).select(*S.COMMON_COLUMNS, "row_id")
    name = scratch_path(spark, "first")
    table = dedupe.FirstTable(spark, "first_" + name.rsplit("-", 1)[-1], name, S.DEDUPE_KEYS["merged"], buckets=8)
    for load in ("row_id % 5 = 2", "row_id % 5 < 2", "row_id % 5 > 2"):
        rows = table.merge(df.where(load))
    return rows


@query("dedupe_crawl", D.first_of(
    f"SELECT * FROM ({D.flat_ads()}) UNION ALL SELECT * REPLACE (page_id + 1 AS page_id) FROM ({D.flat_ads()})",
    S.DEDUPE_KEYS["crawl"], "page_id"))
def dedupe_crawl(spark, sf):
    flat = I.flat_ads(spark, sf)
    again = flat.withColumn("page_id", F.col("page_id") + 1)
    return dedupe.keep_first(flat.unionByName(again), S.DEDUPE_KEYS["crawl"], ["page_id"])


@query("duplicates_removed", f"""SELECT count(*) AS rows_before,
(SELECT count(*) FROM (SELECT DISTINCT {', '.join(S.DEDUPE_KEYS['merged'])} FROM ({DOUBLED}))) AS rows_after,
count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(S.DEDUPE_KEYS['merged'])} FROM ({DOUBLED}))) AS removed
FROM ({DOUBLED})""")
def duplicates_removed(spark, sf):
    return dedupe.duplicates_removed(I.doubled(spark, sf), S.DEDUPE_KEYS["merged"])


@query("chronological_rank", "SELECT row_id, published_at, row_number() OVER (ORDER BY published_at, row_id) AS position "
       f"FROM ({FACTS})")
def chronological_rank(spark, sf):
    return ranking.chronological_rank(I.facts(spark, sf).select("row_id", "published_at"))


# ---- features -----------------------------------------------------------------------

CLEAN = D.cleaned(D.typed_standard(LISTINGS))
_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category FROM c" for c in S.CATEGORICAL_FEATURES)
_FREQ = f"SELECT feature, category, count(*) AS \"rows\" FROM ({_LONG}) WHERE category IS NOT NULL GROUP BY ALL"


@query("category_frequency", f"WITH c AS ({CLEAN}) SELECT *, CASE WHEN \"rows\" >= 1800 THEN category "
       f"ELSE '__infrequent__' END AS bucket FROM ({_FREQ})")
def category_frequency(spark, sf):
    return features.category_frequency(I.clean_listings(spark, sf), min_frequency=1800)


@query("lookup_infrequent", f"""WITH c AS ({CLEAN}) SELECT row_id, CASE WHEN source = 'mogi' AND f."rows" IS NULL THEN NULL
WHEN f."rows" >= 1800 THEN c.district_name WHEN f."rows" IS NULL THEN NULL ELSE '__infrequent__' END AS district_name
FROM c LEFT JOIN (SELECT district_name, count(*) AS "rows" FROM c WHERE month(published_at) < 4 GROUP BY 1) f
ON c.district_name = f.district_name""")
def lookup_infrequent(spark, sf):
    df = I.clean_listings(spark, sf).select("row_id", "district_name", "posted_month")
    seen = features.category_frequency(df.where("posted_month < 4"), ["district_name"], 1800)
    return features.lookup_infrequent(df.drop("posted_month"), seen, "district_name")


@query("impute_mode", f"""WITH c AS ({CLEAN}) SELECT feature, category AS mode FROM (SELECT *, row_number() OVER (
PARTITION BY feature ORDER BY "rows" DESC, category) AS rn FROM ({_FREQ})) WHERE rn = 1""")
def impute_mode(spark, sf):
    return features.impute_mode(features.category_counts(I.clean_listings(spark, sf)))


_MEDIANS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, median(CAST({c} AS DOUBLE)) AS median FROM c" for c in S.NUMERIC_FEATURES)


@query("impute_median", f"WITH c AS ({CLEAN}) SELECT * FROM ({_MEDIANS}) WHERE median IS NOT NULL")
def impute_median(spark, sf):
    return features.impute_median(I.clean_listings(spark, sf))


@query("scale_by_std", "SELECT row_id, " + ", ".join(
    f"round({c} / (SELECT coalesce(nullif(stddev_pop({c}), 0), 1) FROM ({FACTS})), 9) AS {c}"
    for c in ("area", "floor_count", "bedroom_count")) + f" FROM ({FACTS})")
def scale_by_std(spark, sf):
    columns = ["area", "floor_count", "bedroom_count"]
    out = features.scale_by_std(I.facts(spark, sf).select("row_id", *columns), columns)
    return out.withColumns({c: F.round(c, 9) for c in columns})


# ---- charts -------------------------------------------------------------------------

def _districts(n, where="TRUE"):
    return (f"SELECT coalesce(district_name, 'nan') AS district_name, count(*) AS \"rows\" FROM ({BILLIONS}) WHERE {where} "
            f"GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {n}")


@query("top15_districts", _districts(15))
def top15_districts(spark, sf):
    return charts.top_districts(I.predictions(spark, sf, facts_only=False), 15)


@query("top10_districts", _districts(10, "pb <= 50"))
def top10_districts(spark, sf):
    return charts.top_districts(charts.chart_trim(I.predictions(spark, sf, facts_only=False), "price_billion"), 10)


@query("semi_join_top_districts", f"SELECT row_id, district_name, price FROM ({BILLIONS}) WHERE pb <= 50 AND district_name IN "
       f"(SELECT district_name FROM ({_districts(10, 'pb <= 50')}))")
def semi_join_top_districts(spark, sf):
    kept = charts.chart_trim(I.predictions(spark, sf, facts_only=False), "price_billion")
    return charts.in_top_districts(kept).select("row_id", "district_name", "price")


@query("boxplot_by_district", f"""
WITH p AS (SELECT district_name, pb FROM ({BILLIONS}) WHERE pb <= 50 AND district_name IN
 (SELECT district_name FROM ({_districts(10, 'pb <= 50')}))),
b AS (SELECT district_name, count(*) AS "rows", quantile_cont(pb, 0.25) AS q1, quantile_cont(pb, 0.5) AS median,
 quantile_cont(pb, 0.75) AS q3 FROM p GROUP BY 1)
SELECT district_name, "rows", round(q1, 9) AS q1, round(median, 9) AS median, round(q3, 9) AS q3,
 round(least(min(pb) FILTER (pb >= q1 - 1.5 * (q3 - q1)), q1), 9) AS whisker_low,
 round(greatest(max(pb) FILTER (pb <= q3 + 1.5 * (q3 - q1)), q3), 9) AS whisker_high
FROM p JOIN b USING (district_name) GROUP BY ALL""".replace(
    "SELECT district_name, \"rows\", round(q1, 9)", "SELECT district_name, \"rows\", round(q1, 9)").replace(
    "FROM p JOIN b USING (district_name) GROUP BY ALL",
    'FROM p JOIN b USING (district_name) GROUP BY district_name, "rows", b.q1, b.median, b.q3'))
def boxplot_by_district(spark, sf):
    box = charts.boxplot_by_district(I.predictions(spark, sf, facts_only=False))
    return box.withColumns({c: F.round(c, 9) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")})


def _histogram_sql(value: str, where: str, view: str = BILLION_FACTS) -> str:
    return f"""WITH v AS (SELECT {value} AS x FROM ({view}) WHERE {where}), r AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
s AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM r),
c AS (SELECT least(CAST(floor((x - lo) * 50 / (hi - lo)) AS BIGINT), 49) + 1 AS bin, count(*) AS n FROM v, s GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + (i - 1) * ((hi - lo) / 50), 9) AS low, round(lo + i * ((hi - lo) / 50), 9) AS high,
coalesce(n, 0) AS "rows" FROM range(1, 51) AS g(i) CROSS JOIN s LEFT JOIN c ON c.bin = g.i"""


def _bins(df):
    return df.withColumns({"low": F.round("low", 9), "high": F.round("high", 9)})


_Q99 = f"eb <= (SELECT quantile_cont(eb, 0.99) FROM ({BILLION_FACTS}))"


@query("histogram_50", _histogram_sql("pb", "pb <= 50"))
def histogram_50(spark, sf):
    return _bins(charts.histogram(charts.chart_trim(I.predictions(spark, sf), "price_billion"), "price_billion"))


@query("histogram_area", _histogram_sql("area", "area <= 300"))
def histogram_area(spark, sf):
    return _bins(charts.histogram(charts.chart_trim(I.predictions(spark, sf), "area"), "area"))


@query("error_q99_trim", _histogram_sql("eb", _Q99))
def error_q99_trim(spark, sf):
    return _bins(charts.error_histogram(I.predictions(spark, sf)))


@query("chart_trim", f"SELECT row_id, price, area FROM ({BILLION_FACTS}) WHERE pb <= 50 AND qb <= 50 AND area <= 300")
def chart_trim(spark, sf):
    kept = charts.chart_trim(I.predictions(spark, sf), "price_billion", "predicted_billion", "area")
    return kept.select("row_id", "price", "area")


@query("scatter_points", f"SELECT area AS x, pb AS y FROM ({BILLION_FACTS}) WHERE pb <= 50 AND area <= 300")
def scatter_points(spark, sf):
    return charts.scatter_points(I.predictions(spark, sf))


@query("scatter_actual_predicted", f"SELECT pb AS x, qb AS y FROM ({BILLION_FACTS}) WHERE pb <= 50 AND qb <= 50")
def scatter_actual_predicted(spark, sf):
    return charts.scatter_points(I.predictions(spark, sf), "actual_predicted")


@query("scatter_bins", f"""SELECT CAST(floor(area / 10) AS BIGINT) AS x_bin, CAST(floor(pb / 0.5) AS BIGINT) AS y_bin,
count(*) AS "rows" FROM ({BILLION_FACTS}) WHERE pb <= 50 AND area <= 300 GROUP BY 1, 2""")
def scatter_bins(spark, sf):
    return charts.scatter_bins(charts.scatter_points(I.predictions(spark, sf)), 10.0, 0.5)


_SPLIT = "CASE WHEN published_at < TIMESTAMP '2000-01-01' THEN 'Train' ELSE 'Test' END"


def sides(spark, sf):
    df = I.facts(spark, sf).select("row_id", "published_at", "source")
    cut = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    return df.where(F.col("published_at") < cut), df.where(F.col("published_at") >= cut)


@query("union_splits", f"SELECT row_id, published_at, source, {_SPLIT} AS split FROM ({FACTS})")
def union_splits(spark, sf):
    return charts.union_splits(*sides(spark, sf))


@query("pivot_month_split", f"""SELECT strftime(published_at, '%Y-%m') AS month, count(*) FILTER ({_SPLIT} = 'Test') AS "Test",
count(*) FILTER ({_SPLIT} = 'Train') AS "Train" FROM ({FACTS}) GROUP BY 1""")
def pivot_month_split(spark, sf):
    return charts.pivot_month_split(charts.union_splits(*sides(spark, sf)))


_BY_SOURCE = ", ".join(f"count(*) FILTER (source = '{s}') AS {s}" for s in charts.SOURCE_COLUMNS)


@query("pivot_month_source", f"SELECT strftime(published_at, '%Y-%m') AS month, {_BY_SOURCE} FROM ({FACTS}) GROUP BY 1")
def pivot_month_source(spark, sf):
    return charts.pivot_month_source(I.facts(spark, sf))


@query("axis_bounds", f"""SELECT least(min(pb), min(qb)) AS low, greatest(max(pb), max(qb)) AS high
FROM ({BILLION_FACTS}) WHERE pb <= 50 AND qb <= 50""")
def axis_bounds(spark, sf):
    return charts.axis_bounds(I.predictions(spark, sf))


@query("value_ranges", f"""SELECT count(*) AS "rows", min(pb) AS price_min, max(pb) AS price_max, min(area) AS area_min,
max(area) AS area_max FROM ({BILLION_FACTS})""")
def value_ranges(spark, sf):
    return charts.value_ranges(I.predictions(spark, sf))


def _report_sql() -> str:
    def long(chart, sql, label, value):
        return f"SELECT '{chart}' AS chart, {label} AS label, CAST({value} AS DOUBLE) AS value FROM ({sql})"
    bins = "printf('%02d', bin)"
    month = f"SELECT strftime(published_at, '%Y-%m') AS month, *, {_SPLIT} AS split FROM ({FACTS})"
    parts = [
        long("price", _histogram_sql("pb", "pb <= 50"), bins, '"rows"'),
        long("area", _histogram_sql("area", "area <= 300"), bins, '"rows"'),
        long("error", _histogram_sql("eb", _Q99), bins, '"rows"'),
        long("districts", _districts(15), "district_name", '"rows"'),
        long("box_median", f"SELECT district_name, round(median(pb), 9) AS m FROM ({BILLIONS}) WHERE pb <= 50 AND district_name IN "
             f"(SELECT district_name FROM ({_districts(10, 'pb <= 50')})) GROUP BY 1", "district_name", "m"),
        long("test_source", f"SELECT source, count(*) AS n FROM ({FACTS}) GROUP BY 1", "source", "n"),
        long("test_month", f"SELECT month, count(*) AS n FROM ({month}) GROUP BY 1", "month", "n"),
        *[long(f"month_{v}", f"SELECT month, count(*) FILTER (split = '{v}') AS n FROM ({month}) GROUP BY 1", "month", "n")
          for v in charts.SPLIT_COLUMNS],
        *[long(f"month_{v}", f"SELECT month, count(*) FILTER (source = '{v}') AS n FROM ({month}) GROUP BY 1", "month", "n")
          for v in charts.SOURCE_COLUMNS],
        *[long(chart, METRICS, '"Model"', f'"{column}"') for chart, column in (
            ("mae", "MAE_BILLION_VND"), ("rmse", "RMSE_BILLION_VND"), ("r2", "R2"))]]
    return " UNION ALL ".join(parts)


@query("report_tables", _report_sql())
def report_tables(spark, sf):
    table = charts.report_tables(I.predictions(spark, sf, facts_only=False), *sides(spark, sf), I.metrics_table(spark, sf))
    return table.withColumn("value", F.round("value", 9))


# ---- the older cleaner --------------------------------------------------------------

def legacy_input(spark, sf):
    """Old column names, one with outer spaces, all text."""
    df = I.raw(spark, sf)
    posted = F.when(F.col("row_id") % 30 == 0, F.lit("Hôm nay")).otherwise(F.date_format("posted", "yyyy-MM-dd HH:mm:ss"))
    return df.select(
        "row_id", posted.alias("NgayDang"), F.col("price").alias("Gia"), F.col("area").alias("DienTich"),
        F.col("bedroom_count").alias("Phongngu"), F.col("floor_count").alias(" SoTang "),
        F.col("address").alias("DiaChi"), F.col("property_type_name").alias("Loai"),
        F.col("house_direction").alias("HuongCuaChinh"), F.col("description").alias("DacDiem"))


def _legacy_sql(keep: bool) -> str:
    sql = (f"SELECT row_id, CASE WHEN row_id % 30 <> 0 THEN posted END AS \"NgayDang\", price AS \"PriceVND\", area AS \"AreaM2\", "
           f"bedroom_count AS \"BedRooms\", floor_count AS \"Floor\", {D.squeeze('address')} AS \"District\", "
           f"{D.squeeze('property_type_name')} AS \"Type\", {D.squeeze('house_direction')} AS \"MainDirection\", "
           f"{D.squeeze('description')} AS \"Characteristic\" FROM ({V.cte(V.raw_sql)})")
    sql = D.price_legacy(sql, "PriceVND")
    for c in ("AreaM2", "BedRooms", "Floor"):
        sql = D.float_vn(sql, c)
    sql = D.put(sql, '"District"', "CASE " + " ".join(
        f"WHEN regexp_matches(\"District\", '(?i){p}') THEN trim(regexp_extract(\"District\", '(?i){p}', 1))"
        for p in D.DISTRICT_IN_ADDRESS) + " END")
    sql = D.add(sql, PostedYear='CAST(year("NgayDang") AS INTEGER)', PostedMonth='CAST(month("NgayDang") AS INTEGER)')
    if keep:
        sql = (f"SELECT * FROM ({sql}) WHERE \"NgayDang\" IS NOT NULL AND \"PriceVND\" BETWEEN 1e8 AND 2e11 "
               "AND (\"AreaM2\" IS NULL OR \"AreaM2\" BETWEEN 10 AND 1000)")
    return sql


_LEGACY = ["row_id", "NgayDang", "PriceVND", "AreaM2", "BedRooms", "Floor", "District", "Type", "MainDirection",
           "Characteristic", "PostedYear", "PostedMonth"]


@query("resolve_aliases", _legacy_sql(False))
def resolve_aliases(spark, sf):
    return legacy.resolve_aliases(legacy_input(spark, sf)).select(*_LEGACY)


@query("legacy_filter", f"""SELECT row_id, price AS "PriceVND", area * 2 AS "AreaM2", published_at AS "NgayDang" FROM ({FACTS})
WHERE price BETWEEN 1e8 AND 2e11 AND (area * 2 BETWEEN 10 AND 1000)""")
def legacy_filter(spark, sf):
    df = I.facts(spark, sf).select("row_id", F.col("price").alias("PriceVND"), (F.col("area") * 2).alias("AreaM2"),
                                   F.col("published_at").alias("NgayDang"))
    return legacy.legacy_filter(df)


@query("legacy_clean", _legacy_sql(True))
def legacy_clean(spark, sf):
    return legacy.legacy_clean(legacy_input(spark, sf)).select(*_LEGACY)


def _filled_sql() -> str:
    have = {c for c in _LEGACY}
    parts = []
    for kind, names in (("numeric", legacy.LEGACY_NUMERIC), ("categorical", legacy.LEGACY_CATEGORICAL)):
        for c in names:
            n = f'count("{c}")' if c in have else "count(*) * 0"
            parts.append(f"SELECT '{c}' AS feature, '{kind}' AS kind, {n} AS filled FROM l")
    return f"WITH l AS ({_legacy_sql(True)}) SELECT * FROM ({' UNION ALL '.join(parts)})"


@query("prune_null_features", _filled_sql())
def prune_null_features(spark, sf):
    return legacy.filled_features(legacy.legacy_clean(legacy_input(spark, sf)))
