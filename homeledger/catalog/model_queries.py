"""Splits, models, scoring, streams and whole runs.

Runs and comparisons fit small forests here, ``train_random_forest`` one of full size; the rows are all.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from homeledger import schema as S
from homeledger.catalog import duck as D, inputs as I, views as V
from homeledger.catalog.registry import query
from homeledger.catalog.source_queries import COMMON, METRICS, ragged_sql
from homeledger.functions import numbers
from homeledger.operators import metrics, models, scoring, splits
from homeledger.plans import runs
from homeledger.session import cut_lineage, scratch_path
from homeledger.sources import outputs
from homeledger.streaming import jobs

FACTS = V.cte(V.facts_sql)
LISTINGS = V.cte(V.listings_sql)
DOUBLED = V.cte(V.doubled_sql)
SMALL = runs.ModelSettings(trees=20, depth=10)
FULL = runs.ModelSettings()


# ---- splits -------------------------------------------------------------------------

def tagged(split: splits.Split):
    train, test, label = split
    return metrics.union_all([
        df.select("row_id", F.lit(side).alias("split"), F.lit(label).alias("strategy"))
        for side, df in (("Train", train), ("Test", test))])


def _sides_sql(train: str, test: str, label: str, view: str = FACTS) -> str:
    return (f"SELECT row_id, 'Train' AS split, {label} AS strategy FROM ({view}) WHERE {train} UNION ALL "
            f"SELECT row_id, 'Test' AS split, {label} AS strategy FROM ({view}) WHERE {test}")


@query("split_fixed_range", _sides_sql(
    "published_at BETWEEN TIMESTAMP '1999-06-01' AND TIMESTAMP '2000-02-28 23:59:59'",
    "published_at BETWEEN TIMESTAMP '2000-02-01' AND TIMESTAMP '2000-05-31 23:59:59'",
    "'fixed_train_1999-06-01_to_2000-02-28__test_2000-02-01_to_2000-05-31'"))
def split_fixed_range(spark, sf):
    return tagged(splits.split_fixed_range(I.facts(spark, sf), "1999-06-01", "2000-02-28", "2000-02-01", "2000-05-31"))


_LAST = f"(SELECT max(published_at) FROM ({FACTS}))"
_MONTH, _DAY = f"date_trunc('month', {_LAST})", f"date_trunc('day', {_LAST})"


@query("split_latest_month", _sides_sql(f"published_at < {_MONTH}", f"published_at >= {_MONTH}",
                                        f"'latest_month_' || strftime({_LAST}, '%Y-%m')"))
def split_latest_month(spark, sf):
    return tagged(splits.split_latest_month(I.facts(spark, sf)))


@query("split_latest_day", _sides_sql(f"published_at < {_DAY}", f"published_at >= {_DAY}",
                                      f"'latest_day_' || strftime({_LAST}, '%Y-%m-%d')"))
def split_latest_day(spark, sf):
    return tagged(splits.split_latest_day(I.facts(spark, sf)))


_RANKED = f"SELECT *, row_number() OVER (ORDER BY published_at, row_id) AS pos, count(*) OVER () AS n FROM ({FACTS})"
_CUT = "CAST(floor(n * (1 - 0.2::DOUBLE)) AS BIGINT)"


@query("split_chronological", _sides_sql(f"pos <= {_CUT}", f"pos > {_CUT}", "'chronological_last_20%'", _RANKED))
def split_chronological(spark, sf):
    return tagged(splits.split_chronological(I.facts(spark, sf)))


def _auto_sql() -> str:
    flagged = (f"SELECT *, published_at >= {_MONTH} AS in_month, published_at >= {_DAY} AS in_day FROM ({_RANKED})")
    fits = (f"SELECT *, count(*) FILTER (NOT in_month) OVER () >= 500 AND count(*) FILTER (in_month) OVER () >= 200 AS m_ok, "
            f"count(*) FILTER (NOT in_day) OVER () >= 500 AND count(*) FILTER (in_day) OVER () >= 200 AS d_ok FROM ({flagged})")
    test = f"CASE WHEN m_ok THEN in_month WHEN d_ok THEN in_day ELSE pos > {_CUT} END"
    label = (f"CASE WHEN m_ok THEN 'latest_month_' || strftime({_LAST}, '%Y-%m') WHEN d_ok THEN 'latest_day_' || "
             f"strftime({_LAST}, '%Y-%m-%d') ELSE 'chronological_last_20%' END")
    return f"SELECT row_id, CASE WHEN {test} THEN 'Test' ELSE 'Train' END AS split, {label} AS strategy FROM ({fits})"


@query("split_auto", _auto_sql())
def split_auto(spark, sf):
    return tagged(splits.split_auto(I.facts(spark, sf), min_train=500, min_test=200))


@query("split_external", _sides_sql("source = 'huggingface'", "source = 'chotot'", "'external_test_hf_train_chotot_test'"))
def split_external(spark, sf):
    return tagged(splits.split_external(I.facts(spark, sf)))


@query("split_checks", f"""SELECT count(*) FILTER (published_at < {_MONTH}) AS train_rows,
count(*) FILTER (published_at >= {_MONTH}) AS test_rows, count(*) FILTER (published_at >= {_MONTH}) >= 200 AS enough FROM ({FACTS})""")
def split_checks(spark, sf):
    sides = tagged(splits.split_latest_month(I.facts(spark, sf)))
    test = F.count_if(F.col("split") == "Test")
    return sides.agg(F.count_if(F.col("split") == "Train").alias("train_rows"), test.alias("test_rows"), (test >= 200).alias("enough"))


@query("split_candidates", f"""SELECT 'latest_month' AS split, count(*) FILTER (published_at < {_MONTH}) AS train_rows,
count(*) FILTER (published_at >= {_MONTH}) AS test_rows FROM ({FACTS}) UNION ALL SELECT 'latest_day',
count(*) FILTER (published_at < {_DAY}), count(*) FILTER (published_at >= {_DAY}) FROM ({FACTS})""")
def split_candidates(spark, sf):
    return splits.split_candidates(I.facts(spark, sf))


_LABELLED = {
    f"'latest_month_' || strftime({_LAST}, '%Y-%m')": f"published_at >= {_MONTH}",
    f"'latest_day_' || strftime({_LAST}, '%Y-%m-%d')": f"published_at >= {_DAY}",
    "'chronological_last_25%'": "pos > CAST(floor(n * (1 - 0.25::DOUBLE)) AS BIGINT)",
    "'external_test_hf_train_chotot_test'": "CASE source WHEN 'huggingface' THEN false WHEN 'chotot' THEN true END",
    "'fixed_train_1995-01-01_to_1999-12-31__test_2000-01-01_to_2001-12-31'":
        "CASE WHEN published_at < TIMESTAMP '2000-01-01' THEN false WHEN published_at < TIMESTAMP '2002-01-01' THEN true END",
}


@query("strategy_label", " UNION ALL ".join(
    f"SELECT {label} AS strategy, CASE WHEN t THEN 'Test' ELSE 'Train' END AS split, count(*) AS \"rows\" "
    f"FROM (SELECT {test} AS t FROM ({_RANKED})) WHERE t IS NOT NULL GROUP BY ALL" for label, test in _LABELLED.items()))
def strategy_label(spark, sf):
    df = I.facts(spark, sf)
    made = [splits.split_latest_month(df), splits.split_latest_day(df), splits.split_chronological(df, 0.25),
            splits.split_external(df), splits.split_fixed_range(df, "1995-01-01", "1999-12-31", "2000-01-01", "2001-12-31")]
    return metrics.union_all([tagged(s) for s in made]).groupBy("strategy", "split").agg(F.count("*").alias("rows"))


# ---- models -------------------------------------------------------------------------

CLEAN = D.cleaned(D.typed_standard(LISTINGS))


_NUMBERS = [c for c in S.NUMERIC_FEATURES if c not in ("frontage_width", "house_depth")]


def _matrix_sql() -> str:
    """Imputed numbers, slots, and the places of the ones in the encoded vector."""
    cols = [f"coalesce(CAST({c} AS DOUBLE), median(CAST({c} AS DOUBLE)) OVER ()) AS f_{c}" for c in _NUMBERS]
    cats = S.CATEGORICAL_FEATURES
    named = [f"CASE WHEN count(*) OVER (PARTITION BY {c}) >= 1800 THEN {c} END AS n_{c}" for c in cats]
    slot = [f"coalesce(dense_rank() OVER (ORDER BY n_{c} NULLS LAST) - 1, 0) AS i_{c}" for c in cats]
    width = [f"max(i_{c}) OVER () + 1 AS w_{c}" for c in cats]
    places = ", ".join(f"{len(_NUMBERS)} + {' + '.join(['i_' + c, *('w_' + d for d in cats[:i])])}" for i, c in enumerate(cats))
    return (f"SELECT row_id, {', '.join(f'f_{c}' for c in _NUMBERS)}, {', '.join(f'CAST(i_{c} AS DOUBLE) AS i_{c}' for c in cats)}, "
            f"array_to_string([{places}], ',') AS ones FROM (SELECT *, {', '.join(width)} FROM (SELECT *, {', '.join(slot)} FROM ("
            f"SELECT row_id, {', '.join(cols + named)} FROM ({CLEAN}))))")


@query("feature_matrix", _matrix_sql())
def feature_matrix(spark, sf):
    clean = cut_lineage(I.clean_listings(spark, sf), "clean")
    spec = models.fit_features(clean, 1800)
    ready = cut_lineage(models.prepare_features(clean, spec, ["row_id"], key="row_id"))
    encoded = models.Pipeline(stages=models.encoding_stages(spec)).fit(ready).transform(ready)
    values = vector_to_array("features")
    first = len(spec.numeric)
    hot = F.filter(F.sequence(F.lit(first), F.size("v") - 1), lambda i: F.get("v", i) == 1.0)
    return encoded.withColumn("v", values).select(
        "row_id", *[f"f_{c}" for c in spec.numeric], *[f"i_{c}" for c in spec.categorical], F.array_join(hot, ",").alias("ones"))


@query("leakage_guard", f"WITH c AS ({CLEAN}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS filled FROM c" for c in S.NUMERIC_FEATURES + S.CATEGORICAL_FEATURES))
def leakage_guard(spark, sf):
    kept = models.leakage_guard(S.NUMERIC_FEATURES + S.CATEGORICAL_FEATURES)
    counts = I.clean_listings(spark, sf).agg(*[F.count(c).alias(c) for c in kept])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("filled")) for c in kept])))


def split_listings(spark, sf):
    """All clean listings, the last fifth in time as test side, written once."""
    clean = cut_lineage(I.clean_listings(spark, sf), "clean")
    train, test, _ = splits.split_chronological(clean, check=False)
    return train, test


_PLACED = f"SELECT *, row_number() OVER (ORDER BY published_at, row_id) AS pos, count(*) OVER () AS n FROM ({CLEAN})"
_TRAIN, _TEST = f"SELECT * FROM ({_PLACED}) WHERE pos <= {_CUT}", f"SELECT * FROM ({_PLACED}) WHERE pos > {_CUT}"


@query("train_random_forest", f"SELECT count(*) AS \"rows\", count(*) AS priced, true AS better FROM ({_TEST})")
def train_random_forest(spark, sf):
    """Rows priced, and whether the forest, of full size, fits its own rows better than their median does."""
    train, test = split_listings(spark, sf)
    spec = models.fit_features(train)
    frame = models.training_frame(train, spec)
    model = models.train_random_forest(train, spec, FULL.trees, FULL.depth, FULL.min_leaf, FULL.seed, frame)
    priced = model.predict(test.select("row_id", *S.NUMERIC_FEATURES, *S.CATEGORICAL_FEATURES), key="row_id")
    known = model.score(frame, ["label"]).withColumn("price", numbers.price_of_log(F.col("label")))
    errors = metrics.regression_metrics(known, "forest").select("MAE_VND").scalar()
    base = metrics.regression_metrics(metrics.baseline_median(train, known.drop("predicted_price")), "base").select("MAE_VND").scalar()
    return priced.agg(F.count("*").alias("rows"), F.count_if(F.col("predicted_price") >= 0).alias("priced")).withColumn("better", errors < base)


def _ridge_sql() -> str:
    """Closed form for two centred and scaled features with penalty 1."""
    facts = f"""SELECT count(*) AS n, avg(area) AS ma, stddev_pop(area) AS sa, avg(b) AS mb, stddev_pop(b) AS sb,
avg(ln(1 + price)) AS my, sum(area * ln(1 + price)) AS xa, sum(b * ln(1 + price)) AS xb, sum(area * b) AS ab
FROM (SELECT *, CAST(posted_month AS DOUBLE) AS b FROM ({_TRAIN}))"""
    scaled = f"""SELECT *, (xa - n * ma * my) / sa AS ya, (xb - n * mb * my) / sb AS yb, (ab - n * ma * mb) / (sa * sb) AS c,
n + 1.0::DOUBLE AS d FROM ({facts})"""
    solved = f"SELECT *, (ya * d - yb * c) / (d * d - c * c) AS wa, (yb * d - ya * c) / (d * d - c * c) AS wb FROM ({scaled})"
    return f"""SELECT row_id, round(my + (area - ma) / sa * wa + (CAST(posted_month AS DOUBLE) - mb) / sb * wb, 6) AS predicted_log
FROM ({_TEST}), ({solved})"""


@query("train_ridge", _ridge_sql())
def train_ridge(spark, sf):
    """Two numeric features, whose normal equations SQL can solve."""
    train, test = split_listings(spark, sf)
    spec = models.FeatureSpec({"area": 0.0, "posted_month": 0.0}, {}, {})
    scored = models.train_ridge(train, spec).predict(test.select("row_id", "area", "posted_month"), key="row_id")
    return scored.select("row_id", F.round(numbers.log_target(F.col("predicted_price")), 6).alias("predicted_log"))


def _baseline_sql(train: str, test: str) -> str:
    return f"""SELECT round(avg(abs(price - p)), 2) AS mae, round(sqrt(avg((price - p) * (price - p))), 2) AS rmse
FROM ({test}), (SELECT median(price) AS p FROM ({train}))"""


@query("compare_models", f"""SELECT m AS "Model", CASE WHEN m = 'Baseline_Median' THEN mae END AS baseline_mae,
CASE WHEN m = 'Baseline_Median' THEN rmse END AS baseline_rmse, true AS consistent
FROM ({_baseline_sql(_TRAIN, _TEST)}), (VALUES ('Random_Forest'), ('Ridge_Regression'), ('Baseline_Median')) AS v(m)""")
def compare_models(spark, sf):
    train, test = split_listings(spark, sf)
    table = cut_lineage(models.compare_models(train, test, trees=SMALL.trees, depth=SMALL.depth)[0], "metrics")
    base = F.col("Model") == metrics.BASELINE
    consistent = ((F.col("RMSE_VND") >= F.col("MAE_VND")) & (F.col("R2") <= 1) & (F.col("MAE_VND") / 1e9 == F.col("MAE_BILLION_VND"))
                  & (F.col("RMSE_VND") / 1e9 == F.col("RMSE_BILLION_VND")))
    return table.select("Model", F.when(base, F.round("MAE_VND", 2)).alias("baseline_mae"),
                        F.when(base, F.round("RMSE_VND", 2)).alias("baseline_rmse"), consistent.alias("consistent"))


@query("predict_batch", f"SELECT published_at, source, street_name, area, price, true AS consistent FROM ({CLEAN})")
def predict_batch(spark, sf):
    clean = cut_lineage(I.clean_listings(spark, sf), "clean")
    report = models.prediction_report(models.train_ridge(clean).predict(clean, key="row_id"))
    off = F.abs(F.col("price") - F.col("predicted_price"))
    consistent = (off == F.col("absolute_error")) & (off / 1e9 == F.col("absolute_error_billion")) & (F.col("predicted_price") >= 0)
    return report.select("published_at", "source", "street_name", "area", "price", consistent.alias("consistent"))


def same_prices(ours, theirs):
    """Rows with whether two tables of predictions agree."""
    other = theirs.select("row_id", F.col("predicted_price").alias("p"))
    return ours.join(other, "row_id", "full").select("row_id", "price", (F.col("predicted_price") == F.col("p")).alias("same"))


@query("save_load_model", f"SELECT row_id, price, true AS same FROM ({_TEST})")
def save_load_model(spark, sf):
    train, test = split_listings(spark, sf)
    path = scratch_path(spark, "model")
    model = models.train_ridge(train)
    model.save(path)
    return same_prices(models.PriceModel.load(spark, path).predict(test, key="row_id"), model.predict(test, key="row_id"))


@query("score_requests", f"""SELECT o_orderkey AS row_id, true AS band_holds, true AS texts_hold, round(mae / 1e6, 0) AS mae_millions
FROM orders, (SELECT "MAE_VND" AS mae FROM ({METRICS}) WHERE "Model" = 'Random_Forest')""")
def score_requests(spark, sf):
    clean = cut_lineage(I.clean_listings(spark, sf), "clean")
    table = outputs.pick_metrics(I.metrics_table(spark, sf))
    answers = scoring.score_requests(I.requests(spark, sf), models.train_ridge(clean), table)
    mae = table.select("MAE_VND").scalar()
    price, number = F.col("predicted_price"), lambda c: F.regexp_replace(c, "[^0-9.]", "").cast("double")
    band = (F.col("upper") == price + mae) & (F.col("lower") == F.greatest(price - mae, F.lit(0.0)))
    texts = (F.abs(number("price_vnd") - price) <= 0.5) & (F.abs(number("price_billion") * 1e9 - price) <= 5e7)
    return answers.select("row_id", band.alias("band_holds"), texts.alias("texts_hold"),
                          F.round(number("mae_vnd") / 1e6, 0).alias("mae_millions"))


# ---- streams ------------------------------------------------------------------------

@query("stream_ad_ingest", f"SELECT {', '.join(S.FLAT_AD_COLUMNS)} FROM ({D.flat_ads()})")
def stream_ad_ingest(spark, sf):
    """Pages land in four batches, newest ads first. The third brings each of its pages twice, the last
    every page again, with another price text: the first one stays."""
    pages = I.page_texts(spark, sf).select("page_id", "page")
    again = pages.withColumn("page", F.replace("page", F.lit('"price_string":"'), F.lit('"price_string":"later ')))
    landed, out, state = (scratch_path(spark, n) for n in ("pages", "ads", "state"))
    third = "page_id % 3 = 0"
    for batch in ([pages.where("page_id % 3 = 2")], [pages.where("page_id % 3 = 1")], [pages.where(third), again.where(third)], [again]):
        for part in batch:
            part.select(F.col("page").alias("value")).write.mode("append").text(landed)
        jobs.land_ads(jobs.read_page_stream(spark, landed), out, state, crawl_time=F.lit(I.CRAWL_TIME)).awaitTermination()
    return spark.read.parquet(out).select(*S.FLAT_AD_COLUMNS)


def listing_stream(spark, sf, columns):
    landed = scratch_path(spark, "landed")
    df = I.facts(spark, sf).select(*columns)
    df.write.parquet(landed)
    return spark.readStream.schema(df.schema).parquet(landed)


@query("stream_daily_coverage", f"SELECT CAST(published_at AS DATE) AS day, source, count(*) AS \"rows\" FROM ({FACTS}) GROUP BY 1, 2")
def stream_daily_coverage(spark, sf):
    out, state = scratch_path(spark, "daily"), scratch_path(spark, "state")
    counted = jobs.daily_coverage(listing_stream(spark, sf, ["published_at", "source"]))
    jobs.write_latest(counted, out, state).awaitTermination()
    return spark.read.parquet(out)


@query("stream_daily_coverage_append", f"""SELECT CAST(published_at AS DATE) AS day, source, count(*) AS "rows" FROM ({FACTS})
GROUP BY 1, 2 HAVING CAST(published_at AS DATE) + INTERVAL 2 DAY <= {_LAST}""".replace(
    "HAVING CAST(published_at AS DATE)", "HAVING day"))
def stream_daily_coverage_append(spark, sf):
    out, state = scratch_path(spark, "daily"), scratch_path(spark, "state")
    counted = jobs.daily_coverage(listing_stream(spark, sf, ["published_at", "source"]))
    jobs.write_stream(counted, out, state).awaitTermination()
    return spark.read.parquet(out)


@query("stream_daily_repair", f"SELECT CAST(published_at AS DATE) AS day, source, count(*) AS \"rows\" FROM ({FACTS}) GROUP BY 1, 2")
def stream_daily_repair(spark, sf):
    """Newest rows land first, so each batch but the first is late by months."""
    df = I.facts(spark, sf).select("row_id", "published_at", "source")
    landed, out, changes, state = (scratch_path(spark, n) for n in ("landed", "daily", "changes", "state"))
    for batch in ("row_id % 4 IN (2, 3)", "row_id % 4 = 0", "row_id % 4 = 1"):
        df.where(batch).write.mode("append").parquet(landed)
        arriving = spark.readStream.schema(df.schema).parquet(landed)
        jobs.land_daily_coverage(arriving, out, changes, state).awaitTermination()
    return spark.read.schema("source string, rows bigint, day date").parquet(out).select("day", "source", "rows")


@query("stream_scoring", f"SELECT row_id, price, true AS same FROM ({CLEAN})")
def stream_scoring(spark, sf):
    landed, out, state = (scratch_path(spark, n) for n in ("landed", "scored", "state"))
    clean = cut_lineage(I.clean_listings(spark, sf), path=landed)
    model = models.train_ridge(clean)
    arriving = spark.readStream.schema(clean.schema).parquet(landed)
    jobs.land_scores(arriving, model, out, state, key="row_id").awaitTermination()
    return same_prices(spark.read.parquet(out), model.predict(clean, key="row_id"))


# ---- whole runs ---------------------------------------------------------------------

def _sources(spark, sf):
    df = I.typed_standard(I.doubled(spark, sf))
    return [df.where(F.col("source") == s) for s in S.SOURCES]


_TWO = D.first_of(f"SELECT * FROM ({D.cleaned(D.typed_standard(DOUBLED))}) WHERE source <> 'mogi'",
                  S.DEDUPE_KEYS["merged"], D.LISTING_ORDER)


@query("prepare_two_sources", _TWO)
def prepare_two_sources(spark, sf):
    hf, chotot, _ = _sources(spark, sf)
    return runs.merge_run(hf, chotot, "prepare")


@query("prepare_three_sources", D.first_of(D.cleaned(D.typed_standard(DOUBLED)), S.DEDUPE_KEYS["merged"], D.LISTING_ORDER))
def prepare_three_sources(spark, sf):
    return runs.prepare_three_sources(*_sources(spark, sf))


def run_facts(result):
    """What SQL can say about a run: its split, its sides, and the exact errors of the baseline."""
    summary = result.summary.select(
        "split_strategy", "train_rows", "test_rows", "train_start", "train_end", "test_start", "test_end",
        *[F.array_join(F.transform(F.array_sort(F.map_entries(f"{side}_source_distribution")), lambda e: F.concat(
            e["key"], F.lit("="), e["value"].cast("string"))), ",").alias(f"{side}_sources") for side in ("train", "test")])
    base = result.metrics.where(F.col("Model") == metrics.BASELINE).select(
        F.struct(F.round("MAE_VND", 0).alias("mae"), F.round("RMSE_VND", 0).alias("rmse")).alias("b")).scalar()
    reported = result.predictions.agg(F.count("*").alias("n")).scalar()
    return summary.withColumns({"baseline_mae": base["mae"], "baseline_rmse": base["rmse"], "reported": reported})


def _run_sql(table: str, train: str, test: str, label: str, with_source: bool = True) -> str:
    side = lambda name, cond: (
        f"SELECT count(*) AS {name}_rows, min(published_at) AS {name}_start, max(published_at) AS {name}_end FROM t WHERE {cond}")
    sources = lambda cond: (
        f"(SELECT coalesce(string_agg(source || '=' || c, ',' ORDER BY source), '') FROM (SELECT source, count(*) AS c FROM t WHERE {cond} "
        "AND source IS NOT NULL GROUP BY source))") if with_source else "''"
    rows = f"SELECT *, row_number() OVER (ORDER BY published_at, row_id) AS pos, count(*) OVER () AS n, max(published_at) OVER () AS last FROM ({table})"
    base = _baseline_sql(f"SELECT * FROM t WHERE {train}", f"SELECT * FROM t WHERE {test}").replace(", 2)", ", 0)")
    return (f"WITH t AS ({rows}) SELECT {label} AS split_strategy, *, test_rows AS reported, {sources(train)} AS train_sources, "
            f"{sources(test)} AS test_sources FROM ({side('train', train)}), ({side('test', test)}), "
            f"(SELECT mae AS baseline_mae, rmse AS baseline_rmse FROM ({base}))")


_NONE = "CAST(NULL AS VARCHAR)"
_THREE = " UNION ALL BY NAME ".join([
    f"SELECT {COMMON}, row_id FROM ({D.raw_standard()}) WHERE source = 'huggingface'",
    f"SELECT {COMMON}, 0 AS row_id FROM ({D.ads_standard()})",
    f"SELECT {COMMON}, 0 AS row_id FROM ({ragged_sql()})"])


@query("three_source_run", _run_sql(
    D.first_of(D.cleaned(f"SELECT * FROM ({_THREE})"), S.DEDUPE_KEYS["merged"], D.LISTING_ORDER),
    "published_at < TIMESTAMP '2000-01-01'", "published_at >= TIMESTAMP '2000-01-01' AND published_at < TIMESTAMP '2002-01-01'",
    "'fixed_train_1990-01-01_to_1999-12-31__test_2000-01-01_to_2001-12-31'"))
def three_source_run(spark, sf):
    landed = I.raw_columns(I.raw(spark, sf)).where(F.col("source") == "huggingface")
    hf = runs.std.standardize(landed, "huggingface")
    return run_facts(runs.three_source_run(
        spark, hf, I.ads_csv(spark, sf), I.ragged_csv(spark, sf), scratch_path(spark, "run"), settings=SMALL,
        train_start="1990-01-01", train_end="1999-12-31", test_start="2000-01-01", test_end="2001-12-31"))


def _run(name, mode, split, sql):
    @query(name, sql)
    def run(spark, sf):
        hf, chotot, _ = _sources(spark, sf)
        return run_facts(runs.merge_run(hf, chotot, mode, split, settings=SMALL))


_CLEAN_TWICE = D.cleaned(D.typed_standard(DOUBLED))
_MONTH_OF = "date_trunc('month', last)"
_MONTH_LABEL = "'latest_month_' || (SELECT strftime(max(published_at), '%Y-%m') FROM t)"
_run("hf_only_run", "hf_only", "chronological", _run_sql(
    f"SELECT * FROM ({_CLEAN_TWICE}) WHERE source = 'huggingface'", f"pos <= {_CUT}", f"pos > {_CUT}", "'chronological_last_20%'"))
_run("external_run", "external", "latest_month", _run_sql(
    f"SELECT * FROM ({_CLEAN_TWICE}) WHERE source <> 'mogi'", "source = 'huggingface'", "source = 'chotot'", "'external_test_hf_train_chotot_test'"))
_run("merged_run", "merged", "latest_month", _run_sql(_TWO, f"published_at < {_MONTH_OF}", f"published_at >= {_MONTH_OF}", _MONTH_LABEL))


@query("single_source_run", _run_sql(
    f"SELECT row_id, published_at, price, {_NONE} AS source FROM ({LISTINGS}) WHERE {D.KEEP}", f"pos <= {_CUT}", f"pos > {_CUT}",
    "'chronological_last_20%'", with_source=False))
def single_source_run(spark, sf):
    landed = I.listings(spark, sf).drop("source")
    return run_facts(runs.single_source_run(landed, split="chronological", settings=SMALL))


@query("prepare_single_source", f"""SELECT row_id, district_name, house_direction,
coalesce(nullif(balcony_direction, 'nan'), 'Unknown') AS balcony_direction,
price, price / area AS price_per_m2 FROM ({LISTINGS}) WHERE {D.KEEP}""")
def prepare_single_source(spark, sf):
    clean = runs.prepare_single_source(I.listings(spark, sf))
    return clean.select("row_id", "district_name", "house_direction", "balcony_direction", "price", "price_per_m2")
