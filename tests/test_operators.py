import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from homeledger import schema as S
from homeledger.operators import (charts, cleaning, coverage, dedupe, features, legacy, metrics, ranking, selection,
                                  splits, standardize as std)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def days(spark, stamps, **more):
    rows = [(i, s, *[v[i] for v in more.values()]) for i, s in enumerate(stamps)]
    cols = "row_id long, t string" + "".join(f", {c} string" for c in more)
    df = spark.createDataFrame(rows, cols)
    return df.withColumn("published_at", F.col("t").cast("timestamp_ntz")).drop("t")


# ---- exact order statistics ---------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 6, 7, 300, 4001])
def test_exact_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    # one group is hot and full of ties, one is continuous, one has nulls
    groups = {"hot": rng.integers(0, 5, n * 3).astype(float), "wide": rng.normal(0, 1e9, n), "gaps": rng.random(n)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("gaps", None)] * n + [("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    got = {(r["g"], r["prob"]): r["quantile"] for r in selection.exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert {g for g, _ in got} == set(groups)
    for g, vs in groups.items():
        for p in probs:
            assert got[g, p] == pytest.approx(np.quantile(vs, p), rel=1e-12, abs=1e-12), (g, p)


@pytest.mark.parametrize("values", [
    [1.5] * 900 + [2.5], [0.0, -0.0, 1.0] * 50, [1e308, -1e308, 5e-324, -5e-324, 0.0, float("inf"), float("-inf")] * 9,
    [1.0 + i * 2.0 ** -52 for i in range(300)], [10.0 ** (i - 150) for i in range(300)], [-(1.01 ** i) for i in range(999)]])
def test_quantiles_of_hot_and_extreme_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(3)
    ranks = [i / (len(values) - 1) for i in (0, len(values) // 3, len(values) // 2, len(values) - 2, len(values) - 1)]
    got = [r["value"] for r in selection._at_ranks(
        df, "v", F.array(*[F.lit(round(p * (len(values) - 1))).cast("bigint") for p in ranks]), [], True, "double").orderBy("k").collect()]
    assert got == sorted({round(p * (len(values) - 1)): sorted(values)[round(p * (len(values) - 1))] for p in ranks}.values())


def test_quantiles_of_many_groups_with_a_hot_one(spark):
    rows = [("hot", float(i % 977)) for i in range(6000)] + [(f"g{i}", float(i * j)) for i in range(40) for j in range(5)]
    df = spark.createDataFrame(rows, "g string, v double")
    for few in (True, False):
        got = {(r["g"], r["prob"]): r["quantile"] for r in selection.exact_quantiles(df, "v", [0.3, 0.5], ["g"], few).collect()}
        for g in {g for g, _ in rows}:
            for p in (0.3, 0.5):
                assert got[g, p] == pytest.approx(np.quantile([v for h, v in rows if h == g], p), rel=1e-12)


def test_no_exchange_to_one_task_carries_more_than_bins(spark):
    data = spark.range(100_000).select((F.col("id") * 1.5).alias("_v"))
    state = spark.createDataFrame([(0.0, 149_998.5, 0, 100_000, 100_000, [50_000])], selection._STATE.format("double"))
    out = selection._pass(data, state, [], True, "double")
    assert out.count() == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "partial_count" in plan and "ObjectHashAggregate" not in plan


def test_median_on_many_rows(spark):
    df = spark.range(0, 400_000, 1, 8).select((F.pmod(F.xxhash64("id"), F.lit(10**9)) / 7).alias("v"))
    got = selection.exact_median(df, "v").first()["median"]
    assert got == pytest.approx(df.agg(F.median("v")).first()[0], rel=1e-15)


@pytest.mark.parametrize("slack", [0.004, -0.2])
def test_sketches_choose_brackets_and_a_miss_is_made_good(spark, monkeypatch, slack):
    """With a slack below zero the brackets are empty, so every rank is sought from the whole range."""
    monkeypatch.setattr(selection, "SLACK", slack)
    scans = []
    whole = selection._pass
    monkeypatch.setattr(selection, "_pass", lambda data, *rest: scans.append("_c" in data.columns) or whole(data, *rest))
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.lognormal(21, 1, 30_000), np.full(15_000, 2.5e9), rng.integers(-9, 9, 5000)])
    df = spark.createDataFrame([("a" if i % 3 else "b", float(v)) for i, v in enumerate(values)], "g string, v double").repartition(6)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["prob"]: r["quantile"] for r in selection.exact_quantiles(df, "v", probs).collect()}
    assert got == {p: pytest.approx(np.quantile(values, p), rel=1e-12) for p in probs}
    assert set(scans) <= {slack > 0}  # all values are never read again once a bracket holds the rank
    by = {(r["g"], r["prob"]): r["quantile"] for r in selection.exact_quantiles(df, "v", probs, ["g"], few_groups=True).collect()}
    for g, own in (("a", values[np.arange(len(values)) % 3 > 0]), ("b", values[::3])):
        assert {p: by[g, p] for p in probs} == {p: pytest.approx(np.quantile(own, p), rel=1e-12) for p in probs}


def test_brackets_are_narrow(spark):
    data = spark.range(0, 200_000, 1, 6).select(F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("double").alias("_v"))
    (one,) = selection._brackets(data, F.array(F.lit(100_000).cast("bigint")), [], "double")
    assert 0 < data.where(F.col("_v").between(one["lo"], one["hi"])).count() < 4000


def test_median_of_nothing(spark):
    assert selection.exact_median(spark.createDataFrame([], "v double"), "v").first()["median"] is None


def test_kth_value_and_first_rows(spark):
    keys = [2**60 + 3 * i for i in range(1000)]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "k long").repartition(5)
    at = selection.kth_value(df, "k", 700, 1000).first()
    assert (at["value"], at["below"]) == (keys[699], 699)
    assert sorted(r["k"] for r in selection.first_rows(df, "k", 10).collect()) == keys[:10]
    assert selection.first_rows(df, "k", 5000).count() == 1000
    with pytest.raises(ValueError):
        selection.kth_value(df, "k", 0, 10)


def test_rank_of_a_hot_day(spark):
    stamps = ["2026-01-02"] * 500 + ["2026-01-01"] * 20 + ["2026-01-03"] * 30
    df = days(spark, stamps).repartition(4)
    got = ranking.chronological_rank(df).collect()
    want = sorted((r["published_at"], r["row_id"]) for r in got)
    assert [(r["published_at"], r["row_id"]) for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(1, 551))


# ---- duplicates ---------------------------------------------------------------------

def duplicates(spark):
    rows = [(1, "a", 1.0, None, "2026-01-02"), (2, "a", 1.0, None, "2026-01-01"), (3, "a", None, None, "2026-01-01"),
            (4, "a", None, None, None), (5, "b", 1.0, "x", None), (6, "b", 1.0, "x", None)]
    df = spark.createDataFrame(rows, "row_id long, name string, price double, ward_name string, t string")
    return df.withColumn("published_at", F.col("t").cast("timestamp_ntz")).drop("t").withColumn("source", F.lit("mogi"))


@pytest.mark.parametrize("parts", [1, 3, 7])
@pytest.mark.parametrize("keep", [dedupe.keep_first, dedupe.first_per_key])
def test_keep_first_is_null_safe_and_stable(spark, parts, keep):
    df = duplicates(spark).repartition(parts)
    out = keep(df, ["name", "price", "ward_name"])
    assert out.columns == df.columns
    # a null time sorts first, as in a struct comparison and an ascending window
    assert sorted(r["row_id"] for r in out.collect()) == [2, 4, 5]


def test_duplicates_removed(spark):
    row = dedupe.duplicates_removed(duplicates(spark), ["name", "price", "ward_name"]).first()
    assert (row["rows_before"], row["rows_after"], row["removed"]) == (6, 3, 3)


def test_keep_first_is_partial_and_window_limits_before_the_shuffle(spark):
    df = duplicates(spark)
    assert "partial_min_by" in plan(dedupe.keep_first(df, ["name", "price"]))
    assert "WindowGroupLimit" in plan(dedupe.first_per_key(df, ["name", "price"]))


# ---- cleaning -----------------------------------------------------------------------

def test_clean_for_model_bounds_and_funnel(spark):
    rows = [(1e8, 10.0, "2026-01-01"), (1e11, 500.0, "2026-01-01"), (99e6, 10.0, "2026-01-01"), (1e9, 9.9, "2026-01-01"),
            (1e9, 500.5, "2026-01-01"), (1e8, 30.0, "2026-01-01"), (1e11, 50.0, "2026-01-01"), (None, 50.0, "2026-01-01"),
            (1e9, None, "2026-01-01"), (1e9, 50.0, None), (1e9, 0.0, "2026-01-01")]
    df = spark.createDataFrame(rows, "price double, area double, t string")
    df = df.withColumn("published_at", F.col("t").cast("timestamp_ntz"))
    kept = sorted((r["price"], r["area"]) for r in cleaning.clean_for_model(df).collect())
    assert kept == [(1e8, 10.0), (1e11, 500.0)]
    funnel = {r["step"]: r["rows"] for r in cleaning.cleaning_funnel(df).collect()}
    assert funnel == {"input": 11, "required": 8, "price": 7, "area": 4, "price_per_m2": 2}


def test_filters_reach_the_scan_and_columns_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).select(
        F.lit("x").alias("description"), F.col("id").cast("double").alias("price"), F.lit(20.0).alias("area"),
        F.lit("2026-01-01").cast("timestamp_ntz").alias("published_at"))
    df.write.parquet(path)
    clean = cleaning.clean_for_model(spark.read.parquet(path)).select("price")
    text = plan(clean)
    assert "GreaterThanOrEqual(price,1.0E8)" in text
    assert "description" not in text.split("ReadSchema")[-1]


def test_text_price_is_parsed_once(spark):
    df = spark.createDataFrame([("1", "2 tỷ", "50 m2", "2026-01-01")], "name string, price string, area string, published_at string")
    clean = cleaning.clean_for_model(std.standardize(df, "huggingface"))
    physical = clean._jdf.queryExecution().executedPlan().toString()
    assert physical.count("tỷ(.*)") <= 2  # one pattern for the billions, one for what follows
    assert clean.first()["price"] == 2e9


def test_standardize_twice_changes_nothing(spark):
    rows = [(" A  b ", "TPHCM", "Quận 2 (x)", "Phường 3", "5.0", "2 tỷ", "50 m2", "3", "2026-01-05")]
    df = spark.createDataFrame(rows, "name string, province_name string, district_name string, ward_name string, "
                                     "house_direction string, price string, area string, bedroom_count string, published_at string")
    once = std.standardize(df, "chotot")
    assert once.columns == S.COMMON_COLUMNS
    assert once.collect() == std.standardize(once, "chotot").collect()
    assert [f.dataType for f in once.schema] == [S.common_type(c) for c in S.COMMON_COLUMNS]


def test_day_first_follows_the_source(spark):
    df = spark.createDataFrame([("05/12/2025",)], "published_at string")
    assert std.standardize(df, "mogi").first()["published_at"] == dt.datetime(2025, 12, 5)
    assert std.standardize(df, "chotot").first()["published_at"] == dt.datetime(2025, 5, 12)


# ---- splits -------------------------------------------------------------------------

def test_fixed_range_is_inclusive_to_the_last_second(spark):
    df = days(spark, ["2026-01-01", "2026-01-31 23:59:59", "2026-01-31 23:59:59.5", "2026-02-01"])
    train, test, label = splits.split_fixed_range(df, "2026-01-01", "2026-01-31", "2026-02-01", "2026-02-28")
    assert [r["row_id"] for r in train.orderBy("row_id").collect()] == [0, 1]
    assert [r["row_id"] for r in test.collect()] == [3]
    assert label == "fixed_train_2026-01-01_to_2026-01-31__test_2026-02-01_to_2026-02-28"


def test_empty_sides_fail(spark):
    df = days(spark, ["2026-01-01", "2026-01-02"], source=["mogi", "mogi"])
    for split in (splits.split_latest_month, splits.split_external, lambda d: splits.split_chronological(d, 0.9),
                  lambda d: splits.split_fixed_range(d, "2020-01-01", "2020-01-02", "2026-01-01", "2026-01-02")):
        with pytest.raises(ValueError):
            split(df)


@pytest.mark.parametrize("test_size", [0.2, 0.35, 0.5])
def test_chronological_split_of_ties(spark, test_size):
    stamps = ["2026-01-02"] * 70 + ["2026-01-01"] * 10 + [None] * 5 + ["2026-01-03"] * 15
    df = days(spark, stamps).repartition(4)
    train, test, _ = splits.split_chronological(df, test_size)
    order = sorted(range(100), key=lambda i: (stamps[i] is None, stamps[i] or "", i))
    cut = int(100 * (1 - test_size))
    assert sorted(r["row_id"] for r in train.collect()) == sorted(order[:cut])
    assert sorted(r["row_id"] for r in test.collect()) == sorted(order[cut:])


def test_chronological_cut_truncates():
    assert splits.chronological_cut(10, 0.9) == 0
    assert splits.chronological_cut(10, 0.2) == 8


def test_auto_split_falls_back(spark):
    many = ["2026-01-01"] * 30 + ["2026-02-01"] * 10
    assert splits.split_auto(days(spark, many), min_train=5, min_test=5)[2] == "latest_month_2026-02"
    few = ["2026-01-01"] * 30 + ["2026-01-02"] * 10
    assert splits.split_auto(days(spark, few), min_train=5, min_test=5)[2] == "latest_day_2026-01-02"
    assert splits.split_auto(days(spark, few), min_train=5, min_test=20)[2] == "chronological_last_20%"


def test_split_warns_when_small():
    with pytest.warns(UserWarning):
        assert len(splits.check_split(3, 3, min_train=5, min_test=5)) == 2


# ---- reports ------------------------------------------------------------------------

def test_histogram_edges(spark):
    one = charts.histogram(spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double"), "v").orderBy("bin").collect()
    assert len(one) == 50 and one[0]["low"] == 4.5 and one[-1]["high"] == pytest.approx(5.5)
    assert [r["bin"] for r in one if r["rows"]] == [26]
    many = charts.histogram(spark.createDataFrame([(float(i),) for i in range(101)], "v double"), "v").orderBy("bin").collect()
    assert many[-1]["rows"] == 3 and sum(r["rows"] for r in many) == 101


def test_boxplot_whiskers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 40.0]
    df = spark.createDataFrame([(None, v) for v in values], "district_name string, price_billion double")
    r = charts.boxplot_by_district(df).first()
    assert (r["district_name"], r["q1"], r["median"], r["q3"]) == ("nan", 2.0, 3.0, 4.0)
    assert (r["whisker_low"], r["whisker_high"], r["rows"]) == (1.0, 4.0, 5)


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "price double, predicted_price double")
    r = metrics.regression_metrics(df, "m").first()
    assert r["MAE_VND"] == 1.0 and r["RMSE_VND"] == pytest.approx((5 / 3) ** 0.5) and r["R2"] == pytest.approx(1 - 5 / 8)
    same = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "price double, predicted_price double")
    assert metrics.regression_metrics(same, "m").first()["R2"] == 1.0
    off = same.withColumn("predicted_price", F.lit(3.0))
    assert metrics.regression_metrics(off, "m").first()["R2"] == 0.0


def test_best_model_is_never_the_baseline(spark):
    def best(rows):
        return metrics.best_model(spark.createDataFrame(rows, "Model string, MAE_VND double")).first()[0]
    assert best([("Random_Forest", 3.0), ("Ridge_Regression", 2.0), ("Baseline_Median", 1.0)]) == "Random_Forest"
    assert best([("Random_Forest", 3.0), ("Ridge_Regression", 2.0), ("Baseline_Median", 9.0)]) == "Ridge_Regression"


def test_coverage_report_adds_up(spark):
    df = days(spark, ["2026-01-01", "2026-01-01 05:00:00", "2026-02-01", None])
    rows = {(r["section"], r["label"]): r["rows"] for r in coverage.coverage_report(df).collect()}
    assert rows == {("rows", "all"): 4, ("rows", "valid"): 3, ("month", "2026-01"): 2, ("month", "2026-02"): 1,
                    ("day", "2026-01-01"): 2, ("day", "2026-02-01"): 1}
    with pytest.raises(ValueError):
        coverage.coverage_report(df, "nothing")


def test_medians_drop_empty_features_and_modes_take_the_smallest(spark):
    df = spark.createDataFrame([(1.0, None, "b"), (2.0, None, "a"), (10.0, None, "b"), (3.0, None, "a")],
                               "area double, house_depth double, ward_name string")
    assert [tuple(r) for r in features.impute_median(df, ["area", "house_depth"]).collect()] == [("area", 2.5)]
    modes = features.impute_mode(features.category_counts(df, ["ward_name"]))
    assert [tuple(r) for r in modes.collect()] == [("ward_name", "a")]


def test_legacy_errors_and_aliases(spark):
    with pytest.raises(ValueError):
        legacy.legacy_clean(spark.createDataFrame([("1 tỷ",)], "Gia string"))
    with pytest.raises(ValueError):
        legacy.legacy_clean(spark.createDataFrame([("2026-01-01",)], "NgayDang string"))
    df = spark.createDataFrame(
        [("2026-01-01", "2 tỷ- 62 m2đ", "62 m²", "1, Quận 3"), ("2026-01-02", "3 tỷ", None, "Hà Nội"), ("2026-01-02", "3 tỷ", "5 m2", "x"),
         ("bad", "3 tỷ", "50", "x")], "created_at string, ` Gia ` string, DienTich string, DiaChi string")
    rows = legacy.legacy_clean(df).orderBy("NgayDang").collect()
    assert [(r["PriceVND"], r["AreaM2"], r["District"], r["PostedMonth"]) for r in rows] == [
        (2e9, 62.0, "Quận 3", 1), (3e9, None, None, 1)]
    assert legacy.prune_null_features(legacy.legacy_clean(df)) == (["AreaM2", "PostedYear", "PostedMonth"], ["District"])


def test_a_load_is_shuffled_once_into_the_buckets(spark, tmp_path):
    """The aggregate of a load deals it like the table, with as many buckets as the session has partitions; keys that differ
    by microseconds are two, zeros of either sign are one."""
    from homeledger.session import shared_dir
    rows = [(0.0, "2026-01-01 00:00:00.000001", 5), (-0.0, "2026-01-01 00:00:00.000001", 4), (0.0, "2026-01-01 00:00:00.000002", 3), (None, None, 2), (None, None, 1)]
    df = spark.createDataFrame(rows, "k double, t string, row_id int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    table = dedupe.FirstTable(spark, "first_dealt", f"{shared_dir(spark)}/first-{tmp_path.name}-dealt", ["k", "t"], ["row_id"], buckets=2)
    assert table.buckets == int(spark.conf.get("spark.sql.shuffle.partitions"))
    table.merge(df.where("row_id in (2, 3, 5)"))
    load = df.where("row_id in (1, 4)")
    assert table.joined(load)._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    got = sorted((str(r["k"]), str(r["t"])[-6:], r["row_id"]) for r in table.merge(load).collect())
    assert got == [("0.0", "000001", 4), ("0.0", "000002", 3), ("None", "None", 1)]


def test_first_rows_over_several_loads(spark, tmp_path):
    """Three loads equal one load, in any order of loads; the stored side is not shuffled."""
    from homeledger.session import shared_dir
    rows = [(k % 7 if k % 7 else None, "a" if k % 2 else None, k * 37 % 60, k) for k in range(60)]
    df = spark.createDataFrame(rows, "k int, s string, at int, row_id int")
    want = sorted(dedupe.keep_first(df, ["k", "s"], ["at", "row_id"]).collect(), key=str)
    for name, loads in (("one", [(40, 60), (0, 20), (20, 40)]), ("two", [(0, 1), (1, 60), (0, 60)])):
        table = dedupe.FirstTable(spark, f"first_{name}", f"{shared_dir(spark)}/first-{tmp_path.name}-{name}", ["k", "s"], ["at", "row_id"], buckets=4)
        for a, b in loads:
            part = df.where(F.col("row_id").between(a, b - 1))
            if table.version:
                plan = table.joined(part)._jdf.queryExecution().executedPlan().toString()
                assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning(_key_digest") == 1
            got = table.merge(part)
        assert sorted(got.collect(), key=str) == want and got.columns == df.columns
