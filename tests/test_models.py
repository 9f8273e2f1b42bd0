import numpy as np
import pytest
from pyspark.sql import functions as F

from homeledger import schema as S
from homeledger.operators import features, metrics, models, scoring
from homeledger.sources import outputs


@pytest.fixture(scope="module")
def train(spark):
    """Price linear in area and district on the log scale, with rare streets."""
    df = spark.range(600).select(
        F.col("id").alias("row_id"),
        (20 + (F.col("id") * 37) % 100).cast("double").alias("area"),
        F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 9).cast("double")).alias("floor_count"),
        F.lit(None).cast("double").alias("frontage_width"), F.lit(None).cast("double").alias("house_depth"),
        (1 + F.col("id") % 3).cast("double").alias("road_width"), (1 + F.col("id") % 4).cast("double").alias("bedroom_count"),
        F.lit(2.0).alias("bathroom_count"), F.lit(2026).alias("posted_year"), (1 + F.col("id") % 6).cast("int").alias("posted_month"),
        (1 + F.col("id") % 28).cast("int").alias("posted_day"), (F.col("id") % 7).cast("int").alias("posted_dayofweek"),
        F.lit(S.APARTMENT).alias("property_type_name"), F.lit(S.HCMC).alias("province_name"),
        F.concat(F.lit("d"), F.col("id") % 5).alias("district_name"), F.lit("w").alias("ward_name"),
        # 20 rows of one street, 19 of another
        F.when(F.col("id") < 20, "s20").when(F.col("id") < 39, "s19").otherwise("main").alias("street_name"),
        F.lit("Unknown").alias("project_name"), F.lit("Nam").alias("house_direction"), F.lit("Unknown").alias("balcony_direction"),
        F.lit("2026-01-01").cast("timestamp_ntz").alias("published_at"), F.lit("mogi").alias("source"))
    log = 20 + F.col("area") / 100 + F.substring("district_name", 2, 1).cast("int") * 0.3 + (F.col("row_id") % 11) / 50
    return df.withColumn("price", F.expm1(log))


@pytest.fixture(scope="module")
def ridge(train):
    return models.train_ridge(train)


def test_feature_spec(train):
    spec = models.fit_features(train)
    assert "house_depth" not in spec.numeric and len(spec.numeric) == 9
    slots = {(r["feature"], r["category"]): r["slot"] for r in spec.categories.collect()}
    assert {c: n for (f, c), n in slots.items() if f == "street_name"} == {"main": 0, "s20": 1, "s19": 2}
    assert spec.slots["street_name"] == 3 and spec.slots["ward_name"] == 1
    assert {c: n for (f, c), n in slots.items() if f == "district_name"} == {f"d{i}": i for i in range(5)}
    assert spec.width == 9 + 3 + 5 + 6


def test_rare_and_unseen_categories(train, ridge):
    spec = ridge.spec
    rows = train.where("row_id in (0, 25, 50)").withColumn(
        "street_name", F.when(F.col("row_id") == 50, "new street").otherwise(F.col("street_name")))
    ready = models.prepare_features(rows, spec, keep=["row_id"])
    assert {r["row_id"]: r["i_street_name"] for r in ready.collect()} == {0: 1.0, 25: 2.0, 50: 3.0}
    stages = models.Pipeline(stages=models.encoding_stages(spec)).fit(models.training_frame(train, spec))
    hot = {r["row_id"]: r["h_street_name"].toArray().tolist() for r in stages.transform(ready).select("row_id", "h_street_name").collect()}
    assert hot == {0: [0.0, 1.0, 0.0], 25: [0.0, 0.0, 1.0], 50: [0.0, 0.0, 0.0]}
    keyed = models.prepare_features(rows, spec, keep=["row_id"], key="row_id")
    assert sorted(keyed.collect()) == sorted(ready.collect())


def test_many_categories_and_a_hot_one(spark):
    """6000 frequent categories, and one on a third of the rows."""
    df = spark.range(180_000).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("c%04d", F.col("id") % 6000)).alias("category"))
    df = df.union(spark.range(180_000, 180_500).select("id", F.lit("unseen")))
    names = ["hot", *(f"c{i:04d}" for i in range(6000) if i % 3)]
    table = spark.createDataFrame([("street_name", c, i) for i, c in enumerate(names)], "feature string, category string, slot int")
    spec = models.FeatureSpec({}, {"street_name": "hot"}, {"street_name": len(names)}, table)
    rows = df.withColumnRenamed("category", "street_name")
    got = models.category_slots(rows, spec, "row_id").join(df, "row_id").groupBy("category", "i_street_name").count().collect()
    want = {c: float(i) for i, c in enumerate(names)} | {"unseen": float(len(names))}
    assert {r["category"]: r["i_street_name"] for r in got} == want and sum(r["count"] for r in got) == 180_500


def test_the_exact_solver_refuses_what_it_cannot_take(train, monkeypatch):
    monkeypatch.setattr(models, "NORMAL_SOLVER_WIDTH", 5)
    with pytest.raises(ValueError, match="l-bfgs"):
        models.train_ridge(train)


def test_ridge_is_the_closed_form(train, ridge):
    frame = models.training_frame(train, ridge.spec)
    rows = ridge.stages.transform(frame).select("raw_features", "label", "prediction").collect()
    x = np.array([r["raw_features"].toArray() for r in rows])
    y = np.array([r["label"] for r in rows])
    scale = x.std(axis=0)
    x = x / np.where(scale == 0, 1, scale)
    centred, target = x - x.mean(axis=0), y - y.mean()
    w = np.linalg.solve(centred.T @ centred + np.eye(x.shape[1]), centred.T @ target)
    want = y.mean() + centred @ w
    assert np.allclose([r["prediction"] for r in rows], want, rtol=0, atol=1e-7)


def test_ridge_reads_its_frame_twice_and_builds_no_vector_to_score(spark, train, ridge):
    """One pass for the deviations of the label, one for the normal equation; none for scaling or for errors nobody asked for."""
    frame = models.training_frame(train, ridge.spec)
    spark.sparkContext.setJobGroup("ridge", "jobs of one fit")
    models.train_ridge(train, ridge.spec, frame=frame)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("ridge")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 4, jobs  # an aggregate is two jobs; the schema of the vector one
    ready = models.prepare_features(train, ridge.spec, ["row_id"])
    ready = ready.unionByName(ready.withColumns({"row_id": F.lit(-1).cast("bigint"), "i_street_name": F.lit(3.0)}).limit(1))
    plan = ridge.score(ready, ["row_id"])._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan
    ours = {r[0]: r[1] for r in ridge.score(ready, ["row_id"]).collect()}
    theirs = {r[0]: np.expm1(r[1]) for r in ridge.stages.transform(ready).select("row_id", "prediction").collect()}
    assert len(ours) == 601 and all(ours[k] == pytest.approx(theirs[k], rel=1e-12) for k in theirs)


def test_both_solvers_find_the_same_ridge(train, ridge):
    other = models.train_ridge(train, ridge.spec, solver="l-bfgs")
    a, b = ({r[0]: r[1] for r in m.predict(train).select("row_id", "predicted_price").collect()} for m in (ridge, other))
    assert all(a[k] == pytest.approx(b[k], rel=1e-4) for k in a)


def test_forest_beats_the_baseline(train):
    table, fitted = models.compare_models(train, train, trees=5, depth=6)
    mae = {r["Model"]: r["MAE_VND"] for r in table.collect()}
    assert set(mae) == {"Random_Forest", "Ridge_Regression", "Baseline_Median"}
    assert mae["Random_Forest"] < mae["Baseline_Median"] and mae["Ridge_Regression"] < mae["Baseline_Median"]
    assert [r["Model"] for r in table.collect()][-1] == "Baseline_Median" and set(fitted) == {"Random_Forest", "Ridge_Regression"}


def test_forest_rows_are_dealt_by_their_size_in_memory(spark, train, ridge, monkeypatch):
    """A frame packed into one small file is one part as it is read, whatever its rows take once encoded."""
    monkeypatch.setattr(models, "SPREAD_BYTES", 1000)
    frame = spark.read.parquet(models.cut_lineage(models.training_frame(train, ridge.spec).coalesce(1)).inputFiles()[0])
    rows = frame.count()
    monkeypatch.setattr(models, "FOREST_PART_BYTES", rows * (4 * (ridge.spec.width + 5) + 100) // 7)
    dealt = models.spread(frame, ridge.spec, 5).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in dealt) == rows and max(r["count"] for r in dealt) <= rows // 6
    model = models.train_random_forest(train, ridge.spec, trees=5, depth=6, frame=frame)
    assert model.score(frame, ["label"]).where("predicted_price >= 0").count() == rows
    monkeypatch.setattr(models, "SPREAD_BYTES", 1 << 40)
    assert models.spread(frame, ridge.spec, 5) is frame


def test_training_frames_have_files_of_few_rows(train, ridge, monkeypatch):
    """A narrow table of millions of rows may fit one file and one task."""
    monkeypatch.setattr(models, "ROWS_PER_FILE", 50)
    frame = models.training_frame(train.coalesce(1), ridge.spec)
    per_file = frame.groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 1 and max(r["count"] for r in per_file) <= 50


def test_save_and_load(spark, train, ridge, tmp_path):
    ridge.save(str(tmp_path / "m"))
    again = models.PriceModel.load(spark, str(tmp_path / "m"))
    rows = train.where("row_id < 60")
    a, b = (sorted(m.predict(rows).select("row_id", "predicted_price").collect()) for m in (ridge, again))
    assert a == b and again.name == "Ridge_Regression"
    with pytest.raises(FileNotFoundError):
        models.PriceModel.load(spark, str(tmp_path / "nothing"))


def test_leaked_feature_is_refused():
    with pytest.raises(ValueError):
        models.leakage_guard(["area", "price_per_m2"])


FORMS = [  # the four documented form inputs
    ("70", "2", "2", "15", "Hồ Chí Minh", "7", "Tân Phong", "Sunrise City", "2026", "5", "1"),
    ("55", "1", "1", "12", "Hồ Chí Minh", "Bình Thạnh", "22", "Vinhomes Central Park", "2026", "5", "5"),
    ("85", "3", "2", "20", "Hồ Chí Minh", "Thủ Đức", "An Phú", "Masteri An Phú", "2026", "5", "10"),
    ("120", "4", "3", "30", "TP.HCM", "Q.1", "Phường Bến Nghé", "The Marq", "2026", "5", "25"),
    ("", "x", None, "1", None, "", None, "", "2026", "2", "30"),
]
FORM_COLUMNS = ["area", "bedrooms", "bathrooms", "floor_count", "province", "district", "ward", "project_name",
                "published_year", "published_month", "published_day"]


def test_form_requests(spark, ridge):
    forms = spark.createDataFrame(FORMS, ", ".join(f"{c} string" for c in FORM_COLUMNS))
    rows = scoring.request_features(forms).collect()
    assert [r["posted_dayofweek"] for r in rows] == [4, 1, 6, 0, 0]
    assert (rows[3]["province_name"], rows[3]["district_name"], rows[3]["ward_name"]) == ("Hồ Chí Minh", "1", "Bến Nghé")
    last = rows[4]
    assert last["area"] is None and last["bedroom_count"] is None and last["district_name"] == "Unknown"
    assert last["property_type_name"] == S.APARTMENT and last["province_name"] == "Hồ Chí Minh"

    table = spark.createDataFrame([("Ridge_Regression", 1.0, 2.0, 0.5, 0.0, 0.0), ("Random_Forest", 2e8, 3e8, 0.71249, 0.2, 0.3)],
                                  "Model string, MAE_VND double, RMSE_VND double, R2 double, MAE_BILLION_VND double, RMSE_BILLION_VND double")
    answers = scoring.score_requests(forms, ridge, outputs.pick_metrics(table)).collect()
    assert len(answers) == 5
    for a in answers:
        assert a["r2"] == "0.712" and a["mae_vnd"] == "200,000,000 VND"
        assert a["upper"] - a["predicted_price"] == pytest.approx(2e8) and a["lower"] >= 0
    bare = scoring.score_requests(forms, ridge).first()
    assert bare["lower_text"] is None and bare["price_billion"].endswith("tỷ VNĐ")


def test_cli_requests_are_taken_as_they_are(spark):
    df = spark.createDataFrame([(70.0, "Q.1", 3)], "area double, district string, published_dayofweek int")
    r = scoring.request_features(df, "cli").first()
    assert (r["district_name"], r["posted_dayofweek"], r["area"]) == ("Q.1", 3, 70.0)


def test_prediction_report_columns(train, ridge):
    report = models.prediction_report(ridge.predict(train.where("row_id < 5")))
    assert report.columns[-3:] == ["predicted_price", "absolute_error", "absolute_error_billion"] and len(report.columns) == 15
    assert "source" not in models.prediction_report(ridge.predict(train), with_source=False).columns


def test_baseline_uses_the_train_median(train):
    out = metrics.baseline_median(train, train).select("predicted_price").distinct().collect()
    assert len(out) == 1
