"""Price models: features, forest, ridge, comparison, saving.

The model learns ``log1p(price)``. Categories are a table of (feature, category, slot): its
length follows the data, so it is joined, never collected. The driver holds per feature one
median or mode and the number of slots, and the weights that Spark ML keeps there.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.ml.regression import (
    GeneralizedLinearRegression, GeneralizedLinearRegressionModel, LinearRegression, LinearRegressionModel)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from homeledger import schema as S
from homeledger.functions.numbers import abs_error, log_target, price_of_log
from homeledger.operators import features as feat
from homeledger.operators import forest
from homeledger.operators import metrics as M
from homeledger.operators.joins import attach
from homeledger.operators.ranking import chronological_rank
from homeledger.session import cut_lineage

BROADCAST_CATEGORIES = 200_000  # of all features; some ten megabytes
NORMAL_SOLVER_WIDTH = 4096  # Spark's limit for the exact solver
ROWS_PER_FILE = 500_000  # of a training frame: some ten megabytes
FOREST_PART_BYTES = 384 << 20  # of training rows that one task of the forest holds; each part sends statistics of all nodes
SPREAD_BYTES = 32 << 20  # fewer training rows than this stay in the parts they are read in
REPORT_COLUMNS = [
    "published_at", "source", "property_type_name", "province_name", "district_name",
    "ward_name", "street_name", "project_name", "area", "bedroom_count", "bathroom_count", "price",
]


def leakage_guard(columns: Sequence[str]) -> list[str]:
    """Fail if the target, or text that may state it, is among the features."""
    leaked = [c for c in columns if c in S.NEVER_FEATURES]
    if leaked:
        raise ValueError(f"columns that may not be features: {leaked}")
    return list(columns)


@dataclass
class FeatureSpec:
    """What the training rows say about each feature.

    ``slots`` counts the one-hot places of a categorical feature: one per frequent category in
    order of name, and a last one that all rare categories share, if there are any.
    """

    medians: dict[str, float]
    modes: dict[str, str]
    slots: dict[str, int]
    categories: DataFrame | None = field(default=None, repr=False)  # feature, category, slot

    @property
    def numeric(self) -> list[str]:
        return [c for c in S.NUMERIC_FEATURES if c in self.medians]

    @property
    def categorical(self) -> list[str]:
        return [c for c in S.CATEGORICAL_FEATURES if c in self.modes]

    @cached_property
    def category_rows(self) -> int:
        """Known categories; the count of a written table."""
        return self.categories.count()

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(self.slots[c] for c in self.categorical)

    def to_json(self) -> str:
        return json.dumps({k: getattr(self, k) for k in ("medians", "modes", "slots")}, ensure_ascii=False)


def fit_features(train: DataFrame, min_frequency: int = feat.MIN_FREQUENCY) -> FeatureSpec:
    """Medians, modes and category slots from the training rows."""
    leakage_guard(S.NUMERIC_FEATURES + S.CATEGORICAL_FEATURES)
    # 11 and three times 8 rows come to the driver
    medians = {r["feature"]: r["median"] for r in feat.impute_median(train).collect()}
    counts = cut_lineage(feat.category_counts(train), "categories")
    modes = {r["feature"]: r["mode"] for r in feat.impute_mode(counts).collect()}
    frequent = F.col("rows") >= min_frequency
    ranked = chronological_rank(counts.where(frequent).select("feature", "category"), ("feature", "category"))
    begins = {r["feature"]: r["p"] for r in ranked.groupBy("feature").agg(F.min("position").alias("p")).collect()}
    sizes = {r["feature"]: r for r in counts.groupBy("feature").agg(
        F.count_if(frequent).alias("named"), F.count_if(~frequent).alias("rare")).collect()}

    def per_feature(values: dict[str, int]) -> Column:
        out = F.lit(0)
        for name, value in values.items():
            out = F.when(F.col("feature") == name, F.lit(value)).otherwise(out)
        return out

    named = ranked.select("feature", "category", (F.col("position") - per_feature(begins)).cast("int").alias("slot"))
    shared = counts.where(~frequent).select(
        "feature", "category", per_feature({f: r["named"] for f, r in sizes.items()}).cast("int").alias("slot"))
    return FeatureSpec(medians, modes, {f: r["named"] + (r["rare"] > 0) for f, r in sizes.items()},
                       cut_lineage(named.unionByName(shared), "slots"))


def category_slots(rows: DataFrame, spec: FeatureSpec, key: str) -> DataFrame:
    """(key, i_<feature> ...): the slot of each category; one past the last for an unseen one.

    One join on a narrow table for all features. Values that many rows share, seen in training
    or not, are told apart by their count in these rows and never meet in one task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c), F.lit(spec.modes[c])).alias("category"))
                      for c in spec.categorical])
    narrow = cut_lineage(rows.select(key, F.inline(pairs)), "narrow")
    values = narrow.groupBy("feature", "category").agg(F.count("*").alias("n"))
    facts = cut_lineage(values.join(spec.categories, ["feature", "category"], "left"), "facts")
    placed = attach(narrow, facts, ["feature", "category"], "n")
    return placed.groupBy(key).agg(*[
        F.coalesce(F.max(F.when(F.col("feature") == c, F.col("slot"))), F.lit(spec.slots[c])).cast("double").alias(f"i_{c}")
        for c in spec.categorical])


def with_slots(rows: DataFrame, spec: FeatureSpec) -> DataFrame:
    """``rows`` and an ``i_<feature>`` column for each category, by one broadcast table a feature: rows stay where they are."""
    for c in spec.categorical:
        table = spec.categories.where(F.col("feature") == c).select(F.col("category").alias("_category"), F.col("slot").alias("_slot"))
        rows = rows.join(F.broadcast(table), F.coalesce(F.col(c), F.lit(spec.modes[c])) == F.col("_category"), "left").withColumn(
            f"i_{c}", F.coalesce("_slot", F.lit(spec.slots[c])).cast("double")).drop("_category", "_slot")
    return rows


def prepare_features(df: DataFrame, spec: FeatureSpec, keep: Sequence[str] = (), key: str | None = None) -> DataFrame:
    """Imputed numbers in ``f_`` columns and category slots in ``i_`` columns beside the ``keep``
    columns. Up to ``BROADCAST_CATEGORIES`` known categories are broadcast; more are joined by a shuffle, for which ``key`` names
    a column without repeats or nulls; without one, the rows are written once with a number of their own."""
    wanted = list(dict.fromkeys([*keep, *spec.numeric, *spec.categorical, *([key] if key else [])]))
    rows = df.select(*wanted)
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(spec.medians[c])).alias(f"f_{c}") for c in spec.numeric]
    if spec.categorical and spec.category_rows <= BROADCAST_CATEGORIES:
        return with_slots(rows, spec).select(*keep, *numbers, *[f"i_{c}" for c in spec.categorical])
    if not key:
        key = "_row"
        rows = cut_lineage(rows.withColumn(key, F.monotonically_increasing_id()), "rows")
    if not spec.categorical:
        return rows.select(*keep, *numbers)
    slots = category_slots(rows, spec, key)
    return rows.join(slots, key).select(*keep, *numbers, *[f"i_{c}" for c in spec.categorical])


def encoding_stages(spec: FeatureSpec, output: str = "features", skip: Sequence[str] = ()) -> list:
    """One-hot and assemble. An unseen category is the dropped last place: all zero."""
    cats = [c for c in spec.categorical if c not in skip]
    hot = [OneHotEncoder(inputCols=[f"i_{c}" for c in cats], outputCols=[f"h_{c}" for c in cats], handleInvalid="keep", dropLast=True)]
    joined = VectorAssembler(inputCols=[f"f_{c}" for c in spec.numeric if c not in skip] + [f"h_{c}" for c in cats], outputCol=output)
    return [*(hot if cats else []), joined]


def linear_prediction(stages: PipelineModel) -> Column | None:
    """The prediction of a linear model behind ``encoding_stages`` as a column; None for another model.

    A weight a number and one weight a slot, looked up by place, instead of a vector built for each row. What has no
    weight, an unseen category, adds nothing.
    """
    model = stages.stages[-1]
    if not isinstance(model, (GeneralizedLinearRegressionModel, LinearRegressionModel)):
        return None
    places, weights = {}, iter(model.coefficients.toArray().tolist())
    for stage in stages.stages[:-1]:
        if isinstance(stage, OneHotEncoderModel):
            places |= {h: (i, int(n)) for h, i, n in zip(stage.getOutputCols(), stage.getInputCols(), stage.categorySizes)}
        elif not isinstance(stage, VectorAssembler):
            return None
    out = F.lit(float(model.intercept))
    for c in assembled(stages):
        if c in places:
            slot, n = places[c]
            known = F.array(*[F.lit(next(weights)) for _ in range(n)])
            out = out + F.coalesce(F.get(known, F.col(slot).cast("int")), F.lit(0.0))
        else:
            out = out + F.col(c) * F.lit(next(weights))
    return out


def assembled(stages: PipelineModel) -> list[str]:
    """The columns of the feature vector, in order."""
    return next(s.getInputCols() for s in stages.stages if isinstance(s, VectorAssembler))


@dataclass
class PriceModel:
    """A fitted model with the feature facts it was fitted on."""

    name: str
    spec: FeatureSpec
    stages: PipelineModel | forest.ForestModel

    def predict(self, df: DataFrame, floor: bool = True, key: str | None = None) -> DataFrame:
        """All columns of ``df`` and ``predicted_price``; ``key`` as for ``prepare_features``."""
        return self.score(prepare_features(df, self.spec, df.columns, key), df.columns, floor)

    def score(self, ready: DataFrame, keep: Sequence[str], floor: bool = True) -> DataFrame:
        """The same from prepared features; works on streams too."""
        linear = linear_prediction(self.stages) if isinstance(self.stages, PipelineModel) else None
        scored = ready.withColumn("prediction", linear) if linear is not None else self.stages.transform(ready)
        return scored.select(*keep, price_of_log(F.col("prediction"), floor).alias("predicted_price"))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        if own := isinstance(self.stages, forest.ForestModel):
            self.stages.save(f"{path}/forest")
        else:
            self.stages.write().overwrite().save(f"{path}/stages")
        self.spec.categories.write.mode("overwrite").parquet(f"{path}/categories")
        facts = spark.createDataFrame([(self.name, self.spec.to_json(), own)], "name string, spec string, forest boolean")
        facts.coalesce(1).write.mode("overwrite").json(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> PriceModel:
        try:
            facts = spark.read.schema("name string, spec string, forest boolean").json(f"{path}/facts").first()
        except AnalysisException as e:
            raise FileNotFoundError(f"no model at {path}") from e
        categories = spark.read.schema("feature string, category string, slot int").parquet(f"{path}/categories")
        spec = FeatureSpec(**json.loads(facts["spec"]), categories=categories)
        stages = forest.ForestModel.load(spark, f"{path}/forest") if facts["forest"] else PipelineModel.load(f"{path}/stages")
        return PriceModel(facts["name"], spec, stages)


def training_frame(train: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Label and prepared features, written once: training reads them many times."""
    labelled = train.withColumn("label", log_target(F.col("price")))
    return cut_lineage(prepare_features(labelled, spec, keep=["label"]), "training", rows_per_file=ROWS_PER_FILE)


def forest_parts(rows: int, width: int, trees: int, cores: int) -> int | None:
    """Parts in which a forest should hold its rows: each within ``FOREST_PART_BYTES``, and one a core. None: as they are read.

    The forest keeps a row as a bin a feature and a count a tree, about four bytes each, however few bytes the row
    takes in the file, so parts cut by the size of files would hold more the better the file packs.
    """
    size = rows * (4 * (width + trees) + 100)
    return max(-(-size // FOREST_PART_BYTES), cores) if size > SPREAD_BYTES else None


def spread(frame: DataFrame, spec: FeatureSpec, trees: int) -> DataFrame:
    """The rows of a written training frame in the parts that ``forest_parts`` wants."""
    parts = forest_parts(frame.count(), spec.width, trees, frame.sparkSession.sparkContext.defaultParallelism)
    return frame.repartition(parts) if parts else frame


def train_random_forest(train: DataFrame, spec: FeatureSpec | None = None, trees: int = 300,
                        depth: int = 28, min_leaf: int = 2, seed: int = 42, frame: DataFrame | None = None) -> PriceModel:
    """Forest over all features per split. Defaults are the full-size settings. ``frame`` is the
    training frame, if it is at hand."""
    spec = spec or fit_features(train)
    frame = frame or training_frame(train, spec)
    numbers, slots = [f"f_{c}" for c in spec.numeric], {f"i_{c}": spec.slots[c] for c in spec.categorical}
    return PriceModel(M.FOREST, spec, forest.fit(spread(frame, spec, trees), numbers, slots, "label", trees, depth, min_leaf, seed))


def train_ridge(train: DataFrame, spec: FeatureSpec | None = None, alpha: float = 1.0, solver: str = "normal",
                frame: DataFrame | None = None) -> PriceModel:
    """Ridge on features divided by their standard deviation.

    ``solver`` is ``normal`` (exact, up to 4096 features) or ``l-bfgs`` (iterative, any width).

    The deviations are those that the solvers take in their own pass: the exact one is the normal
    equation of the Gaussian linear model, which divides by the population's, ``l-bfgs`` by the sample's. Spark divides the
    penalty by rows and by the label's deviation; ``regParam`` undoes both, so that the solution is that of
    penalty ``alpha`` on population-scaled features.
    """
    spec = spec or fit_features(train)
    exact = solver == "normal"
    if exact and spec.width > NORMAL_SOLVER_WIDTH:
        raise ValueError(f"{spec.width} features: the exact solver takes {NORMAL_SOLVER_WIDTH}; choose solver='l-bfgs'")
    frame = frame or training_frame(train, spec)
    names = {c: f"f_{c}" for c in spec.numeric} | {c: f"i_{c}" for c in spec.categorical}
    facts = frame.agg(
        F.count("*").alias("n"), F.stddev_pop("label").alias("pop"), F.stddev_samp("label").alias("samp"),
        *[(F.min(v) == F.max(v)).alias(c) for c, v in names.items()]).first()
    n = facts["n"]
    # What never varies has weight zero whatever the penalty; left in, it would make the
    # exact solver's matrix singular.
    constant = [c for c in names if facts[c]]
    spread = facts["pop"] if exact else facts["samp"]
    penalty = alpha * (spread or 0.0) / n
    columns = {"featuresCol": "raw_features", "labelCol": "label"}
    if exact:  # the same solver as LinearRegression's, whose fit reads the rows once more to sum up its errors
        ridge = GeneralizedLinearRegression(family="gaussian", link="identity", regParam=penalty, **columns)
    else:
        ridge = LinearRegression(solver=solver, regParam=penalty * (n - 1) / n, maxIter=1000, tol=1e-12, **columns)
    stages = Pipeline(stages=[*encoding_stages(spec, "raw_features", constant), ridge]).fit(frame)
    return PriceModel(M.RIDGE, spec, stages)


def compare_models(train: DataFrame, test: DataFrame, trees: int = 300, depth: int = 28,
                   min_leaf: int = 2, alpha: float = 1.0, seed: int = 42,
                   solver: str = "normal") -> tuple[DataFrame, dict[str, PriceModel]]:
    """Fit both models, score the test rows, rank with the median baseline by MAE."""
    spec = fit_features(train)
    frame = training_frame(train, spec)
    fitted = {m.name: m for m in (
        train_random_forest(train, spec, trees, depth, min_leaf, seed, frame), train_ridge(train, spec, alpha, solver, frame))}
    ready = cut_lineage(prepare_features(test, spec, keep=["price"]))
    scored = {name: model.score(ready, ["price"]) for name, model in fitted.items()}
    scored[M.BASELINE] = M.baseline_median(train, test)
    rows = M.union_all([M.regression_metrics(df, name) for name, df in scored.items()])
    return M.rank_models(rows), fitted


def prediction_report(scored: DataFrame, with_source: bool = True) -> DataFrame:
    """Test columns, predicted price, absolute error in VND and billions."""
    columns = [c for c in REPORT_COLUMNS if with_source or c != "source"]
    error = abs_error(F.col("price"), F.col("predicted_price"))
    return scored.select(*columns, "predicted_price", error.alias("absolute_error"),
                         (error / 1_000_000_000).alias("absolute_error_billion"))
