"""The entry points a user calls: prepare, split, train, report."""

from __future__ import annotations

import contextlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from homeledger import schema as S
from homeledger.operators import cleaning, dedupe, metrics as M, models, splits, standardize as std
from homeledger.operators.cleaning import DEFAULT_LIMITS, Limits
from homeledger.session import cut_lineage, scratch_run
from homeledger.sources import listings, outputs

TARGET_TRANSFORM = "the models learn log1p(price); errors are in VND"
EXCLUDED_NOTES = [
    "price: what is predicted",
    "price_per_m2: made from the price, so only used to clean",
    "name, description: free text often names the price",
    "source: reported, never learned",
]


@dataclass(frozen=True)
class ModelSettings:
    trees: int = 300
    depth: int = 28
    min_leaf: int = 2
    alpha: float = 1.0
    seed: int = 42
    solver: str = "normal"


@dataclass
class RunResult:
    metrics: DataFrame
    best_model: models.PriceModel
    predictions: DataFrame
    summary: DataFrame
    strategy: str
    paths: dict[str, str] = field(default_factory=dict)


def prepare_three_sources(hf: DataFrame, chotot: DataFrame, mogi: DataFrame,
                          limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Standardised sources, already deduplicated each, to one clean table.

    Cleaning is row-local, so it runs before the second duplicate check as well as the
    union; one shuffle remains.
    """
    united = std.union_sources(hf, chotot, mogi)
    return dedupe.keep_first(cleaning.clean_for_model(united, limits), S.DEDUPE_KEYS["merged"],
                             _order(united))


def _order(df: DataFrame) -> list:
    """(published_at, source order, row_id), or all other columns without a row_id."""
    base = dedupe.listing_order()[:2]
    if "row_id" in df.columns:
        return [*base, F.col("row_id")]
    rest = [c for c in df.columns if c not in S.DEDUPE_KEYS["merged"]]
    return [*base, *[F.col(c) for c in rest]]


def prepare_two_sources(hf: DataFrame, chotot: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Clean each source, keep the model columns, unite, drop duplicates."""
    extra = [c for c in ("row_id",) if c in hf.columns and c in chotot.columns]
    parts = [std.keep_columns(cleaning.clean_for_model(df, limits), extra) for df in (hf, chotot)]
    united = std.union_sources(*parts)
    return dedupe.keep_first(united, S.DEDUPE_KEYS["merged"], _order(united))


def run_summary(train: DataFrame, test: DataFrame, strategy: str, best: str,
                extra: dict[str, str] | None = None) -> DataFrame:
    """One row that describes a run; the per-side facts come from one aggregate each."""
    def side(df: DataFrame, name: str) -> DataFrame:
        by_source = df.groupBy("source").agg(
            F.count("*").alias("c"), F.min("published_at").alias("lo"), F.max("published_at").alias("hi"))
        named = F.when(F.col("source").isNotNull(), F.struct("source", "c"))
        return by_source.agg(
            F.min("lo").alias(f"{name}_start"), F.max("hi").alias(f"{name}_end"),
            F.coalesce(F.sum("c"), F.lit(0)).alias(f"{name}_rows"),
            F.map_from_entries(F.array_sort(F.collect_list(named))).alias(f"{name}_source_distribution"))

    # both sides are one row
    a = side(train, "train").select(F.struct("*").alias("s")).scalar()
    b = side(test, "test").select(F.struct("*").alias("s")).scalar()
    fields = ["start", "end", "rows", "source_distribution"]
    texts = {"split_strategy": strategy, **(extra or {})}
    return train.sparkSession.range(1).select(
        *[F.lit(v).alias(k) for k, v in texts.items()],
        *[a[f"train_{f}"].alias(f"train_{f}") for f in fields],
        *[b[f"test_{f}"].alias(f"test_{f}") for f in fields],
        F.array(*map(F.lit, S.NUMERIC_FEATURES)).alias("numeric_features"),
        F.array(*map(F.lit, S.CATEGORICAL_FEATURES)).alias("categorical_features"),
        F.lit(TARGET_TRANSFORM).alias("target_transform"), F.lit(best).alias("best_model"),
        F.array(*map(F.lit, EXCLUDED_NOTES)).alias("excluded_columns_note"))


def train_and_report(split: splits.Split, settings: ModelSettings = ModelSettings(),
                     folder: str | None = None, extra: dict[str, str] | None = None,
                     single: bool = False) -> RunResult:
    """Fit, compare, score with the best model; with a folder, write every output.

    Training reads its rows many times: pass a split of a written table. ``single`` reports
    one source: without its name, and without a floor under the prediction.
    """
    train, test, strategy = split
    spark = train.sparkSession
    paths: dict[str, str] = {}
    if folder:
        paths = outputs.write_datasets({"train_data": train, "test_data": test}, folder)
    splits.check_split(*splits.side_counts(train, test))
    table, fitted = models.compare_models(train, test, settings.trees, settings.depth, settings.min_leaf,
                                          settings.alpha, settings.seed, settings.solver)
    table = cut_lineage(table, "metrics")  # three rows
    best = M.best_model(table).first()["best_model"]
    model = fitted[best]
    report = models.prediction_report(model.predict(test, floor=not single), with_source=not single)
    summary = run_summary(train, test, strategy, best, extra)
    if folder:
        paths["metrics"] = outputs.write_table(M.rank_models(table).coalesce(1), f"{folder}/metrics")
        paths["predictions"] = outputs.write_table(report, f"{folder}/predictions")
        paths["summary"] = outputs.write_table(summary, f"{folder}/summary", "json")
        paths["best_model"] = f"{folder}/best_model"
        model.save(paths["best_model"])
        # what is returned is read from the outputs, so the run's scratch tables can go
        report, table = spark.read.parquet(paths["predictions"]), spark.read.parquet(paths["metrics"])
        train, test = spark.read.parquet(paths["train_data"]), spark.read.parquet(paths["test_data"])
        summary, model = run_summary(train, test, strategy, best, extra), models.PriceModel.load(spark, paths["best_model"])
    return RunResult(M.rank_models(table), model, report, summary, strategy, paths)


def _scratch(spark: SparkSession, folder: str | None):
    return scratch_run(spark) if folder else contextlib.nullcontext()


def three_source_run(spark: SparkSession, hf: DataFrame, chotot_csv: str, mogi_csv: str, folder: str,
                     limits: Limits = DEFAULT_LIMITS, settings: ModelSettings = ModelSettings(),
                     **ranges: str) -> RunResult:
    """Landed listings, ad CSV and ragged CSV to a trained model with a fixed split.

    ``hf`` is a standardised table (``scan_clean_cache`` or ``bounded_filtered_scan``).
    """
    with scratch_run(spark):
        return _three_sources(spark, hf, chotot_csv, mogi_csv, folder, limits, settings, ranges)


def _three_sources(spark, hf, chotot_csv, mogi_csv, folder, limits, settings, ranges) -> RunResult:
    chotot = listings.dedupe_source(listings.scan_listing_csv(spark, chotot_csv), "chotot")
    mogi = listings.dedupe_source(listings.scan_ragged_csv(spark, mogi_csv), "mogi")
    stored = outputs.write_datasets(
        {"hf_schema_raw": hf, "chotot_schema_raw": chotot, "mogi_schema_raw": mogi}, folder)
    parts = [spark.read.parquet(p) for p in stored.values()]
    merged = prepare_three_sources(*parts, limits=limits)
    stored |= outputs.write_datasets({"merged_all_clean": merged}, folder)
    # partitioned by month: the split's two filters prune folders
    clean = spark.read.parquet(stored["merged_all_clean"])
    result = train_and_report(splits.split_fixed_range(clean, check=False, **ranges), settings, folder)
    result.paths = stored | result.paths
    return result


def _time_split(df: DataFrame, split: str, test_size: float) -> splits.Split:
    """A split by name; the caller checks that no side is empty."""
    if split == "latest_month":
        return splits.split_latest_month(df, check=False)
    if split == "latest_day":
        return splits.split_latest_day(df, check=False)
    if split == "chronological":
        return splits.split_chronological(df, test_size, check=False)
    raise ValueError(f"unknown split {split!r}")


def merge_run(hf: DataFrame, chotot: DataFrame, mode: str = "merged", split: str = "latest_month",
              test_size: float = 0.2, limits: Limits = DEFAULT_LIMITS,
              settings: ModelSettings = ModelSettings(), folder: str | None = None) -> RunResult | DataFrame:
    """Two standardised sources, ``chotot`` free of its own duplicates, in one of four modes.

    ``prepare`` only returns the united clean table; ``hf_only`` trains on the landed
    source, ``external`` tests on the other one, ``merged`` trains on both.
    """
    if mode == "prepare":
        return prepare_two_sources(hf, chotot, limits)
    if mode not in ("external", "hf_only", "merged"):
        raise ValueError(f"unknown mode {mode!r}")
    with _scratch(hf.sparkSession, folder):
        if mode == "merged":
            table = prepare_two_sources(hf, chotot, limits)
        else:
            clean = [cleaning.clean_for_model(df, limits) for df in (hf, chotot)]
            table = clean[0] if mode == "hf_only" else std.union_sources(*clean)
        table = cut_lineage(table, "clean")
        chosen = splits.split_external(table, check=False) if mode == "external" else _time_split(table, split, test_size)
        return train_and_report(chosen, settings, folder, {"mode": mode})


def prepare_single_source(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """One landed source with the milder text cleaning; numbers and time are coerced."""
    types = {f.name: f.dataType for f in std.complete_schema(df).schema.fields}
    typed = listings.type_numbers(std.complete_schema(df), ["price", "area", *S.NUMERIC_COLUMNS])
    when = std.dates.published_at_of(F.col("published_at"), types["published_at"])
    return cleaning.fill_categories(cleaning.clean_for_model(typed.withColumn("published_at", when), limits))


def single_source_run(df: DataFrame, province: str = "", property_type: str = "",
                      max_rows: int | None = None, scan_limit: int | None = None, split: str = "latest_month",
                      test_size: float = 0.2, limits: Limits = DEFAULT_LIMITS,
                      settings: ModelSettings = ModelSettings(trees=250), folder: str | None = None) -> RunResult:
    """One landed source from scan to model; rows are limited only where a limit is given."""
    scanned = listings.bounded_filtered_scan(df, province, property_type, max_rows, scan_limit, "single")
    with _scratch(df.sparkSession, folder):
        clean = cut_lineage(prepare_single_source(scanned, limits), "clean")
        return train_and_report(_time_split(clean, split, test_size), settings, folder,
                                {"province": province, "property_type": property_type}, single=True)
