"""DataFrames that several queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from homeledger import schema as S
from homeledger.catalog import views as V
from homeledger.operators import cleaning, metrics, standardize as std
from homeledger.session import scratch_path
from homeledger.sources import ads, outputs

CRAWL_TIME = "2026-05-31 00:00:00"


def facts(spark: SparkSession, sf: str) -> DataFrame:
    return V.view(spark, sf, V.facts_sql)


def listings(spark: SparkSession, sf: str) -> DataFrame:
    return V.view(spark, sf, V.listings_sql).drop("partkey")


def doubled(spark: SparkSession, sf: str) -> DataFrame:
    return V.view(spark, sf, V.doubled_sql).drop("partkey")


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return V.view(spark, sf, V.raw_sql)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "documents").select("doc_id", "text")


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return V.view(spark, sf, V.requests_sql)


def predictions(spark: SparkSession, sf: str, facts_only: bool = True) -> DataFrame:
    make = V.prediction_facts_sql if facts_only else V.predictions_sql
    return outputs.billion_units(V.view(spark, sf, make).drop("partkey"))


def raw_columns(df: DataFrame) -> DataFrame:
    """The raw view as a source would land it: without the helper columns."""
    return df.drop("address", "posted", "total", "custkey", "link")


def raw_standard(spark: SparkSession, sf: str, variant: str = "fixed", sources: list[str] = S.SOURCES) -> DataFrame:
    """Each source of the raw listings standardised its own way, united."""
    landed = raw_columns(raw(spark, sf))
    return std.union_sources(*[
        std.standardize(landed.where(F.col("source") == s), s, variant) for s in sources])


def typed_standard(df: DataFrame, variant: str = "fixed") -> DataFrame:
    return std.standardize(df, None, variant)


def clean_listings(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_for_model(typed_standard(listings(spark, sf)))


def page_texts(spark: SparkSession, sf: str) -> DataFrame:
    return V.view(spark, sf, V.pages_sql)


def ad_objects(spark: SparkSession, sf: str) -> DataFrame:
    pages = page_texts(spark, sf).withColumn("p", F.from_json("page", ads.PAGE_SCHEMA))
    return ads.explode_ad_pages(pages.select("page_id", "p.ads", "p.data"))


def flat_ads(spark: SparkSession, sf: str) -> DataFrame:
    return ads.flatten_ad(ad_objects(spark, sf), F.lit(CRAWL_TIME), zone="UTC")


def ads_csv(spark: SparkSession, sf: str) -> str:
    """The flat ads written as headered CSV, as a crawl would leave them."""
    flat = flat_ads(spark, sf).drop("page_id")
    return outputs.write_table(flat, scratch_path(spark, "ads_csv"), "csv")


def ragged_csv(spark: SparkSession, sf: str) -> str:
    """The raw listings written as a headerless CSV with header lines and rows of other
    widths in between."""
    def quoted(c: str):
        inner = F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(inner, F.lit(""))

    fields = ["name", "description", "property_type_name", "province_name", "district_name", "ward_name",
              "street_name", "price", "area", "bedroom_count", "bathroom_count", "published_at", "link"]
    landed = raw(spark, sf).withColumns({
        "bathroom_count": F.lit("2"),
        # a quoted comma, quote and line break inside a field
        "description": F.concat(F.lit('x, "y"\n'), F.coalesce("description", F.lit("")))})
    full = F.concat_ws(",", *[quoted(c) for c in fields])
    kind = F.col("row_id") % 10
    line = (F.when(kind == 0, F.concat_ws(",", *[quoted(c) for c in fields[:-1]]))
            .when(kind == 1, F.concat(full, F.lit(",extra")))
            .when(kind == 2, F.concat(F.lit(" Title ,"), F.concat_ws(",", *[F.lit(c) for c in fields[1:]])))
            .otherwise(full))
    path = scratch_path(spark, "ragged")
    landed.select(line.alias("value")).write.text(path)
    return path


def metrics_table(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of three predictors of the listing price, in the shape of a metrics file."""
    p = V.view(spark, sf, V.prediction_facts_sql)
    shifted = p.withColumn("predicted_price", F.col("price") * 0.98)
    halved = p.withColumn("predicted_price", F.col("price") * 0.5)
    return metrics.union_all([
        metrics.regression_metrics(p, metrics.FOREST),
        metrics.regression_metrics(shifted, metrics.RIDGE),
        metrics.regression_metrics(halved, metrics.BASELINE)])
