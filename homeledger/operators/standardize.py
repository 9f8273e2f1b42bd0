"""Any source to the common listing schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from homeledger import schema as S
from homeledger.functions import dates, numbers, text

DAY_FIRST_SOURCES = {"mogi"}


def complete_schema(df: DataFrame, columns: Sequence[str] = S.COMMON_COLUMNS) -> DataFrame:
    """Add each missing common column as null, with its type."""
    missing = {c: F.lit(None).cast(S.common_type(c)) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def tag(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def first_existing(columns: Iterable[str], candidates: Sequence[str]) -> str | None:
    """The first candidate name that is a column, decided when the plan is built."""
    present = set(columns)
    return next((c for c in candidates if c in present), None)


def evaluate_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace columns parsed from text, as the output of a one-element ``inline``.

    A filter on a projected column is pushed below the projection, with a copy of its
    expression per comparison. For long parsing rules that repeats the work and outgrows
    the code generator's method limit. A filter does not move below a generator, so each
    rule runs once per row. Typed columns stay outside: their filters reach the scan.
    """
    if not columns:
        return df
    parsed = F.inline(F.array(F.struct(*[e.alias(c) for c, e in columns.items()])))
    return df.select(*[c for c in df.columns if c not in columns], parsed)


def _number(df: DataFrame, column: str) -> Column:
    if numbers.is_numeric(df.schema[column].dataType):
        return numbers.nan_to_null(F.col(column).cast("double"))
    return numbers.try_number(F.col(column))


def standardize(df: DataFrame, source: str | None, variant: str = "fixed",
                strict_format: str | None = None) -> DataFrame:
    """The common schema for one source; further columns such as ``row_id`` pass through.

    ``fixed`` parses text money and area, ``merge`` only coerces numbers. Whether money
    is text is a property of the column type, not of the value. Without ``source`` the
    table keeps the ``source`` column it has.
    """
    df = complete_schema(df)
    extra = [c for c in df.columns if c not in S.COMMON_COLUMNS]
    types = {f.name: f.dataType for f in df.schema.fields}
    textual = [c for c in ("price", "area", "published_at") if isinstance(types[c], T.StringType)]
    out: dict[str, Column] = {c: text.clean_text(F.col(c).cast("string")) for c in S.TEXT_COLUMNS}
    out["province_name"] = text.normalize_province(F.col("province_name"), variant)
    out["district_name"] = text.normalize_district(F.col("district_name"), variant)
    out["ward_name"] = text.normalize_ward(F.col("ward_name"), variant)
    for c in S.DIRECTION_COLUMNS:
        out[c] = text.normalize_direction(F.col(c).cast("string"), variant)
    for c in S.NUMERIC_COLUMNS:
        out[c] = _number(df, c)
    if variant == "fixed":
        out["price"] = numbers.positive(F.col("price"))
        out["area"] = numbers.parse_area_m2(F.col("area"), "area" not in textual)
    else:
        out["price"], out["area"] = _number(df, "price"), _number(df, "area")
    out["published_at"] = dates.published_at_of(
        F.col("published_at"), types["published_at"],
        day_first=variant == "fixed" and source in DAY_FIRST_SOURCES, strict_format=strict_format)
    out["source"] = F.col("source") if source is None else F.lit(source)
    if variant == "fixed" and "price" in textual:
        # the patterns run once; the price itself is then cheap to repeat in filters
        df = df.withColumn("price", numbers.money_text(F.col("price")))
        parts = {f"_{k}": c for k, c in numbers.money_parts(F.col("price")).items()}
        rules = {c: out.pop(c) for c in textual if c != "price"}
        df = evaluate_once(df, {**rules, **parts})
        out["price"] = numbers.price_of_parts(*[F.col(k) for k in parts])
    else:
        df = evaluate_once(df, {c: out.pop(c) for c in textual})
    return df.select(*[out.get(c, F.col(c)).alias(c) for c in S.COMMON_COLUMNS], *extra)


def keep_columns(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Common and derived columns in order, each once; provenance goes unless named."""
    wanted = dict.fromkeys([*S.COMMON_COLUMNS, *S.DERIVED_COLUMNS, *extra])
    return df.select(*[c for c in wanted if c in df.columns])


def union_sources(*sources: DataFrame) -> DataFrame:
    """Union by column name; a column that one source lacks is null there.

    Where one source counts its rows and another names their place in files, counts become
    places too, so the order inside each source stays.
    """
    kinds = [df.schema["row_id"].dataType for df in sources if "row_id" in df.columns]
    if any(isinstance(k, T.StructType) for k in kinds):
        place = F.struct(F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"), F.col("row_id").cast("bigint").alias("place"))
        sources = tuple(
            df.withColumn("row_id", place) if "row_id" in df.columns and not isinstance(df.schema["row_id"].dataType, T.StructType) else df
            for df in sources)
    first, *others = sources
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
