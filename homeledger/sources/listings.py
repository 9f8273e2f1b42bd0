"""Listing scans: headered CSV, ragged CSV, parquet copies, cached clean tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from homeledger import schema as S
from homeledger.functions import numbers, text
from homeledger.operators.cleaning import filter_segment
from homeledger.operators.dedupe import keep_first
from homeledger.operators.selection import first_rows
from homeledger.operators.standardize import standardize
from homeledger.session import cut_lineage, drop_folder, scratch_path
from homeledger.sources.records import has_broken_records, place_in_files, read_records

# --- fixed values: words a headered CSV uses for "no value" ---
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
HEADER_WORDS = ["name", "title", "tên tin"]
# --- end of fixed values ---

CORRUPT = "_corrupt_record"


_CSV = {"escape": '"', "mode": "PERMISSIVE"}


def read_headered_csv(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """Headered UTF-8 CSV, all columns text, null words as null.

    Names come from the header line alone; nothing is inferred from the data. Quoted fields may hold line
    breaks, and files stay split: where a look at the lines finds such a field, records are
    put together from lines (``records``), else lines are read as they are. ``numbered`` adds
    ``row_id``, the place in the files.
    """
    raw = spark.read.options(**_CSV, header=True, inferSchema=False).csv(path)
    names = raw.columns
    if has_broken_records(spark, path):
        fields = ", ".join(f"_{i} string" for i in range(len(names)))
        parsed = read_records(spark, path).where(~F.col("first")).select(
            "row_id", F.inline(F.array(F.from_csv("record", fields, _CSV))))
        place = F.col("row_id")
        columns = [F.col(f"_{i}") for i in range(len(names))]
    else:
        parsed, place, columns = raw, place_in_files(), [F.col(f"`{c}`") for c in names]
    return parsed.select(*[place.alias("row_id")] * numbered, *[
        F.when(~c.isin(NULL_WORDS), c).alias(name) for name, c in zip(names, columns)])


def _or_empty(read, spark: SparkSession, missing: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if missing == "empty" and e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], S.COMMON_SCHEMA)
        raise


def map_ad_columns(raw: DataFrame) -> DataFrame:
    """Flat ads to the common columns.

    A column that is absent takes its default; a null inside a present column stays.
    The time is taken from the posting column if there is one, else the crawl time.
    """
    have = set(raw.columns)
    unknown = F.lit(S.UNKNOWN)

    def pick(name: str, default: Column) -> Column:
        return F.col(name) if name in have else default

    no_number = F.lit(None).cast("double")
    when = next((c for c in ("NgayDang", "CrawlDate") if c in have), None)
    mapped = {
        "name": pick("Subject", unknown), "description": pick("Subject", unknown),
        "property_type_name": F.lit(S.APARTMENT),
        "province_name": pick("Region", F.lit(S.HCMC)),
        "district_name": pick("District", unknown), "ward_name": pick("Ward", unknown),
        "street_name": pick("Address", unknown), "project_name": unknown,
        "price": pick("PriceVND", no_number), "area": pick("AreaM2", no_number),
        "floor_count": pick("Floor", no_number), "frontage_width": no_number,
        "house_depth": no_number, "road_width": no_number,
        "bedroom_count": pick("BedRooms", no_number), "bathroom_count": pick("BathRooms", no_number),
        "house_direction": pick("MainDirection", unknown),
        "balcony_direction": pick("BalconyDirection", unknown),
        "published_at": F.col(when) if when else F.lit(None).cast("timestamp_ntz"),
        "source": F.lit("chotot"),
    }
    provenance = {"source_ad_id": "AdId", "source_list_id": "ListId", "source_link": "Link"}
    extra = [F.col(c).cast("string").alias(n) for n, c in provenance.items() if c in have]
    if "row_id" in have:
        extra.append(F.col("row_id"))
    return raw.select(*[c.alias(n) for n, c in mapped.items()], *extra)


def type_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Declare text columns numeric; a value that is no number becomes null."""
    return df.withColumns({
        c: numbers.try_number(F.col(c)) for c in columns
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)})


def numeric_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns in which every value present is a number, found in one pass."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return []
    bad = df.agg(*[
        F.count_if(F.col(c).isNotNull() & numbers.try_number(F.col(c)).isNull()).alias(c)
        for c in present]).first()
    return [c for c in present if bad[c] == 0]


def scan_listing_csv(spark: SparkSession, path: str, variant: str = "fixed", price: str = "number",
                     missing: str = "empty") -> DataFrame:
    """Headered CSV of flat ads to the common schema, standardised, duplicates kept.

    ``price`` says how money and area are stored: ``number``, ``text``, or ``infer``,
    which looks at the whole column first. ``missing`` is ``empty`` or ``error``.
    ``row_id`` is the place in the files, which settles which duplicate came first.
    """
    def read() -> DataFrame:
        raw = read_headered_csv(spark, path, numbered=True)
        money = ["PriceVND", "AreaM2"]
        if price == "infer":
            money = numeric_columns(raw, money)
        elif price == "text":
            money = []
        # ListTimeRaw and the ids stay text: they are provenance
        raw = type_numbers(raw, [*money, "BedRooms", "BathRooms", "Floor"])
        return standardize(map_ad_columns(raw), "chotot", variant)

    return _or_empty(read, spark, missing)


def read_ragged_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV with 13 text columns; a row of another width is kept whole in
    ``_corrupt_record``. Line breaks in fields as for headered files."""
    schema = T.StructType([*S.POSITIONAL_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    options = {**_CSV, "columnNameOfCorruptRecord": CORRUPT}
    if has_broken_records(spark, path):
        fields = ", ".join(f"{f.name} string" for f in schema)
        return read_records(spark, path).select(F.inline(F.array(F.from_csv("record", fields, options))), "row_id")
    # every field must be parsed to count them, whichever columns are used
    raw = spark.read.schema(schema).options(**options, header=False, columnPruning=False).csv(path)
    return raw.select("*", place_in_files().alias("row_id"))


def ragged_valid(raw: DataFrame) -> DataFrame:
    """Rows of the right width that are no header line."""
    head = F.lower(text.strip_edges(F.coalesce(F.col("name"), F.lit(""))))
    return raw.where(F.col(CORRUPT).isNull() & ~head.isin(HEADER_WORDS)).drop(CORRUPT)


def ragged_profile(raw: DataFrame) -> DataFrame:
    """Valid, header and skipped row counts in one pass."""
    wide = F.col(CORRUPT).isNotNull()
    head = F.lower(text.strip_edges(F.coalesce(F.col("name"), F.lit("")))).isin(HEADER_WORDS)
    return raw.agg(
        F.count_if(~wide & ~head).alias("valid_rows"),
        F.count_if(~wide & head).alias("header_rows"),
        F.count_if(wide).alias("skipped_rows"))


def map_positional_columns(raw: DataFrame) -> DataFrame:
    """13 positional columns to the common columns; the url becomes ``source_link``."""
    unknown, no_number = F.lit(S.UNKNOWN), F.lit(None).cast("double")
    same = ["name", "description", "property_type_name", "province_name", "district_name",
            "ward_name", "street_name", "price", "area", "bedroom_count", "bathroom_count",
            "published_at"]
    extra = [c for c in raw.columns if c == "row_id"]
    return raw.select(
        *same, unknown.alias("project_name"),
        *[no_number.alias(c) for c in ("floor_count", "frontage_width", "house_depth", "road_width")],
        *[unknown.alias(c) for c in S.DIRECTION_COLUMNS],
        F.lit("mogi").alias("source"), F.col("url").alias("source_link"), *extra)


def scan_ragged_csv(spark: SparkSession, path: str, missing: str = "empty", check: bool = True) -> DataFrame:
    """Ragged CSV to the common schema, standardised, duplicates kept."""
    def read() -> DataFrame:
        valid = ragged_valid(read_ragged_csv(spark, path))
        if check and valid.isEmpty():
            raise ValueError(f"no row with {len(S.POSITIONAL_COLUMNS)} fields in {path}")
        return standardize(map_positional_columns(valid), "mogi")

    return _or_empty(read, spark, missing)


def dedupe_source(df: DataFrame, source: str) -> DataFrame:
    """Keep-first per source. Without a ``row_id`` ties break on all columns."""
    keys = S.DEDUPE_KEYS[source]
    rest = [c for c in df.columns if c not in keys and c not in ("published_at", "row_id")]
    order = [c for c in ("row_id", "published_at") if c in df.columns and c not in keys]
    return keep_first(df, keys, order if "row_id" in df.columns else [*order, *rest])


def bounded_filtered_scan(df: DataFrame, province: str = S.HCMC, property_type: str = S.APARTMENT,
                          max_rows: int | None = None, scan_limit: int | None = None,
                          mode: str = "fixed", order: str = "row_id", check: bool = False) -> DataFrame:
    """The first ``max_rows`` rows of a segment among the first ``scan_limit`` rows; all rows
    where no limit is given.

    Both limits are cuts on the unique integer ``order`` column, so no row moves. The place-name
    rules run once, over a narrow table of the column and one flag.
    """
    if max_rows is None:
        scanned = df if scan_limit is None else first_rows(df, order, scan_limit)
        kept = filter_segment(scanned, province, property_type, mode)
    else:
        columns = [c for c in (order, "province_name", "property_type_name") if c in df.columns]
        scanned = df.select(*columns) if scan_limit is None else first_rows(df.select(*columns), order, scan_limit)
        folder = scratch_path(df.sparkSession, "segment")
        inside = cut_lineage(filter_segment(scanned, province, property_type, mode).select(order), path=folder)
        ends = first_rows(inside, order, max_rows).agg(F.max(order).alias("last")).first()
        drop_folder(df.sparkSession, folder)
        within = F.lit(False) if ends["last"] is None else F.col(order) <= F.lit(ends["last"])
        kept = filter_segment(df.where(within), province, property_type, mode)
    if check and kept.isEmpty():
        raise ValueError("no row passed the filter")
    return kept


def scan_clean_cache(spark: SparkSession, path: str, variant: str = "fixed") -> DataFrame:
    """A clean table written earlier, parquet or headered CSV, standardised again."""
    if path.endswith(".csv"):
        df = type_numbers(read_headered_csv(spark, path), ["price", "area", *S.NUMERIC_COLUMNS])
    else:
        df = spark.read.parquet(path)
    return standardize(df, "huggingface", variant)


def profile_schema(df: DataFrame) -> DataFrame:
    """Position, name, type and values present of each column, in one pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("filled"))
        for i, f in enumerate(df.schema.fields)])))


def sample_rows(df: DataFrame, n: int = 20, columns: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows of a scan, all columns or the named ones that exist."""
    kept = [c for c in columns if c in df.columns] if columns else df.columns
    return df.select(*kept).limit(n)
