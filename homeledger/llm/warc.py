"""Resolution of not-modified revisits in web captures.

A server that answers "not modified" sends headers but no body; such a capture is stored as
a ``revisit``. Its body is the one of the latest earlier full response for the same
canonical URL (status 200, not truncated), provided that the validators agree: the entity tag (weak comparison), or
without one on both sides the modification date. The result carries the stored headers,
updated with those of the revisit that a not-modified answer may change.

The as-of join needs no ordered pass over a URL's captures: times are cut into equal
slices; within (URL, slice) a window finds the latest full response, and one row per
(URL, slice) that has any carries the last of it forward. A URL with a third of all rows is
so spread over all slices, and only keys, times and references are moved; headers are
fetched for the matched captures alone.

Null URLs have no canonical form and resolve with nothing; a null time is later than nothing
and earlier than nothing. Equal times are ordered by capture id; repeated ids are captures
of their own. Times count in whole seconds. Header names are compared in lower case. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from homeledger.llm.common import lower_ascii
from homeledger.operators.joins import attach
from homeledger.session import cut_lineage

SLICES = 1024
# What a not-modified answer must not change (framing and the body's own description).
KEPT = ("connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "etag",
        "keep-alive", "proxy-authenticate", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")
# Fields that have one value.
SINGLE = ("age", "content-length", "content-location", "content-md5", "content-range", "content-type", "date", "etag", "expires", "host",
          "last-modified", "location", "retry-after", "server", "user-agent")


def canonical_url(url: Column) -> Column:
    """Without scheme, leading ``www.``, default port, fragment, tracking keys and trailing slash;
    host in lower case, query keys sorted. Null without ``://``."""
    rest = F.regexp_extract(url, r"^[^:/?#]*://([^#]*)", 1)
    host = F.regexp_replace(lower_ascii(F.regexp_extract(rest, r"^([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/+$", "")
    pairs = F.filter(F.split(F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1), "&"),
                     lambda kv: (kv != "") & ~kv.rlike(r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"))
    query = F.array_join(F.array_sort(pairs), "&")
    return F.when(rest != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: an expression inside a lambda is evaluated wherever it stands."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def header_fields(block: Column) -> Column:
    """Fields of a header block, names in lower case. Of a repeated field the values are joined in order, by a comma, cookies by
    a line break; of one that can have a single value, and of WARC's own, the first counts. Lines without a colon (the
    status or version line) are not fields."""
    lines = F.filter(F.split(block, "\r?\n"), lambda x: F.instr(x, ":") > 1)
    pairs = F.transform(lines, lambda x: F.struct(
        lower_ascii(F.trim(F.substring_index(x, ":", 1))).alias("key"),
        F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("value")))
    single = F.array(*map(F.lit, SINGLE))

    def value_of(name: Column, fields: Column) -> Column:
        values = F.transform(F.filter(fields, lambda p: p["key"] == name), lambda p: p["value"])
        joined = F.when(name == "set-cookie", F.array_join(values, "\n")).otherwise(F.array_join(values, ", "))
        return F.when(F.array_contains(single, name) | name.startswith("warc-"), F.get(values, F.lit(0))).otherwise(joined)

    return _bound(pairs, lambda fields: _bound(
        F.array_distinct(F.transform(fields, lambda p: p["key"])),
        lambda names: F.map_from_arrays(names, F.transform(names, lambda name: value_of(name, fields)))))


def record_time(text: Column) -> Column:
    """Seconds of a WARC date, with or without seconds and fractions; null for other forms."""
    forms = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]X", "yyyy-MM-dd'T'HH:mmX", "yyyy-MM-dd")
    return F.unix_seconds(F.coalesce(*[F.try_to_timestamp(text, F.lit(form)) for form in forms]))


def read_records(records: DataFrame) -> DataFrame:
    """Captures from WARC records (record_id, warc, http, body): the two header blocks as text. Those
    of status 200 that are not marked as truncated are ``complete``."""
    warc = header_fields(F.coalesce("warc", F.lit("")))
    kind = lower_ascii(warc["warc-type"])
    return records.select(
        F.col("record_id").alias("capture_id"), warc["warc-target-uri"].alias("url"),
        record_time(warc["warc-date"]).alias("at"),
        F.when((kind == "revisit") & ~F.coalesce(warc["warc-profile"], F.lit("")).contains("server-not-modified"), "other")
        .otherwise(kind).alias("kind"),
        ((F.regexp_extract(F.coalesce("http", F.lit("")), r"^HTTP/\S+ +(\d{3})(?!\d)", 1) == "200") & warc["warc-truncated"].isNull()).alias("complete"),
        header_fields(F.coalesce("http", F.lit(""))).alias("headers"),
        F.when(F.col("body").isNotNull(), F.sha2(F.col("body"), 256)).alias("body_sha256"))


def header(headers: Column, name: str) -> Column:
    """A header's value whatever the case of its name; the first if repeated."""
    return F.get(F.filter(F.map_entries(headers), lambda e: lower_ascii(e["key"]) == name), F.lit(0))["value"]


def merged_headers(stored: Column, update: Column) -> Column:
    """``stored`` updated with the headers of a not-modified answer, names in lower case."""
    lowered = lambda m: F.transform(F.map_entries(m), lambda e: F.struct(lower_ascii(e["key"]).alias("key"), e["value"].alias("value")))
    kept = F.array(*map(F.lit, KEPT))
    changed = F.filter(lowered(update), lambda e: ~F.array_contains(kept, e["key"]))
    names = F.transform(changed, lambda e: e["key"])
    old = F.filter(lowered(stored), lambda e: ~F.array_contains(names, e["key"]))
    return F.map_from_entries(F.array_sort(F.concat(old, changed)))


def weak_tag(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^W/", "")


def latest_full(captures: DataFrame, slices: int = SLICES) -> DataFrame:
    """(row, from_row): for each revisit the latest earlier response of its canonical URL.

    ``captures``: row (unique), canonical, at (long), capture_id, kind, full (it may be taken).
    """
    known = captures.where(F.col("canonical").isNotNull() & F.col("at").isNotNull()).select(
        "row", "canonical", "at", "capture_id", "kind", "full")
    bounds = known.agg(F.min("at").alias("a"), F.max("at").alias("b")).first()
    begin, width = bounds["a"] or 0, max(1, -(-((bounds["b"] or 0) - (bounds["a"] or 0) + 1) // slices))
    known = known.withColumn("slice", F.floor((F.col("at") - F.lit(begin)) / F.lit(width)).cast("int"))
    full = F.when(F.col("full"), F.struct("at", "capture_id", "row"))
    inside = Window.partitionBy("canonical", "slice").orderBy("at", "capture_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    near = known.withColumn("near", F.last(full, ignorenulls=True).over(inside)).where(F.col("kind") == "revisit")
    ends = known.where("full").groupBy("canonical", "slice").agg(
        F.max(F.struct("at", "capture_id", "row")).alias("last"))
    asked = near.where(F.col("near").isNull()).select("canonical", "slice").distinct()
    across = Window.partitionBy("canonical").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ends.join(asked.withColumn("asked", F.lit(True)), ["canonical", "slice"], "full")
        .withColumn("before", F.last("last", ignorenulls=True).over(across)).where("asked").select("canonical", "slice", "before"))
    return near.where(F.col("near").isNotNull()).select("row", F.col("near.row").alias("from_row")).unionByName(
        near.where(F.col("near").isNull()).join(carried, ["canonical", "slice"]).where(F.col("before").isNotNull())
        .select("row", F.col("before.row").alias("from_row")))


def resolve_revisits(captures: DataFrame, slices: int = SLICES) -> DataFrame:
    """Captures (capture_id, url, at, kind, headers, body_sha256) with what they resolve to. Responses
    count as full where ``complete`` holds, or all of them without that column.

    Per capture: capture_id, canonical, kind, status, from_id, headers, body_sha256. Status:
    ``full`` for what is no revisit; for revisits ``etag`` or ``last-modified`` (the validator that
    agrees), ``mismatch`` (one that doesn't), ``unverified`` (no validator on both sides), or
    ``missing`` (no earlier full response). Only agreeing revisits get headers and body.
    """
    full = F.coalesce("complete", F.lit(False)) if "complete" in captures.columns else F.lit(True)
    read = cut_lineage(captures.select(
        F.monotonically_increasing_id().alias("row"), "capture_id", canonical_url(F.col("url")).alias("canonical"),
        F.col("at").cast("bigint").alias("at"), "kind", "headers", "body_sha256",
        F.coalesce((F.col("kind") == "response") & full, F.lit(False)).alias("full")), "captures")
    found = cut_lineage(latest_full(read, slices), "found")
    stored = read.where("full").select(
        F.col("row").alias("from_row"), F.col("capture_id").alias("from_id"), F.col("headers").alias("stored"),
        F.col("body_sha256").alias("stored_body"))
    used = found.groupBy("from_row").agg(F.count("*").alias("n"))
    sources = cut_lineage(stored.join(used, "from_row"), "stored")
    matched = attach(found, sources, "from_row", "n")
    both = read.where("kind = 'revisit'").join(matched, "row", "left")
    tag_a, tag_b = weak_tag(header(F.col("headers"), "etag")), weak_tag(header(F.col("stored"), "etag"))
    day_a, day_b = header(F.col("headers"), "last-modified"), header(F.col("stored"), "last-modified")
    tags, days = tag_a.isNotNull() & tag_b.isNotNull(), day_a.isNotNull() & day_b.isNotNull()
    status = (
        F.when(F.col("from_row").isNull(), "missing")
        .when(tags, F.when(tag_a == tag_b, "etag").otherwise("mismatch"))
        .when(days, F.when(day_a == day_b, "last-modified").otherwise("mismatch")).otherwise("unverified"))
    agrees = F.col("status").isin("etag", "last-modified")
    revisits = both.withColumn("status", status).select(
        "capture_id", "canonical", "kind", "status", "from_id",
        F.when(agrees, merged_headers(F.col("stored"), F.col("headers"))).alias("headers"),
        F.when(agrees, F.col("stored_body")).alias("body_sha256"))
    responses = read.where("kind != 'revisit' OR kind IS NULL").select(
        "capture_id", "canonical", "kind", F.lit("full").alias("status"), F.lit(None).cast(read.schema["capture_id"].dataType).alias("from_id"),
        F.col("headers"), "body_sha256")
    return responses.unionByName(revisits)
