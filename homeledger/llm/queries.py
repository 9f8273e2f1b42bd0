"""One query per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from homeledger.llm import bpe, digests, itq, notices, packing, prefix_trie, runs, secrets, sharding, simhash, toxicity, urls, warc
from homeledger.llm import oracles

SHARDS = 40
URL_RULES = [  # fixed values
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def warc_records(pages: DataFrame) -> DataFrame:
    """Two WARC records per page: a full response, and 30 days later a not-modified revisit by a
    variant of the URL. The revisit brings the entity tag in weak form; one in seven brings another
    tag, one in five none, and of these one in three no date either."""
    i, body = F.col("page_id"), F.coalesce("html", F.lit(""))
    stamp = lambda at, form: F.date_format(F.timestamp_seconds(at), form)
    iso, http = "yyyy-MM-dd'T'HH:mm:ss'Z'", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"
    tag, modified = F.substring(F.sha2(body, 256), 1, 16), stamp(i * 3600, http)
    asked = F.when(i % 3 == 0, F.concat("url", F.lit("#again"))).when(
        (i % 3 == 1) & (F.instr("url", "?") == 0) & (F.instr("url", "#") == 0), F.concat("url", F.lit("?utm_medium=revisit"))).otherwise(F.col("url"))

    def record(n: int, kind: str, url, at, status: str, fields: list, body_of) -> DataFrame:
        lines = F.concat_ws("\r\n", F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Target-URI: "), url),
                            F.concat(F.lit("WARC-Date: "), stamp(at, iso)),
                            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/server-not-modified") if kind == "revisit" else F.lit(None))
        return pages.select((i * 2 + n).alias("record_id"), lines.alias("warc"),
                            F.concat_ws("\r\n", F.lit(status), F.concat(F.lit("Date: "), stamp(at, http)), *fields).alias("http"), body_of.alias("body"))

    first, later = i * 60 + 1_700_000_000, i * 60 + 1_702_592_000
    full = record(0, "response", F.col("url"), first, "HTTP/1.1 200 OK", [
        F.lit("Content-Type: text/html"), F.concat(F.lit("Content-Length: "), F.octet_length(body)), F.lit("Cache-Control: max-age=60"),
        F.concat(F.lit('ETag: "'), tag, F.lit('"')), F.concat(F.lit("Last-Modified: "), modified)], body)
    again = record(1, "revisit", asked, later, "HTTP/1.1 304 Not Modified", [
        F.lit("Content-Length: 0"), F.lit("cache-control: max-age=120"),
        F.when(i % 5 != 0, F.concat(F.lit('etag: W/"'), F.when(i % 7 == 0, F.lit("changed")).otherwise(tag), F.lit('"'))),
        F.when(i % 15 != 0, F.concat(F.lit("last-modified: "), modified))], F.lit(None).cast("string"))
    return full.unionByName(again)


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_records(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    fields = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return warc.resolve_revisits(warc.read_records(records)).select(
        "capture_id", "canonical", "kind", "status", "from_id", fields.alias("headers"), "body_sha256")


def op3_itq_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op5_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), SHARDS)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    key = F.col("doc_id")
    scorer = toxicity.fit(docs, labels, ~toxicity.held_out(key))
    return scorer.score(docs, ["doc_id"]).select(
        "doc_id", F.coalesce(toxicity.held_out(key), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op7_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op8_improbable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return digests.compare_with_next(docs, digests.window_rarity(docs))


def op9_association_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).withColumn("fingerprint", simhash.hex_digits(F.col("fp"))).select(
        "doc_id", "fingerprint", "component_id")


def op11_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = notices.scan_notices(table(spark, sf_dir, "documents"))
    base, word = F.array_sort(F.array_distinct("places.label")), F.col("places.word")
    every = F.array_sort(F.array_union("places.label", "spans.label"))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min(word).alias("first_word"), F.array_max(word).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), "score")


HEAD_TURNS, CONVERSATIONS = 6, 100  # a conversation takes under 6 turns from the first of its hundred


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = prefix_trie.conversation_turns(table(spark, sf_dir, "conversations"))
    number = F.col("conv_id")
    taken = F.crc32(F.encode(number.cast("string"), "UTF-8")) % HEAD_TURNS
    return prefix_trie.prefix_trie(prefix_trie.with_heads(convs, number - number % CONVERSATIONS, taken, HEAD_TURNS - 1))


def with_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten repeats its words from a place on, both by the checksum of its id; one without an id does not."""
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=with_period)
    best = F.col("best")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_best_fit_packing, op2_warc_revisits, op3_itq_near_duplicates, op4_secret_scan, op5_jump_sharding, op6_toxicity,
    op7_forced_boundary_bpe, op8_improbable_features, op9_association_urls, op10_simhash, op11_license_notices,
    op12_prefix_trie, op13_periodic_runs)}
ORACLES: dict[str, str] = oracles.ORACLES
