"""Structured Streaming twins of ad ingest, coverage counts and scoring."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from homeledger import schema as S
from homeledger.operators.dedupe import keep_first
from homeledger.operators.models import PriceModel
from homeledger.sources import ads


ARRIVAL = "arrival"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of a task with their running number: streams have no expression for it."""
    done = 0
    for batch in batches:
        number = pa.array(range(done, done + batch.num_rows), pa.int64())
        done += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, number], names=[*batch.schema.names, "number"])


def read_page_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New page documents, one per line, as files arrive in a folder, with ``arrival``, a text that orders
    them: time of the file, its name, block and line."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    digits = lambda c: F.lpad(c.cast("string"), 20, "0")
    file = F.concat_ws("/", digits(F.unix_micros(F.col("_metadata.file_modification_time"))), F.col("_metadata.file_path"),
                       digits(F.col("_metadata.file_block_start")))
    lines = reader.text(path).select("value", file.alias("file")).mapInArrow(_counted, "value string, file string, number bigint")
    return lines.select(F.from_json("value", ads.PAGE_SCHEMA).alias("page"), F.concat_ws("/", "file", digits(F.col("number"))).alias(ARRIVAL)).select(
        "page.ads", "page.data", ARRIVAL)


def _crawl(crawl_time: Column | None) -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if crawl_time is None else crawl_time


def _arrived(ads_of_pages: DataFrame) -> DataFrame:
    """``arrival`` of the page and the ad's place in it as one ``arrival``."""
    place = F.lpad(F.col("place").cast("string"), 10, "0")
    return ads_of_pages.withColumn(ARRIVAL, F.concat_ws("/", ARRIVAL, place)).drop("place")


def flat_pages(pages: DataFrame, zone: str = "UTC", crawl_time: Column | None = None) -> DataFrame:
    """Flat ads of a stream or a batch of pages, repeats included."""
    crawl = _crawl(crawl_time)
    if ARRIVAL not in pages.columns:
        return ads.flatten_ad(ads.explode_ad_pages(pages), crawl, zone)
    return _arrived(ads.flatten_ad(ads.explode_ad_pages(pages, "place"), crawl, zone))


def ingest_ads(pages: DataFrame, zone: str = "UTC", crawl_time: Column | None = None) -> DataFrame:
    """Flat ads without repeats, on a batch of pages with ``arrival``: of repeats the first stays."""
    return keep_first(flat_pages(pages, zone, crawl_time), S.DEDUPE_KEYS["crawl"], [ARRIVAL]).select(*S.FLAT_AD_COLUMNS)


def first_arrivals(flat: DataFrame) -> DataFrame:
    """A stream of ads with their keys, each ad (AdId, ListId, Subject) once, as it came first; in update mode.

    The state of a key is its first row by (time of the batch, arrival). In update mode a batch brings out
    the keys it touches; those whose first row is of this very batch are new. The time of a batch is in
    the checkpoint, so a batch that is run again finds the same.
    """
    row = F.struct(*[c for c in flat.columns if c != ARRIVAL])
    timed = flat.withColumn("since", F.current_timestamp())  # in a stream: the time of the batch
    state = timed.groupBy(*S.DEDUPE_KEYS["crawl"]).agg(
        F.min_by(row, F.struct("since", ARRIVAL)).alias("first"), F.min("since").alias("since"))
    return state.where(F.col("since") == F.current_timestamp()).select("first.*")


def land_ads(pages: DataFrame, path: str, checkpoint: str, zone: str = "UTC", crawl_time: Column | None = None) -> StreamingQuery:
    """Work off the pages that have arrived, append the ads that are new, and stop.

    Each key's first text is held in a keyed state (RocksDB, in the checkpoint), so an ad of any age is
    recognised, only its key is read of an ad that comes again, nothing that landed is read again, and a batch costs what it brings. Of repeats the
    first stays, within a batch and across batches and restarts. Each batch has a folder of its own, which a batch that is
    run again replaces. The state grows with the number of ads ever seen; the clock must not run backwards between batches.
    """
    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    spark = pages.sparkSession
    first = first_arrivals(ads.with_ad_keys(_arrived(ads.ad_texts(pages, "place")))).drop(*S.DEDUPE_KEYS["crawl"])
    new = ads.flatten_ad(ads.parse_ads(first), _crawl(crawl_time), zone)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS_DB)  # a query takes its settings when it starts
    try:
        return (new.writeStream.outputMode("update").foreachBatch(append)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.set(STATE_STORE, before)


def daily_coverage(listings: DataFrame, delay: str = "1 day", time: str = "published_at") -> DataFrame:
    """Rows per day and source in tumbling windows.

    In complete mode every row counts. In append mode a day comes out when the watermark has
    passed its end, so the days within ``delay`` of the latest time stay open, and rows that
    come later than ``delay`` are not counted: use it for feeds that keep to that.
    """
    timed = listings.select(F.col(time).cast("timestamp").alias("ts"), "source")
    counted = (timed.withWatermark("ts", delay).groupBy(F.window("ts", "1 day"), "source")
               .agg(F.count("*").alias("rows")))
    return counted.select(F.to_date("window.start").alias("day"), "source", "rows")


def land_daily_coverage(listings: DataFrame, path: str, changes: str, checkpoint: str, time: str = "published_at") -> StreamingQuery:
    """Keep a table of rows per day and source, partitioned by day, up to date with rows of any lateness, and stop.

    A batch's own counts are a change, stored under its number, so a batch that is run again
    replaces its change. Days that the batch touches are then summed anew from their changes, which the partitioning finds
    without reading other days, and only these days' folders are replaced. Rows without a time are not counted.
    """
    def repair(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        counted = batch.where(F.col(time).isNotNull()).groupBy(F.to_date(time).alias("day"), "source").agg(F.count("*").alias("rows"))
        change = f"{changes}/batch={number}"
        counted.write.mode("overwrite").partitionBy("day").parquet(change)
        schema = "source string, rows bigint, batch bigint, day date"
        touched = spark.read.schema(schema).parquet(change).select("day").distinct()
        # as many days as a batch brings; the join prunes the folders of all others
        every = spark.read.schema(schema).parquet(changes).join(F.broadcast(touched), "day", "left_semi")
        totals = every.groupBy("day", "source").agg(F.sum("rows").alias("rows"))
        totals.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)

    return (listings.writeStream.foreachBatch(repair).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def land_scores(listings: DataFrame, model: PriceModel, path: str, checkpoint: str, key: str | None = None) -> StreamingQuery:
    """Price the listings that have arrived, into parquet, and stop.

    Each batch is priced like a table and has a folder of its own, which a batch that is run
    again replaces.
    """
    def score(batch: DataFrame, number: int) -> None:
        model.predict(batch, key=key).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (listings.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def write_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Work off what has arrived, into parquet, and stop."""
    return (df.writeStream.outputMode(mode).format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def write_latest(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Replace a table by the complete result after each batch."""
    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return (df.writeStream.outputMode("complete").foreachBatch(replace)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
