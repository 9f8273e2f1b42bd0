"""Position of each row in a global order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from homeledger.session import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, row below


def chronological_rank(df: DataFrame, order: Sequence[str] = ("published_at", "row_id")) -> DataFrame:
    """``df`` with ``position`` from 1 in ``order``, nulls last.

    Range partitions follow the whole order, so a single hot day is spread by
    ``row_id``. Each row gets its place inside its partition; partition totals, one row
    per partition, give the offsets. The partitioned table is written once, so both
    steps see the same partitions even if executors are lost.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    placed = cut_lineage(placed, "rank")
    placed = placed.withColumn("_part", F.shiftright("_id", _LOCAL_BITS))
    totals = placed.groupBy("_part").agg(F.count("*").alias("c"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("_offset"))
    local = F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    # one row per shuffle partition: a bound set by the configuration, not by the data
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("position", F.col("_offset") + local + 1)
        .drop("_part", "_id", "_offset")
    )
