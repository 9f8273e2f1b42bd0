"""Exact order statistics without a global sort.

A wanted rank is found by refining bins. Values are counted in 4096 bins between the least
and the largest; the bin that holds the rank is kept with its own least and largest value,
and is divided again, until it holds one value. Counts are formed in the map tasks, so a
pass moves at most 4096 rows per group and task, whatever the data.

Where the number of groups is bounded, a mergeable KLL sketch chooses the first bracket around each rank in one
pass over the values, and a second pass counts what lies below the bracket and what is in it, value by value. The
counts say whether the rank is inside; if so, only the bracket's counted values are refined further. If the sketch
missed, the rank is sought from the whole range. Either way the result is exact.

Bins of doubles are even in the logarithm while a range spans several powers of two, then
even in the value; bins of longs are even in the value. Either way about six passes reach a
single value whatever the distribution, two or three for prices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from homeledger.operators.joins import attach
from homeledger.session import cut_lineage, drop_folder, scratch_path

BINS = 4096
SKETCH, SLACK = 2000, 0.004  # a sketch of this size errs by 0.14 % of the ranks, in 99 of 100 cases
GRID = 1000
_STATE = "lo {0}, hi {0}, below bigint, c bigint, n bigint, ks array<bigint>"


def _log(v: Column) -> Column:
    """Increases with ``v`` over all doubles: the binary exponent with the sign of ``v``."""
    size = F.least(F.log2(F.abs(v)), F.lit(2000.0)) + 1100
    return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0.0))


def _bin(v: Column, lo: Column, hi: Column, integral: bool) -> Column:
    """Bin of ``v`` between ``lo`` and ``hi``; never decreases with ``v``."""
    if integral:
        wide = lambda c: c.cast("decimal(20,0)")
        return F.floor((wide(v) - wide(lo)) * BINS / (wide(hi) - wide(lo) + 1)).cast("int")
    close = ((lo > 0) & (hi < lo * 4)) | ((hi < 0) & (lo > hi * 4))
    share = F.when(close, (v - lo) / (hi - lo)).otherwise((_log(v) - _log(lo)) / (_log(hi) - _log(lo)))
    return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")


def _pass(data: DataFrame, state: DataFrame, group: list[str], few_groups: bool, kind: str) -> DataFrame:
    """Divide each open range of ``state`` once, keeping the bins that hold wanted ranks."""
    ranges = F.struct("lo", "hi", "below", "n", "ks")
    own = [c for c in data.columns if c not in group]
    if group:
        facts = state.groupBy(*group).agg(F.collect_list(ranges).alias("_r"), F.max("n").alias("_w"))
        joined = data.join(F.broadcast(facts.drop("_w")), group) if few_groups else attach(data, cut_lineage(facts, "ranges"), group, "_w")
        rows = joined.select(*group, *own, F.inline("_r"))
    else:
        ranges_now = [r.asDict() for r in state.collect()]  # as many as wanted ranks at most
        rows = data.select(*own, F.inline(F.array(*[
            F.struct(*[F.lit(r[c]).cast(kind).alias(c) for c in ("lo", "hi")], F.lit(r["below"]).cast("bigint").alias("below"),
                     F.lit(r["n"]).cast("bigint").alias("n"), F.array(*[F.lit(k).cast("bigint") for k in r["ks"]]).alias("ks"))
            for r in ranges_now])))
    held = F.col("_v").between(F.col("lo"), F.col("hi"))
    key = [*group, "lo", "hi", "below", "n", "ks"]
    size = F.sum("_c") if "_c" in data.columns else F.count("*")
    counted = (
        rows.where(held).withColumn("bin", _bin(F.col("_v"), F.col("lo"), F.col("hi"), kind == "bigint"))
        .groupBy(*key, "bin").agg(size.alias("c"), F.min("_v").alias("a"), F.max("_v").alias("b")))
    order = Window.partitionBy(*key).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("below") + F.sum("c").over(order)
    placed = counted.withColumn("upto", upto).withColumn("start", F.col("upto") - F.col("c"))
    inside = F.filter("ks", lambda k: (F.col("start") <= k) & (k < F.col("upto")))
    return placed.withColumn("ks", inside).where(F.size("ks") > 0).select(
        *group, F.col("a").alias("lo"), F.col("b").alias("hi"), F.col("start").alias("below"), "c", "n", "ks")


def _brackets(data: DataFrame, wanted: Column, group: list[str], kind: str) -> list[dict]:
    """First ranges around the wanted ranks from one pass of sketches, disjoint within a group; a bounded number."""
    agg, quantile = getattr(F, f"kll_sketch_agg_{kind}"), getattr(F, f"kll_sketch_get_quantile_{kind}")
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])  # Spark wants the ranks it looks up to be constant
    facts = data.groupBy(*group).agg(
        F.min("_v").alias("least"), F.max("_v").alias("most"), F.count("*").alias("n"), agg("_v", SKETCH).alias("sketch")).where("n > 0")
    share = lambda d: (F.col("k") / F.col("n") + F.lit(d)) * GRID
    low, high = F.floor(share(-SLACK)).cast("int"), F.ceil(share(SLACK)).cast("int")
    around = facts.select("*", quantile("sketch", grid).alias("at"), F.explode(F.array_distinct(wanted)).alias("k")).select(
        *group, "least", "most", "n", "k", F.when(low <= 0, F.col("least")).otherwise(F.get("at", F.least(low, F.lit(GRID)))).alias("lo"),
        F.when(high >= GRID, F.col("most")).otherwise(F.get("at", F.greatest(high, F.lit(0)))).alias("hi"))
    out: list[dict] = []
    for r in sorted((r.asDict() for r in around.collect()), key=lambda r: (*(str(r[g]) for g in group), r["lo"])):
        k = r.pop("k")
        if out and all(out[-1][g] == r[g] for g in group) and r["lo"] <= out[-1]["hi"]:
            out[-1]["hi"] = max(out[-1]["hi"], r["hi"])
            out[-1]["ks"].append(k)
        else:
            out.append(r | {"ks": [k]})
    return out


def _inside(data: DataFrame, brackets: list[dict], group: list[str], kind: str, path: str) -> DataFrame:
    """(group, lo, hi, value, count) of what is in the brackets; the row without a value counts what lies below. One pass."""
    if group:
        names = ", ".join(f"`{g}` {data.schema[g].dataType.simpleString()}" for g in group)
        table = data.sparkSession.createDataFrame([(*(r[g] for g in group), r["lo"], r["hi"]) for r in brackets], f"{names}, lo {kind}, hi {kind}")
        rows = data.join(F.broadcast(table.groupBy(*group).agg(F.array_agg(F.struct("lo", "hi")).alias("_r"))), group)
    else:
        rows = data.withColumn("_r", F.array(*[
            F.struct(*[F.lit(r[c]).cast(kind).alias(c) for c in ("lo", "hi")]) for r in brackets]).cast(f"array<struct<lo: {kind}, hi: {kind}>>"))
    return cut_lineage(
        rows.select(*group, "_v", F.inline("_r")).where("_v <= hi")
        .select(*group, "lo", "hi", F.when(F.col("_v") >= F.col("lo"), F.col("_v")).alias("_v"))
        .groupBy(*group, "lo", "hi", "_v").agg(F.count("*").alias("_c")), path=path)


def _settled(seen: DataFrame, brackets: list[dict], group: list[str]) -> tuple[list[tuple], list[tuple]]:
    """States of the ranks that their bracket holds, and of those that it misses, as rows of ``_STATE``."""
    counted = seen.groupBy(*group, "lo", "hi").agg(
        F.sum(F.when(F.col("_v").isNull(), F.col("_c")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("_v").isNotNull(), F.col("_c")).otherwise(0)).alias("c"), F.min("_v").alias("a"), F.max("_v").alias("b"))
    facts = {(*(r[g] for g in group), r["lo"], r["hi"]): r for r in counted.collect()}
    hit, missed = [], []
    for r in brackets:
        name = tuple(r[g] for g in group)
        f = facts.get((*name, r["lo"], r["hi"]))
        held = [k for k in r["ks"] if f and f["below"] <= k < f["below"] + f["c"]]
        if held:
            hit.append((*name, f["a"], f["b"], f["below"], f["c"], r["n"], held))
        if len(held) < len(r["ks"]):
            missed.append((*name, r["least"], r["most"], 0, r["n"], r["n"], [k for k in r["ks"] if k not in held]))
    return hit, missed


def _at_ranks(df: DataFrame, value: str, wanted: Column, group: list[str], few_groups: bool, kind: str) -> DataFrame:
    """(group, k, value, below, copies, n) for each zero-based rank in ``wanted``, an array of the
    group's number of values ``n``.

    ``below`` values are smaller, ``copies`` are equal. The result is a small local table, or a
    written one if the number of groups is not bounded.
    """
    spark = df.sparkSession
    bounded = few_groups or not group
    kept = df.select(*group, F.col(value).cast(kind).alias("_v")).where(F.col("_v").isNotNull())
    folder = scratch_path(spark, "values")
    data = cut_lineage(kept if kind == "bigint" else kept.where(~F.isnan("_v")), path=folder)
    schema = ", ".join([*(f"`{g}` {df.schema[g].dataType.simpleString()}" for g in group), _STATE.format(kind)])
    done: list[DataFrame] = []

    def settle(frame: DataFrame) -> DataFrame:
        return spark.createDataFrame(frame.collect(), schema) if bounded else cut_lineage(frame, "state")

    def refine(values: DataFrame, state: DataFrame) -> None:
        while True:
            done.append(state.where("lo = hi"))
            state = state.where("lo < hi")
            if state.isEmpty():
                break
            state = settle(_pass(values, state, group, few_groups, kind))

    if bounded:
        brackets = _brackets(data, wanted, group, kind)
        within = scratch_path(spark, "inside")
        seen = _inside(data, brackets, group, kind, within)
        hit, missed = _settled(seen, brackets, group)
        refine(seen.where(F.col("_v").isNotNull()).select(*group, "_v", "_c"), spark.createDataFrame(hit, schema))
        if missed:
            refine(data, spark.createDataFrame(missed, schema))
        drop_folder(spark, within)
        drop_folder(spark, folder)
    else:
        refine(data, data.groupBy(*group).agg(
            F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.lit(0).cast("bigint").alias("below"), F.count("*").alias("c"),
            F.count("*").alias("n")).where("n > 0").withColumn("ks", F.array_distinct(wanted)).transform(settle))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(*group, F.explode("ks").alias("k"), F.col("lo").alias("value"), "below", F.col("c").alias("copies"), "n")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    group: Sequence[str] = (), few_groups: bool = False) -> DataFrame:
    """Linearly interpolated quantiles: columns ``group``, ``prob``, ``quantile``, ``n``.

    Nulls and NaN are left out; a group without values has no row. ``few_groups`` states that
    the caller has bounded the number of groups, so that their ranges are broadcast.
    """
    group, probs = list(group), sorted({float(p) for p in probs})
    at = lambda p: F.lit(p) * (F.col("n") - 1)
    wanted = F.array(*[f(at(p)).cast("bigint") for p in probs for f in (F.floor, F.ceil)])
    found = _at_ranks(df, value, wanted, group, few_groups, "double")
    asked = found.withColumn("prob", F.explode(F.array(*map(F.lit, probs))))
    place = F.col("prob") * (F.col("n") - 1)
    low, high = F.floor(place), F.ceil(place)
    return (
        asked.groupBy(*group, "prob", "n")
        .agg(F.max(F.when(F.col("k") == low, F.col("value"))).alias("_lo"), F.max(F.when(F.col("k") == high, F.col("value"))).alias("_hi"))
        .select(*group, "prob", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (place - low)).alias("quantile"), "n"))


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """One row, one column ``median``; null for an empty input."""
    return exact_quantiles(df, value, [0.5]).agg(F.max("quantile").alias("median"))


def kth_value(df: DataFrame, key: str, k: int, n: int) -> DataFrame:
    """The ``k``-th smallest (from 1) of ``n`` non-null integers: ``value``, ``below``, ``copies``.

    ``below`` counts the keys strictly smaller, ``copies`` the equal ones.
    """
    if not 1 <= k <= n:
        raise ValueError(f"rank {k} is not within 1..{n}")
    wanted = F.array(F.lit(k - 1).cast("bigint"))
    return _at_ranks(df, key, wanted, [], True, "bigint").select("value", "below", "copies")


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest unique integer ``key``: an ordered limit as a filter.

    Only the key column is read to find the cut; the rows themselves are then filtered
    in place, so a limit of millions never meets in one task.
    """
    total = df.select(key).count()
    if total <= n:
        return df
    cut = kth_value(df, key, n, total).first()["value"]
    return df.where(F.col(key) <= F.lit(cut))
