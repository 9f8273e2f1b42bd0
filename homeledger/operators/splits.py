"""Splits by time. Each returns (train, test, label) and never moves rows.

A split is two filters with a cut that a small aggregate finds, so the partition and
column pruning of the written table still applies on both sides.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, functions as F

from homeledger.functions import dates
from homeledger.operators.selection import kth_value

Split = tuple[DataFrame, DataFrame, str]


def micros(c: Column) -> Column:
    """Timestamp without zone as microseconds, independent of the session zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def side_counts(train: DataFrame, test: DataFrame) -> tuple[int, int]:
    """Rows on each side, in one job."""
    sides = train.select(F.lit(True).alias("t")).unionAll(test.select(F.lit(False).alias("t")))
    row = sides.agg(F.count_if("t").alias("a"), F.count_if(~F.col("t")).alias("b")).first()
    return row["a"], row["b"]


def check_split(train_rows: int, test_rows: int, min_train: int = 0, min_test: int = 0) -> list[str]:
    """Fail on an empty side, warn on a small one; returns the warnings."""
    if train_rows < 1 or test_rows < 1:
        raise ValueError(f"a side of the split is empty: train {train_rows}, test {test_rows}")
    notes = []
    if train_rows < min_train:
        notes.append(f"train has {train_rows} rows, fewer than {min_train}")
    if test_rows < min_test:
        notes.append(f"test has {test_rows} rows, fewer than {min_test}")
    for note in notes:
        warnings.warn(note, stacklevel=2)
    return notes


def _checked(split: Split, check: bool) -> Split:
    if check:
        check_split(*side_counts(split[0], split[1]))
    return split


def split_fixed_range(df: DataFrame, train_start: str = "2025-06-01", train_end: str = "2026-03-31",
                      test_start: str = "2026-04-01", test_end: str = "2026-05-31",
                      check: bool = True) -> Split:
    """Inclusive date ranges, which may overlap or leave gaps."""
    ts = F.col("published_at")
    train = df.where(ts.between(dates.start_of_day(train_start), dates.end_of_day(train_end)))
    test = df.where(ts.between(dates.start_of_day(test_start), dates.end_of_day(test_end)))
    label = f"fixed_train_{train_start}_to_{train_end}__test_{test_start}_to_{test_end}"
    return _checked((train, test, label), check)


def _split_latest(df: DataFrame, unit: str, check: bool) -> Split:
    first = df.agg(F.date_trunc(unit, F.max("published_at")).cast("timestamp_ntz").alias("t")).first()["t"]
    if first is None:
        raise ValueError("no row has a time")
    cut = F.lit(first).cast("timestamp_ntz")
    name = f"{first:%Y-%m}" if unit == "month" else f"{first:%Y-%m-%d}"
    ts = F.col("published_at")
    return _checked((df.where(ts < cut), df.where(ts >= cut), f"latest_{unit}_{name}"), check)


def split_latest_month(df: DataFrame, check: bool = True) -> Split:
    """The last month present is the test side, all earlier months train."""
    return _split_latest(df, "month", check)


def split_latest_day(df: DataFrame, check: bool = True) -> Split:
    return _split_latest(df, "day", check)


def chronological_cut(rows: int, test_size: float) -> int:
    """Rows on the train side; the product is truncated as a float."""
    return int(rows * (1 - test_size))


def split_chronological(df: DataFrame, test_size: float = 0.2, check: bool = True) -> Split:
    """The first share of rows by (published_at, row_id) trains, the rest tests.

    The boundary row is found by exact rank selection on the time, then on ``row_id``
    among the rows of that very time; no row is ranked globally. Rows without a time
    come last, as in a sort with nulls last.
    """
    label = f"chronological_last_{test_size:.0%}"
    counts = df.agg(F.count("*").alias("n"), F.count("published_at").alias("timed")).first()
    cut = chronological_cut(counts["n"], test_size)
    if check:
        check_split(cut, counts["n"] - cut)
    ts, row_id = F.col("published_at"), F.col("row_id")
    if cut == 0 or cut == counts["n"]:
        return df.where(F.lit(cut > 0)), df.where(F.lit(cut == 0)), label
    if cut <= counts["timed"]:
        timed = df.select(micros(ts).alias("t"), "row_id")
        at = kth_value(timed, "t", cut, counts["timed"]).first()
        moment = F.lit(at["value"])
        tied = timed.where(F.col("t") == moment)
        last = kth_value(tied, "row_id", cut - at["below"], at["copies"]).first()["value"]
        before = (micros(ts) < moment) | ((micros(ts) == moment) & (row_id <= F.lit(last)))
        before = F.coalesce(before, F.lit(False))
    else:
        untimed = df.where(ts.isNull()).select("row_id")
        last = kth_value(untimed, "row_id", cut - counts["timed"], counts["n"] - counts["timed"]).first()["value"]
        before = ts.isNotNull() | (row_id <= F.lit(last))
    return df.where(before), df.where(~before), label


def split_candidates(df: DataFrame) -> DataFrame:
    """Rows on each side of the latest-month and latest-day splits, in one pass: what a caller
    needs to choose one."""
    latest = df.agg(F.max("published_at").alias("t"))
    units = ("month", "day")
    bounds = latest.select(F.struct(*[F.date_trunc(u, F.col("t")).cast("timestamp_ntz").alias(u) for u in units]).alias("b")).scalar()
    ts = F.col("published_at")
    counts = df.agg(*[F.count_if(test).alias(f"{u}_{side}") for u in units
                      for side, test in (("train", ts < bounds[u]), ("test", ts >= bounds[u]))])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f"latest_{u}").alias("split"), F.col(f"{u}_train").alias("train_rows"), F.col(f"{u}_test").alias("test_rows"))
        for u in units])))


def split_auto(df: DataFrame, min_train: int, min_test: int, test_size: float = 0.2, check: bool = True) -> Split:
    """Latest month; if a side has fewer rows than the caller asks for the latest day; if still
    so, chronological. Which one it was is in the label."""
    enough = {r["split"] for r in split_candidates(df).collect() if r["train_rows"] >= min_train and r["test_rows"] >= min_test}
    if "latest_month" in enough:
        return split_latest_month(df, check)
    if "latest_day" in enough:
        return split_latest_day(df, check)
    return split_chronological(df, test_size, check)


def split_external(df: DataFrame, train_source: str = "huggingface", test_source: str = "chotot",
                   check: bool = True) -> Split:
    """All rows of one source train, all rows of another test."""
    train = df.where(F.col("source") == train_source)
    test = df.where(F.col("source") == test_source)
    return _checked((train, test, "external_test_hf_train_chotot_test"), check)
