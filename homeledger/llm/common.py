"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from homeledger.session import cut_lineage, scratch_path, scratch_run

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def ddl(df: DataFrame, *columns: str) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def scratched(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Write what ``build`` returns, and delete the scratch tables it wrote on the way. Its first argument
    is a DataFrame."""
    @wraps(build)
    def run(df: DataFrame, *args, **named) -> DataFrame:
        spark = df.sparkSession
        path = scratch_path(spark, build.__name__)
        with scratch_run(spark):
            return cut_lineage(build(df, *args, **named), path=path)
    return run


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that Python objects are held for few of them at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_1``, ``name_2`` ... that is no column of ``df``; case does not count."""
    taken = {c.lower() for c in df.columns}
    return next(x for x in (name, *(f"{name}_{i}" for i in range(1, len(taken) + 2))) if x.lower() not in taken)


BROADCAST_ROWS = 250_000  # of one number each: a few megabytes


def within_rows(df: DataFrame, numbers: DataFrame, row: str, kept: bool = True) -> DataFrame:
    """The rows of ``df`` whose number is among ``numbers``, or not. Few numbers are broadcast, more are joined by a shuffle."""
    numbers = cut_lineage(numbers, "numbers")
    if numbers.count() <= BROADCAST_ROWS:
        numbers = F.broadcast(numbers)
    return df.join(numbers, row, "left_semi" if kept else "left_anti")
