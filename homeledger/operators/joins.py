"""Joins that no hot key can stop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

HEAVY_SHARE = 1000  # a key with over 1/1000 of the rows is heavy: there are under 1000 of them


def attach(rows: DataFrame, facts: DataFrame, key: str | Sequence[str], weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``facts`` on ``key``, safe against hot keys.

    ``facts`` has one row per key, with its number of ``rows`` in ``weight``. Keys with over
    1/1000 of all rows are fewer than 1000, so their facts are broadcast and their rows stay
    where they are; all other rows are joined by a shuffle in which no key is hot. Both
    inputs are read twice: pass written tables. ``weight`` is dropped.
    """
    keys = [key] if isinstance(key, str) else list(key)
    total = facts.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col(weight) * HEAVY_SHARE > F.lit(total)
    hot, cold = facts.where(heavy).drop(weight), facts.where(~heavy).drop(weight)
    near = rows.join(F.broadcast(hot), keys)
    far = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return near.unionByName(far)
