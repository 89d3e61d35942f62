"""Joins whose keys may be hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fewest rows that make a key hot.
LEAST = 1_000


def hot_bound(rows: int) -> int:
    """A key with more of the ``rows`` than this is hot; fewer than 1,000 keys
    can be, so a list of them is small."""
    return max(LEAST, rows // 1_000)


def join_hot(rows: DataFrame, groups: DataFrame, on: Column, hot: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``groups``, which has one row for each key. Groups
    where ``hot`` holds, fewer than 1,000 by :func:`hot_bound`, are broadcast,
    so their rows stay where they are; the others meet in a shuffle."""
    few, rest = F.broadcast(groups.where(hot)), groups.where(~hot)
    return rows.join(few, on).unionByName(rows.join(few, on, "left_anti").join(rest, on, how), allowMissingColumns=True)
