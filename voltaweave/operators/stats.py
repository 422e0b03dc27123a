"""Summaries that a run prints before it writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import percent_floor


def conditional_counts(df: DataFrame, counts: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """total, a count for each condition, and its whole percent of the total."""
    made = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *(F.count_if(c).alias(n) for n, c in counts.items()))
    return made.withColumns({f"{n}_pct": percent_floor(F.col(n), F.col("total")) for n in counts})


def groups_with_any(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """How many groups have any value that is not null, for each of ``values``."""
    each = df.groupBy(key).agg(*(F.bool_or(F.col(v).isNotNull()).alias(v) for v in values))
    return each.agg(F.count(F.lit(1)).alias("groups"), *(F.count_if(v).alias(f"with_{v}") for v in values))


def extent(df: DataFrame, value: str) -> DataFrame:
    """First, last and number of distinct values."""
    return df.agg(F.min(value).alias("first"), F.max(value).alias("last"), F.countDistinct(value).alias("n_distinct"))


def group_counts(df: DataFrame, by: str) -> DataFrame:
    """Rows for each value, most first, ties by value."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(by))


def largest(df: DataFrame, value: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` rows with the largest positive values: a top-k, not a full sort."""
    return df.filter(F.col(value) > 0).orderBy(F.desc(value), *ties).limit(n)
