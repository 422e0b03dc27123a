"""Exact quantiles of groups of any size, by narrowing histograms.

Every wanted rank of every group has an interval of values in which it must lie.
Each round counts the interval's values in equal bins, combined before the
shuffle, and goes on with the bin that holds the rank, from its least to its
greatest value.  A rank is found when these are the same.  So a group is never
held in one buffer: a round sends at most ``bins`` rows for each task and interval.

Each round reads the table again: one parts positive from negative values, one
values of all magnitudes, and each of the others makes an interval narrower by the
number of bins, so that doubles of any spread are told apart in some eight rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import scratch

_INFINITE = float("inf")


def _finite(v: Column) -> Column:
    return (F.abs(v) < _INFINITE) & ~F.isnan(v)


def _bin(v: Column, low: Column, high: Column, bins: int) -> Column:
    """The bin of a value; infinite values and NaN, which is the greatest, have bins of their own.

    An interval around zero is parted by sign, one whose ends are more than a factor of
    four apart by equal ratios, any other by equal differences.
    """
    size, least, most = F.ln(F.abs(v)), F.ln(F.abs(low)), F.ln(F.abs(high))
    ratio = (size - least) / F.nullif(most - least, F.lit(0.0))  # of negative values the greatest size comes first, and so does its share
    share = F.when(F.abs(most - least) > 1.4, ratio).otherwise((v - low) / F.nullif(high - low, F.lit(0.0)))
    inside = F.when(high <= low, 0).when((low <= 0) & (high >= 0), F.signum(v) + 1).otherwise(F.least(F.lit(bins - 1), F.floor(share * bins)))
    return F.when(v == -_INFINITE, -1).when(F.isnan(v), bins + 1).when(v == _INFINITE, bins).otherwise(inside.cast("int"))


def ranks(df: DataFrame, keys: Sequence[str], value: str, wanted: Column, bins: int = 1024) -> DataFrame:
    """(keys, rank, value) for the 0-based ranks that ``wanted``, an array of longs made of the group's size ``n``, names.

    Nulls are not counted; null keys are a group; -0.0 is 0.0.  Needs the shared checkpoint folder.
    """
    spark = df.sparkSession
    home = scratch.folder(spark, "ranks")
    by = [f"_k{i}" for i in range(len(keys))]
    v = F.col("_v")
    rows = df.select(*(F.col(k).alias(b) for k, b in zip(keys, by, strict=True)), (F.col(value).cast("double") + 0.0).alias("_v")).filter("_v is not null")
    finite = F.when(_finite(v), v)
    sizes = rows.groupBy(*by).agg(F.count("_v").alias("n"), F.min(finite).alias("low"), F.max(finite).alias("high"))
    asked = sizes.select(*by, F.explode(F.array_distinct(wanted)).alias("rank"), F.coalesce("low", F.lit(0.0)).alias("low"), F.coalesce("high", F.lit(0.0)).alias("high"), F.lit(0).cast("long").alias("below"))
    asked = asked.withColumns({"whole": F.lit(True), "found": F.lit(None).cast("double")})
    interval = [*by, "low", "high", "below", "whole"]
    done, turn = [], 0
    while True:
        asked.write.parquet(f"{home}/{turn}")
        now = spark.read.schema(asked.schema).parquet(f"{home}/{turn}")
        done.append(now.filter("found is not null"))
        open_ = now.filter("found is null").drop("found")
        if open_.isEmpty():
            break
        places = open_.select(interval).distinct().select(*(F.col(b).alias(f"o{b}") for b in by), "low", "high", "below", "whole")
        same = F.col("whole") | v.between(F.col("low"), F.col("high"))
        for b in by:
            same = same & F.col(b).eqNullSafe(F.col(f"o{b}"))
        counted = rows.join(places, same).groupBy(*interval, _bin(v, F.col("low"), F.col("high"), bins).alias("bin"))
        counted = counted.agg(F.count("_v").alias("n"), F.min("_v").alias("least"), F.max("_v").alias("most"))
        until = F.sum("n").over(Window.partitionBy(interval).orderBy("bin"))
        counted = counted.select(*(F.col(c).alias(f"c_{c}") for c in interval), (F.col("below") + until - F.col("n")).alias("from"), (F.col("below") + until).alias("until"), "least", "most")
        met = F.lit(True)
        for c in interval:
            met = met & F.col(c).eqNullSafe(F.col(f"c_{c}"))
        hit = open_.join(counted, met & (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("until")))
        asked = hit.select(
            *by, "rank", F.col("least").alias("low"), F.col("most").alias("high"), F.col("from").alias("below"), F.lit(False).alias("whole"),
            F.when(F.col("least").eqNullSafe(F.col("most")), F.col("least")).alias("found"),
        )
        turn += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(*(F.col(b).alias(k) for b, k in zip(by, keys, strict=True)), "rank", F.col("found").alias(value))


def quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], interpolated: bool = False, bins: int = 1024) -> DataFrame:
    """One row for each group with the array ``quantiles``, in the order of ``shares``.

    A quantile is the least value that so large a share of the group doesn't exceed
    or, ``interpolated``, the point between the two values around (n - 1) * share.
    """
    n = F.col("n")
    if interpolated:
        lower, upper = ([f((n - 1) * s).cast("long") for s in shares] for f in (F.floor, F.ceil))
    else:
        lower = upper = [F.greatest(F.ceil(n * s) - 1, F.lit(0)).cast("long") for s in shares]
    found = ranks(df, keys, value, F.array(*lower, *upper), bins)
    by = [F.col(k).alias(k) for k in keys]
    some = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", value))).alias("at"))
    sizes = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.count(value).alias("n"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"m_{k}").eqNullSafe(F.col(k))
    met = sizes.join(some.select(*(F.col(k).alias(f"m_{k}") for k in keys), "at"), same)
    value_at = lambda rank: F.element_at("at", rank)
    weights = [(n - 1) * s - F.floor((n - 1) * s) if interpolated else F.lit(0.0) for s in shares]
    points = [F.when(lo == hi, value_at(lo)).otherwise(value_at(lo) + (value_at(hi) - value_at(lo)) * w) for lo, hi, w in zip(lower, upper, weights, strict=True)]
    return met.select(*keys, F.array(*points).alias("quantiles"))
