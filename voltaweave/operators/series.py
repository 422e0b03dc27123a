"""Time series of keyed rows: collection, changes, drops and anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _along(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(F.asc_nulls_first(order))


def collected(df: DataFrame, keys: Sequence[str], order: str, fields: Sequence[str], name: str = "series") -> DataFrame:
    """One row for each key with its records as an array, ascending by ``order``."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, *fields))).alias(name))


def joined_text(values: Column, between: str = "|") -> Column:
    """An ordered text aggregate, ascending, repeats kept."""
    return F.array_join(F.sort_array(F.collect_list(values)), between)


def with_change(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str = "change", steps: int = 1) -> DataFrame:
    """The value less the one ``steps`` rows before in its series, to four places."""
    return df.withColumn(name, F.round(F.col(value) - F.lag(value, steps).over(_along(keys, order)), 4))


def jumps(df: DataFrame, keys: Sequence[str], order: str, value: str, least: float) -> DataFrame:
    """Rows whose value rose by at least ``least`` since the row before."""
    return with_change(df, keys, order, value).filter(F.col("change") >= least)


def queue_drop(df: DataFrame, keys: Sequence[str], order: str, value: str, steps: int = 3, name: str = "drop") -> DataFrame:
    """By how much the value fell over ``steps`` rows, 0 if it didn't, null without so many."""
    before = F.lag(value, steps).over(_along(keys, order))
    return df.withColumn(name, F.greatest(F.round(before - F.col(value), 4), F.when(before.isNotNull() & F.col(value).isNotNull(), 0.0)))


def change_scores(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Each change and its z-score against all earlier changes of the series (sample deviation).

    Null with fewer than two earlier changes or none that differ.
    """
    w = _along(keys, order)
    changed = with_change(df, keys, order, value)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    mean, spread = F.avg("change").over(before), F.stddev_samp("change").over(before)
    return changed.withColumn("z", F.when(spread > 0, (F.col("change") - mean) / spread))


def last_anomaly(df: DataFrame, keys: Sequence[str], order: str, value: str, label: str, least_z: float = 1.5, least_change: float = 30.0) -> DataFrame:
    """For each series whose last change stands out, keys and ``anomaly``: size, direction, label, z-score, date and both values.

    A change stands out by its z-score's size and its own.
    """
    rows = change_scores(df.withColumn("prev", F.lag(value).over(_along(keys, order))), keys, order, value)
    last = last_of_series(rows, keys, order).filter((F.abs("z") >= least_z) & (F.abs("change") >= least_change))
    made = F.struct(
        F.abs("change").alias("mw"),
        F.when(F.col("change") > 0, "sube").otherwise("baja").alias("dir"),
        F.lit(label).alias("lbl"),
        F.round(F.abs("z"), 1).alias("z"),
        F.col(order).alias("fecha"),
        "prev",
        F.col(value).alias("curr"),
    )
    return last.select(*keys, made.alias("anomaly"))


def last_of_series(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each series."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def months_since(last: Column, asof: Column) -> Column:
    """Whole months from ``last`` to ``asof``."""
    return F.floor(F.months_between(asof, last)).cast("int")


def within_months(due: Column, asof: Column, months: int) -> Column:
    """Whether ``due`` lies from ``asof`` to so many months later."""
    return due.between(asof, F.add_months(asof, months))
