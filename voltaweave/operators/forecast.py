"""Recurring windows: in which quarter does a key's event tend to come back?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quarter_window(pattern: Column, asof: Column) -> tuple[Column, Column]:
    """First and last day of the next quarter of that number; the running one if it is that."""
    year = F.year(asof) + F.when(pattern < F.quarter(asof), 1).otherwise(0)
    start = F.make_date(year, pattern * 3 - 2, F.lit(1))
    return start, F.date_sub(F.add_months(start, 3), 1)


def recurrence(events: DataFrame, keys: Sequence[str], day: str, size: str, asof: str, least_events: int = 2, least_share: float = 50.0, least_mean: float | None = None) -> DataFrame:
    """One row for each key with enough events in one quarter of the year.

    The pattern is the quarter with most events; of equals the one whose first
    event is earliest.  Two aggregations that combine before their shuffles, no
    window: (key, quarter) first, then key.
    """
    share = lambda a, b: F.round(100.0 * a / b, 1)
    quarters = (
        events.withColumn("_q", F.quarter(day))
        .groupBy(*keys, "_q")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min(day).alias("_first"),
            F.max(day).alias("_last"),
            F.sum(size).alias("_sum"),
            F.max(size).alias("_max"),
            F.collect_set(F.year(day)).alias("_years"),
            F.collect_list(F.date_format(day, "yyyy-MM-dd")).alias("_days"),
        )
    )
    found = quarters.groupBy(*keys).agg(
        F.sum("_n").alias("n_events"),
        F.size(F.array_distinct(F.flatten(F.collect_list("_years")))).alias("n_years"),
        F.max_by("_q", F.struct("_n", -F.unix_date("_first"))).alias("pattern_quarter"),
        F.max("_n").alias("_modal"),
        # in whole hundredths, so that ties round alike whatever the order of the sum
        (F.round(F.round(F.sum("_sum") * 100) / F.sum("_n")) / 100).alias("mean_size"),
        F.max("_max").alias("max_size"),
        F.max("_last").alias("last_event"),
        F.array_join(F.sort_array(F.flatten(F.collect_list("_days"))), "|").alias("event_days"),
    )
    modal = F.col("_modal") / F.col("n_events")
    confidence = 0.4 * modal + 0.3 * F.least(F.col("n_events") / 10, F.lit(1.0)) + 0.3 * F.least(F.col("n_years") / 3, F.lit(1.0))
    when = F.to_date(F.lit(asof))
    start, end = quarter_window(F.col("pattern_quarter"), when)
    state = F.when(when.between(start, end), "EN_CURSO").otherwise(F.concat(F.lit("en "), F.datediff(start, when).cast("string"), F.lit("d")))
    kept = (F.col("n_events") >= least_events) & (share(F.col("_modal"), F.col("n_events")) >= least_share)
    if least_mean is not None:
        kept &= F.col("mean_size") >= least_mean
    return found.filter(kept).select(
        *keys,
        "n_events",
        "n_years",
        "pattern_quarter",
        share(F.col("_modal"), F.col("n_events")).alias("concentration_pct"),
        "mean_size",
        "max_size",
        "last_event",
        start.alias("window_start"),
        end.alias("window_end"),
        state.alias("window_state"),
        F.round(confidence, 2).alias("confidence"),
        "event_days",
    )
