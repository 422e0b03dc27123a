"""Causes and later jumps: interval matching, lag statistics and adverse-event forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_index(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def interval_match(causes: DataFrame, effects: DataFrame, key: str, at: str, then: str, within: int, least: float, ratio: tuple[float, float], size: str, effect_size: str) -> DataFrame:
    """Pairs of a cause and an effect of one key, the effect up to ``within`` units later.

    ``at`` and ``then`` are whole numbers (months, days).  Effects of less than
    ``least`` don't count; their size over the cause's lies in ``ratio``, a
    cause of unknown size fits any.  An equi-join on the key and the bin of
    time, so a long series of a hot key is spread over its bins.
    """
    bins = F.explode(F.array(F.floor(F.col(at) / within), F.floor(F.col(at) / within) + 1))
    left = causes.select(F.col(key).alias("_key"), "*", bins.alias("_bin")).drop(key)
    right = effects.filter(F.col(effect_size) >= least).withColumn("_bin", F.floor(F.col(then) / within))
    lag = F.col(then) - F.col(at)
    share = F.round(F.col(effect_size) / F.nullif(F.col(size), F.lit(0.0)), 2)
    exact = F.col(effect_size) / F.nullif(F.col(size), F.lit(0.0))
    near = lag.between(1, within) & (F.col(size).isNull() | exact.between(*ratio))
    return (
        left.join(right, (F.col("_key") == F.col(key)) & (left["_bin"] == right["_bin"]))
        .filter(near)
        .drop(left["_bin"])
        .drop(right["_bin"])
        .drop("_key")
        .withColumns({"lag": lag, "ratio": share})
    )


def lag_quantiles(lags: DataFrame, lag: str) -> DataFrame:
    """n, p25, median, p75, least and most of a column, each a value that occurs."""
    disc = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {lag})")
    return lags.agg(
        F.count(lag).alias("n"), disc(0.25).alias("p25"), disc(0.5).alias("median"), disc(0.75).alias("p75"), F.min(lag).alias("least"), F.max(lag).alias("most")
    )


def lag_bands(lags: DataFrame, lag: str, width: int) -> DataFrame:
    """Counts of lags by bands of ``width``: band 1 has 1 to ``width``, and so on."""
    return lags.groupBy(F.ceil(F.col(lag) / width).cast("int").alias("band")).agg(F.count(F.lit(1)).alias("n"))


def adverse_forecast(cases: DataFrame, asof: str, p25: int, most: int) -> DataFrame:
    """The window in which capacity is expected after an adverse decision.

    ``cases`` has adverse_day, real_lag (days or null), source and technology.
    Confirmed cases have the one day adverse_day + real_lag; others the span
    from adverse_day + ``p25``, not before ``asof``, to adverse_day + ``most``,
    which may end before it starts: such rows are overdue.  Confirmations from
    a published text have the chance 75, those from the owner's history 100.
    """
    when, known = F.to_date(F.lit(asof)), F.col("real_lag").isNotNull()
    happened = F.date_add("adverse_day", F.col("real_lag").cast("int"))
    return cases.withColumns(
        {
            "window_start": F.when(known, happened).otherwise(F.greatest(when, F.date_add("adverse_day", p25))),
            "window_end": F.when(known, happened).otherwise(F.date_add("adverse_day", most)),
            "window_state": F.when(known, "CONFIRMADO").when(when > F.date_add("adverse_day", p25), "SOBREPLAZO").otherwise("PENDIENTE"),
            "chance": F.when(known, F.when(F.col("source") == "boe_texto", 75).otherwise(100)),
            "technology_kind": F.when(F.upper("technology").contains("BESS"), "gen+alm").otherwise("gen"),
        }
    )
