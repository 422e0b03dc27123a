"""Weighted scores of several capped signals, with the reasons told in words."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import scratch
from .keyed import top_per_group

#: Fitted values: weight and cap of each signal; the published weights alone don't give the score.
SIGNALS = {
    "mw_window": (0.41, 35.0),
    "mw_window_18m": (0.124, 30.0),
    "queue_drop": (0.1372, 25.0),
    "mw_stalled": (0.025, 20.0),
    "mw_milestones": (0.06, 15.0),
    "mw_anomaly": (1 / 35, 10.0),
}


def capped_score(signals: Mapping[str, tuple[float, float]] = SIGNALS) -> Column:
    """The sum of weight times signal, each at most its cap; missing signals count 0."""
    return sum((F.least(F.lit(cap), F.lit(float(w)) * F.coalesce(F.col(c), F.lit(0.0))) for c, (w, cap) in signals.items()), F.lit(0.0))


def top_list(df: DataFrame, key: str, n: int, size: str, tie: str, fields: list[str], name: str) -> DataFrame:
    """For each key its ``n`` largest rows as an array, and count and sum before the cut."""
    best = top_per_group(df, [key], n, F.desc_nulls_last(size), F.asc(tie), rank="_rank")
    nested = best.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_rank", *fields))).alias("_list"))
    nested = nested.select(key, F.transform("_list", lambda x: F.struct(*(x[f].alias(f) for f in fields))).alias(name))
    totals = df.groupBy(key).agg(F.count(F.lit(1)).alias(f"n_{name}"), F.sum(size).alias(f"sum_{name}"))
    return totals.join(nested, key)


def ranked(df: DataFrame, by: str, tie: str, n: int | None = None) -> DataFrame:
    """Rows from the highest ``by`` on, ties by ``tie``; with ``n`` only so many, as a report shows them."""
    rows = df.orderBy(F.desc_nulls_last(by), F.asc(tie))
    return rows.limit(n) if n else rows


def numbered(df: DataFrame, by: str, tie: str, rank: str = "rank") -> DataFrame:
    """Rows with their place from the highest ``by`` on, ties by ``tie`` (distinct), from 1: no task orders them all.

    Rows are sorted by ranges and written; a row's place is its place in its range and
    the sizes of the ranges before, of which there are as many as partitions.
    """
    spark = df.sparkSession
    at = fresh_name(df, "_at")
    inorder = df.repartitionByRange(F.desc_nulls_last(by), F.asc(tie)).sortWithinPartitions(F.desc_nulls_last(by), F.asc(tie))
    path = scratch.folder(spark, "numbered")
    inorder.withColumn(at, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    part = F.shiftright(at, 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    met = rows.join(F.broadcast(before), part == F.col("_part"))  # a row for each partition
    return met.withColumn(rank, F.col("_before") + F.col(at).bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop(at, "_part", "_before", "_n")


def fresh_name(df: DataFrame, stem: str) -> str:
    have = {c.lower() for c in df.columns}
    while stem.lower() in have:
        stem += "_"
    return stem


def outcome_words(state: Column) -> Column:
    """The noun for each adverse state."""
    return F.when(state == "denegado", "Denegación").when(state == "desistido", "Desistimiento").when(state == "archivado", "Archivo")


def prediction(chance: Column, direction: Column, mw: Column, mechanism: str, told: Column) -> Column:
    return F.struct(chance.alias("chance"), direction.alias("direction"), mw.cast("double").alias("mw"), F.lit(mechanism).alias("mechanism"), told.alias("told"))


def predictions(df: DataFrame) -> DataFrame:
    """Add ``predictions`` to rows with queue_drop, stalled (array), milestones (array) and anomaly (struct).

    A falling queue gives one, stalled projects and milestones one for each of
    their first two, an anomaly one, surer from a z-score of 3 on.
    """
    whole = lambda c: F.round(c, 0).cast("long").cast("string")
    up = F.lit("up")
    queue = F.when(F.col("queue_drop") > 0, prediction(F.lit("media"), up, F.col("queue_drop"), "decaimiento_tramite", F.concat(whole(F.col("queue_drop")), F.lit(" MW left the queue"))))
    stalled = F.transform(
        F.slice("stalled", 1, 2),
        lambda x: prediction(F.lit("media"), up, x["mw"], "estancado", F.concat(x["p"], F.lit(": "), x["months"].cast("string"), F.lit(" months without news"))),
    )
    due = F.transform(
        F.slice("milestones", 1, 2),
        lambda x: prediction(F.when(x["confidence"] == "ocupada", "alta").otherwise("media"), up, x["mw"], "hito", F.concat(x["p"], F.lit(": "), x["milestone"])),
    )
    odd = F.col("anomaly")
    anomaly = F.when(odd.isNotNull(), prediction(F.when(odd["z"] >= 3.0, "alta").otherwise("media"), odd["dir"], odd["mw"], "anomalia", F.concat(whole(odd["mw"]), F.lit(" MW at once"))))
    return df.withColumn("predictions", F.concat(F.array_compact(F.array(queue)), F.coalesce(stalled, F.array()), F.coalesce(due, F.array()), F.array_compact(F.array(anomaly))))
