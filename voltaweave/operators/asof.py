"""The latest record at or before each event, by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_before(
    events: DataFrame, records: DataFrame, keys: Sequence[str], at: str, fields: Sequence[str], order: Sequence[str] = (), width: float = 86_400, within: float | None = None, prefix: str = "last_"
) -> DataFrame:
    """``events`` with ``fields`` (and ``at``) of the latest record of their keys whose time is not after theirs, null if there is none.

    Both tables have the ``keys`` and the timestamp ``at``; of records at one time the
    last by ``order``, columns of ``records``, counts.  Records older than ``within``
    seconds don't count.  Null keys equal each other; records without a time are left
    out, events without one find nothing.

    Events and records are sorted together by (keys, span of ``width`` seconds), so that
    a hot key is spread over its spans, and carry the last record on.  What a span
    starts with is the last record of an earlier one: one row for each key and span.
    """
    when = F.col(at).cast("timestamp")
    span = F.floor(F.unix_micros(when) / (width * 1_000_000)).alias("_span")
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    by = [f"_k{i}" for i in range(len(keys))]
    rest = [c for c in events.columns if c not in keys]
    record = F.struct(F.col(at).alias(at), *(F.col(f).alias(f"f{i}") for i, f in enumerate(fields)))
    place = F.struct(*(F.col(c) for c in order)) if order else F.lit(0)
    r = records.filter(F.col(at).isNotNull()).select(*named, span, when.alias("_at"), F.lit(0).alias("_kind"), record.alias("_record"), place.alias("_place"))
    e = events.select(*named, span, when.alias("_at"), F.lit(1).alias("_kind"), F.struct(*rest).alias("_event"))
    both = r.unionByName(e, allowMissingColumns=True)

    along = Window.partitionBy(*by, "_span").orderBy("_at", "_kind", "_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("_inside", F.last("_record", ignorenulls=True).over(along)).filter("_kind = 1")

    spans = both.groupBy(*by, "_span").agg(F.max_by("_record", F.when(F.col("_kind") == 0, F.struct("_at", "_place"))).alias("_tail"))
    before = Window.partitionBy(*by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select(*(F.col(k).alias(f"c{k}") for k in by), F.col("_span").alias("c_span"), F.last("_tail", ignorenulls=True).over(before).alias("_carried"))
    same = F.col("_span") == F.col("c_span")
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"c{k}"))
    found = seen.join(carried, same, "left").withColumn("_found", F.coalesce("_inside", "_carried"))
    fresh = F.lit(True) if within is None else F.unix_micros("_at") - F.unix_micros(F.col(f"_found.{at}").cast("timestamp")) <= within * 1_000_000
    of = {at: at} | {f: f"f{i}" for i, f in enumerate(fields)}
    return found.select(
        *(F.col(k).alias(name) for k, name in zip(by, keys, strict=True)), *(F.col("_event")[c].alias(c) for c in rest),
        *(F.when(fresh & F.col("_at").isNotNull(), F.col("_found")[inner]).alias(f"{prefix}{name}") for name, inner in of.items()),
    )
