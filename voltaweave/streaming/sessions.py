"""Sessions of keyed events: events at most a gap apart belong together, in a table and in a stream alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sessions(events: DataFrame, keys: Sequence[str], at: str, gap: str, *aggregates: Column, late: str | None = None) -> DataFrame:
    """(keys, start, end, n, aggregates) of each session; ``end`` is ``gap`` after its last event.

    For a stream, ``late`` says how long events may be behind the newest one: the state
    holds open sessions that long, a late event may join two of them into one, and
    a session comes out once when no event can change it any more (append mode).
    With all events in time, the stream's sessions are the table's.
    """
    if events.isStreaming:
        if late is None:
            raise ValueError("a stream needs a bound on lateness")
        events = events.withWatermark(at, late)
    made = events.groupBy(F.session_window(at, gap).alias("_session"), *keys).agg(F.count(F.lit(1)).alias("n"), *aggregates)
    rest = [c for c in made.columns if c not in ("_session", *keys)]
    return made.select(*keys, F.col("_session.start").alias("start"), F.col("_session.end").alias("end"), *rest)
