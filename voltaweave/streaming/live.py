"""The merged history kept live: records arrive, change and go in any order, and only the months they touch are merged again.

The state store holds, for each key (such as substation and month) on a shelf of keys, the newest
version of every record, by source and place, and tombstones of those that went.
A late version of a record that is known in a newer one changes nothing, so any
order of arrival ends in what ``operators.keyed.masked_fill_upsert`` makes of the
surviving records at once.

Records have distinct places in their source.  Of two that claim one place and
version, a tombstone wins, then the one whose fields are greater (nulls least).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType

from .watch import upsert_into

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def merged(records: dict[tuple, tuple], fields: Sequence[str], masks: Mapping[int, Sequence[str]]) -> tuple | None:
    """(fields of the merged record, its source) of live records by (source, place): the first is the base, later ones fill what their mask allows."""
    places = sorted(records)
    if not places:
        return None
    out = list(records[places[0]])
    for place in places:  # the base itself is no harm: it has nothing to fill with
        allowed = masks.get(place[0], ())
        for i, f in enumerate(fields):
            if out[i] is None and f in allowed:
                out[i] = records[place][i]
    return (*out, places[0][0])


def _newer(one: tuple, other: tuple) -> bool:
    """Whether (version, gone, fields) comes after another for the same place."""
    if one[:2] != other[:2]:
        return one[:2] > other[:2]
    known = lambda record: (record[0], record[1], [(x is not None, x if x is not None else 0) for x in record[2]])
    return known(one) > known(other)


class LiveMerge(StatefulProcessor):
    """State by shelf of keys: the newest version of each of their records.  A group of the stream is a bucket of shelves, so that a batch asks for few groups."""

    def __init__(self, keys: Sequence[str], fields: Sequence[str], masks: Mapping[int, Sequence[str]], place: Sequence[str], held: StructType, made: StructType):
        self.keys, self.fields, self.masks, self.place = list(keys), list(fields), {s: list(m) for s, m in masks.items()}, list(place)
        self.held, self.made = held, Row(*made.names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.records = handle.getMapState("records", StructType([StructField("shelf", LongType())]), self.held)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timer_values) -> Iterator[Row]:  # noqa: N802
        k, n = len(self.keys), len(self.keys) + len(self.place)
        asked: dict[int, list] = {}
        at: list[int] = []
        for row in rows:
            at = at or [row.__fields__.index(c) for c in ("_shelf", *self.keys, *self.place, "version", "gone", *self.fields)]
            shelf, *one = [row[i] for i in at]
            asked.setdefault(shelf, []).append(one)
        for shelf, ones in asked.items():
            held = self.records.getValue((shelf,))
            known: dict[tuple, dict[tuple, tuple]] = {}
            for r in held[0] if held else ():
                known.setdefault(tuple(r[:k]), {})[tuple(r[k:n])] = (r[n], r[n + 1], tuple(r[n + 2 :]))
            news = {}  # in order of arrival
            for r in ones:
                own, place, one = tuple(r[:k]), tuple(r[k:n]), (r[n], bool(r[n + 1]), tuple(r[n + 2 :]))
                mine = known.setdefault(own, {})
                if place not in mine or _newer(one, mine[place]):
                    mine[place] = one
                    news[own] = mine
            if news:
                self.records.updateValue((shelf,), ([(*own, *place, version, gone, *values) for own, mine in known.items() for place, (version, gone, values) in mine.items()],))
            for own, mine in news.items():
                merge = merged({p: values for p, (_, gone, values) in mine.items() if not gone}, self.fields, self.masks)
                yield self.made(*own, *(merge or (None,) * (len(self.fields) + 1)), merge is not None)

    def close(self) -> None:
        pass


def live_history(
    changes: DataFrame, keys: Sequence[str], fields: Sequence[str], masks: Mapping[int, Sequence[str]], source: str, order: Sequence[str], buckets: int = 1024, shelves: int = 8
) -> DataFrame:
    """(keys, fields, source, present) of every key that a batch of the stream ``changes`` touched.

    ``changes`` has the keys, ``source``, the ``order`` columns (which place a record in its
    source), the fields, ``version`` and ``gone``.  ``masks`` as for ``masked_fill_upsert``.
    A key all of whose records went comes with ``present`` false and null fields.
    Keys are dealt to ``buckets`` groups of ``shelves`` each; a task holds one bucket's rows of a
    batch. The records of a shelf's keys are one value of the state, so calls to the state
    are bounded by the shelves, whatever the keys; a batch rewrites the shelves that it touches.
    """
    rows = changes.select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket"), F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(shelves)).alias("_shelf"),
        *keys, F.col(source).cast("long").alias(source), *(F.col(c).cast("long").alias(c) for c in order), F.col("version").cast("long").alias("version"), "gone", *fields,
    )
    place = [source, *order]
    record = StructType([*(rows.schema[k] for k in keys), *(StructField(c, LongType()) for c in place), StructField("version", LongType()), StructField("gone", BooleanType()), *(rows.schema[f] for f in fields)])
    held = StructType([StructField("records", ArrayType(record))])
    made = StructType([*(rows.schema[k] for k in keys), *(rows.schema[f] for f in fields), StructField(source, LongType()), StructField("present", BooleanType())])
    processor = LiveMerge(keys, fields, masks, place, held, made)
    return rows.groupBy("_bucket").transformWithState(processor, made, outputMode="Update", timeMode="None")


def follow_history(changes: DataFrame, path: str, checkpoint: str, keys: Sequence[str], fields: Sequence[str], masks: Mapping[int, Sequence[str]], source: str, order: Sequence[str], every: str | None = None) -> StreamingQuery:
    """Keep :func:`live_history` of a stream under ``path``, for ``watch.upserted``; all there is once if ``every`` is None.

    The state store survives in ``checkpoint``; a batch that comes again overwrites what it left.
    """
    conf = changes.sparkSession.conf
    before = conf.get("spark.sql.streaming.stateStore.providerClass")
    conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)  # the query copies the settings as it starts
    try:
        writer = live_history(changes, keys, fields, masks, source, order).writeStream.outputMode("update")
        writer = writer.foreachBatch(upsert_into(path, list(keys))).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    finally:
        conf.set("spark.sql.streaming.stateStore.providerClass", before)
