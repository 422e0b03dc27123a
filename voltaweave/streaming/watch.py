"""Continuous ingestion: landing files, small batches, and a backfill by days.

A file source sees new paths only.  Producers land each version of a file under
a new name; rewriting a file in place is not noticed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import last_wins
from .. import scratch


def watch(
    spark: SparkSession, folder: str, schema: str, publish: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = "5 seconds", fmt: str = "parquet"
) -> StreamingQuery:
    """Hand all files that arrived since the last tick to ``publish(batch, batch_id)``.

    With ``every`` None whatever is there is read once.  The checkpoint, in a
    shared folder, holds what was seen; a batch that failed comes again under
    its number, so ``publish`` overwrites by number to be exactly once.
    """
    stream = spark.readStream.format(fmt).schema(schema).load(folder)
    writer = stream.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def upsert_into(path: str, keys: list[str], *order: str, every: int = 100) -> Callable[[DataFrame, int], None]:
    """A publisher that keeps the last record of each key under ``path``; :func:`upserted` reads them.

    A batch writes its own records only, and each ``every`` batches all are
    merged into one table, so a tick costs what arrived.  Everything is written
    by batch number: one that comes again overwrites what it left.  Of equal
    ``order`` the later batch wins.  Without ``order`` a key comes once a batch.
    What a merge has taken in goes one merge later, when no batch can ask for it again.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        (last_wins(batch, keys, *(F.col(c) for c in order)) if order else batch).write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id}")
        if (batch_id + 1) % every == 0:
            upserted(spark, path, batch_id, keys, *order, every=every).write.mode("overwrite").parquet(f"{path}/merged/batch={batch_id}")
            for spent in range(batch_id - 2 * every + 1, batch_id - every + 1):
                scratch.remove(spark, f"{path}/changes/batch={spent}")
            scratch.remove(spark, f"{path}/merged/batch={batch_id - 2 * every}")

    return publish


def upserted(spark: SparkSession, path: str, batch_id: int, keys: list[str], *order: str, every: int = 100) -> DataFrame:
    """The last record of each key as of batch ``batch_id`` of :func:`upsert_into`: the newest merged table before it and the changes since."""
    start = batch_id // every * every
    parts = [(f"{path}/changes/batch={i}", i) for i in range(start, batch_id + 1)]
    if start:
        parts.insert(0, (f"{path}/merged/batch={start - 1}", start - 1))
    rows = [spark.read.parquet(p).withColumn("_batch", F.lit(i)) for p, i in parts]
    return last_wins(reduce(DataFrame.unionByName, rows), keys, *(F.col(c) for c in order), F.col("_batch")).drop("_batch")


def windowed_counts(stream: DataFrame, at: str, width: str, late: str, *by: str) -> DataFrame:
    """Counts in tumbling windows; rows later than ``late`` behind the newest are dropped.

    An extension: the system that this follows has no event time.
    """
    return stream.withWatermark(at, late).groupBy(F.window(at, width), *by).agg(F.count(F.lit(1)).alias("n"))


def backfill(df: DataFrame, days: DataFrame, day: str, path: str) -> None:
    """Rewrite the partitions of the listed ``days`` (one column, yyyyMMdd) and no others."""
    wanted = days.select(F.to_date(days.columns[0], "yyyyMMdd").alias("_wanted")).distinct()
    rows = df.join(wanted, F.to_date(day) == F.col("_wanted"), "left_semi")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def changes(versions: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of a history of versions that differ from the one before of their key."""
    rest = [c for c in versions.columns if c not in (*keys, order)]
    state = F.xxhash64(*rest)
    before = F.lag(state).over(Window.partitionBy(*keys).orderBy(order))
    return versions.withColumn("_same", before.isNotNull() & (before == state)).filter("not _same").drop("_same")
