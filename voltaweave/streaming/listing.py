"""Folders watched by their listings: what was added, rewritten in any direction, removed or brought back since the last tick.

A file source sees new paths only.  Here each tick lists the folder and holds it
against the state of the tick before: path, modification time, length and
digest, with tombstones for files that went.  A file whose time moved, forwards or
backwards, is read; if its digest is the same it was only touched.  A tick is one
commit: its changes are written under its number, so one that failed is done again
and overwrites what it left; the state is all changes so far (``watch.upsert_into``).

Spark's file sources pass over empty files, so a file that is emptied counts as
removed, and an empty one as not there yet.  Another text of the same length under
the same modification time isn't noticed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .watch import upsert_into, upserted

#: Up to so many files are asked for by name when they have to be read; of more, the whole folder is read and joined.
NAMED = 10_000
STATE = "path string, modified timestamp, length long, digest string, gone boolean, kind string, tick long"
_NOTE = ["modified", "length", "digest", "gone"]


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modified, length) of every file below ``folder``, without reading any."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def digested(spark: SparkSession, folder: str, listing: DataFrame, before: DataFrame) -> DataFrame:
    """``listing`` with digests: those known from ``before`` where time and length are the same, others by reading the files."""
    known = before.filter("not gone").select("path", "modified", "length", "digest")
    old = listing.join(known, ["path", "modified", "length"], "left")
    new = old.filter("digest is null").select("path")
    names = [r.path for r in new.limit(NAMED + 1).collect()]  # at most so many: only then are files asked for by name
    if not names:
        return old
    files = spark.read.format("binaryFile")
    read = files.load(names) if len(names) <= NAMED else files.option("recursiveFileLookup", "true").load(folder).join(new, "path", "left_semi")
    read = read.select("path", F.sha2("content", 256).alias("read"))
    return old.join(read, "path", "left").select("path", "modified", "length", F.coalesce("digest", "read").alias("digest"))


def diff(before: DataFrame, now: DataFrame) -> DataFrame:
    """(path, modified, length, digest, gone, kind) of each path that isn't as it was.

    ``before`` has tombstones (``gone``), ``now`` has not.  Kinds: added, returned (after
    its removal), changed (another digest), touched (the same digest at another time)
    and removed.  What is removed keeps its last time, length and digest.
    """
    b, n = F.struct(*(F.col(c) for c in _NOTE)).alias("b"), F.struct("modified", "length", "digest").alias("n")
    met = before.select("path", b).join(now.select("path", n), "path", "full")
    kind = (
        F.when(F.col("n").isNull(), F.when(~F.col("b.gone"), "removed"))
        .when(F.col("b").isNull(), "added")
        .when(F.col("b.gone"), "returned")
        .when(~F.col("b.digest").eqNullSafe(F.col("n.digest")), "changed")
        .when(~F.col("b.modified").eqNullSafe(F.col("n.modified")), "touched")
    )
    one = lambda c: F.when(F.col("n").isNull(), F.col(f"b.{c}")).otherwise(F.col(f"n.{c}")).alias(c)
    made = met.select("path", one("modified"), one("length"), one("digest"), F.col("n").isNull().alias("gone"), kind.alias("kind"))
    return made.filter("kind is not null")


def state(spark: SparkSession, path: str, tick: int) -> DataFrame:
    """All paths ever seen as of a tick, tombstones included; before the first tick there are none."""
    return upserted(spark, path, tick, ["path"]) if tick >= 0 else spark.createDataFrame([], STATE)


def step(now: DataFrame, path: str, tick: int) -> DataFrame:
    """Commit what changed between the state of the tick before and the listing ``now``, which has digests; those changes."""
    changes = diff(state(now.sparkSession, path, tick - 1), now).withColumn("tick", F.lit(tick).cast("long"))
    upsert_into(path, ["path"])(changes, tick)
    return now.sparkSession.read.schema(STATE).parquet(f"{path}/changes/batch={tick}")


def follow(spark: SparkSession, folder: str, path: str, publish: Callable[[DataFrame, int], None], checkpoint: str, every: str = "5 seconds") -> StreamingQuery:
    """Hand the changes of each tick that has any to ``publish(changes, tick)``, all of a tick at once.

    A stream of seconds is the clock; its checkpoint holds the number of the tick.
    """

    def on_tick(_: DataFrame, tick: int) -> None:
        now = digested(spark, folder, listed(spark, folder), state(spark, path, tick - 1))
        changes = step(now, path, tick)
        if not changes.isEmpty():
            publish(changes, tick)

    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    return clock.writeStream.foreachBatch(on_tick).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
