"""Helpers that every operator of this subpackage shares."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Send this package to the executors if their Python would not find it by itself.

    Every operator that runs Python functions calls this first.
    """
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    known = {os.path.realpath(p) for p in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)) if p}
    sc = spark.sparkContext
    if os.path.realpath(root) in known or getattr(sc, "_shipped", None) == package:
        return
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp()), os.path.basename(package))
    sc.addPyFile(shutil.make_archive(archive, "zip", root, os.path.basename(package)))
    sc._shipped = package


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: the cluster's checkpoint folder.

    Only where the session names none and runs in one process (tests, a laptop)
    a temporary folder of this machine is made and set; a cluster must name one.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="voltaweave-")
        sc.setCheckpointDir(found)
        found = sc.getCheckpointDir()
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    A lost executor then costs a re-read, and the planner knows the table's size.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder wherever Spark reads it."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def forget(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` that no plan will read again."""
    for t in tables:
        remove(t.sparkSession, t._written_to)


#: Up to so many ids or digests (8 or 16 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 2_000_000


def sized(ids: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The written table ``ids``, to be broadcast if it is counted to have few enough rows."""
    return F.broadcast(ids) if ids.count() <= most else ids


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def digest(*columns: Column | str) -> Column:
    """A 128-bit digest of some values: rows that share it are taken for one."""
    return F.struct(F.xxhash64(*columns).alias("lo"), F.xxhash64(F.lit(1), *columns).alias("hi"))


def row_digest(id_col: str, text_col: str) -> Column:
    """A digest of id and text: rows that share it get the same answer."""
    return digest(F.col(id_col), text_or_empty(text_col))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet, whatever its case."""
    have = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in have:
        name += "_"
    return name


def text_chunks(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = 4_000_000
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches so that each piece has about ``limit`` bytes of text.

    A row is never cut; null texts come out as empty strings.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        texts = [x or "" for x in column.to_pylist()]
        start = size = 0
        for i, x in enumerate(texts):
            size += len(x)
            if size >= limit:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, size = i + 1, 0
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def blocked(block: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Packed rows by block, as (block, data), 256 blocks a batch."""
    order = np.argsort(block, kind="stable")
    block, rows = block[order], rows[order]
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.zeros(0, int)
    ends = np.r_[starts[1:], len(block)]
    for at in range(0, len(starts), 256):
        cut = list(zip(starts[at : at + 256], ends[at : at + 256], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(block[a]) for a, _ in cut], pa.int32()), pa.array([rows[a:b].tobytes() for a, b in cut], pa.binary())],
            names=["block", "data"],
        )


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, text), keys being the ids; or, if these are no distinct integers, (doc_id, key, text) with keys in the order of id and text.

    In the first case the key can't be null, which keeps every shuffle of the texts by key one and the same.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    whole = docs.schema[id_col].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    if whole and ids.filter("n > 1 or doc_id is null").isEmpty():
        return rows.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("key"), "text")
    digest = F.sha2("text", 256)
    distinct = rows.select(F.col("doc_id").alias("ranked_id"), digest.alias("ranked_digest")).distinct()
    ranks = distinct.orderBy(F.asc_nulls_first("ranked_id"), "ranked_digest").withColumn("key", F.monotonically_increasing_id())
    same = F.col("doc_id").eqNullSafe(F.col("ranked_id")) & (digest == F.col("ranked_digest"))
    return written(rows.join(written(ranks, "ranks"), same).select("doc_id", "key", "text"), "keyed")
