"""Exact deduplication with counting quotient filters.

Each partition builds a counting quotient filter of its texts' 64-bit
fingerprints: a fingerprint's high bits name a slot (its quotient), the low
bits are the remainder, and every slot keeps a run of sorted remainders with
counts.  Only occupied slots are stored, each with the length of its run, so a
filter is as large as what it holds, however many slots there are.  No bit of a
fingerprint is lost, so filters merge without loss: the same slots of two
filters are merged as sorted runs and equal remainders add their counts.  Slots
travel in blocks, one group for each block, so that no task sees more than one
block.  A filter holds a text once however many copies
its partition has, so a group of copies, however large, adds one entry for each
partition.

Fingerprints counted more than once only route rows to verification, which
groups on the bytes of the text.  The rest are alone by construction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, ship, written

FINGERPRINTS_PER_BLOCK = 32_768
SLOT_BITS = 12
#: Fingerprints that go into one filter; a larger partition makes several.
FILTER_SIZE = 4_000_000


def filter_blocks(fingerprints: np.ndarray, block_bits: int) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
    """A counting quotient filter as (block, slots, runs, remainders, counts).

    ``slots`` has a block's occupied slots, ``runs`` how many remainders each has.
    """
    values, counts = np.unique(fingerprints.astype(np.uint64), return_counts=True)
    if not len(values):
        return
    rest = np.uint64(64 - block_bits - SLOT_BITS)
    places = (values >> rest).astype(np.int64)  # block and slot
    remainders = values & np.uint64((1 << int(rest)) - 1)
    first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
    runs = np.diff(np.r_[first, len(values)]).astype(np.uint32)
    blocks = places[first] >> SLOT_BITS
    slots = (places[first] & ((1 << SLOT_BITS) - 1)).astype(np.uint16)
    starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
    for a, b in zip(starts, [*starts[1:], len(blocks)], strict=True):
        lo, hi = first[a], first[b] if b < len(first) else len(values)
        yield int(blocks[a]), slots[a:b].tobytes(), runs[a:b].tobytes(), remainders[lo:hi].tobytes(), counts[lo:hi].astype(np.uint64).tobytes()


def merge_blocks(block: int, parts: list[tuple[bytes, bytes, bytes, bytes]], block_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of one block and their summed counts, from all filters."""
    rest = 64 - block_bits - SLOT_BITS
    slots, runs, remainders, n = (np.frombuffer(b"".join(x), kind) for x, kind in zip(zip(*parts, strict=True), ("<u2", "<u4", "<u8", "<u8"), strict=True))
    keys = (np.repeat(slots.astype(np.uint64), runs) << np.uint64(rest)) | remainders
    merged, where = np.unique(keys, return_inverse=True)
    total = np.zeros(len(merged), np.uint64)
    np.add.at(total, where, n)
    if block_bits:
        merged |= np.uint64(block) << np.uint64(64 - block_bits)
    return merged, total


def repeated_fingerprints(fps: DataFrame, rows: int) -> DataFrame:
    """The values of the long column ``fp`` that occur more than once, as (fp, n)."""
    ship(fps.sparkSession)
    block_bits = max(3, min(24, (rows // FINGERPRINTS_PER_BLOCK).bit_length()))
    names = ["block", "slots", "runs", "remainders", "counts"]

    def build(batches):
        held, n = [], 0

        def send():
            made = filter_blocks(np.concatenate(held), block_bits)
            while part := list(islice(made, 256)):
                block, *blobs = zip(*part, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), *(pa.array(x, pa.binary()) for x in blobs)], names=names)

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            n += batch.num_rows
            if n >= FILTER_SIZE:
                yield from send()
                held, n = [], 0
        if held:
            yield from send()

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = list(zip(*(pdf[c] for c in names[1:]), strict=True))
        values, n = merge_blocks(int(pdf["block"].iloc[0]), parts, block_bits)
        more = n > 1
        return pd.DataFrame({"fp": values[more].view(np.int64), "n": n[more].astype(np.int64)})

    return (
        fps.select("fp")
        .mapInArrow(build, "block int, slots binary, runs binary, remainders binary, counts binary")
        .groupBy("block")
        .applyInPandas(merge, "fp long, n long")
    )


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: id, keep_id, group_size, kept and text_sha256.

    A null text counts as empty, and empty texts equal each other.  Of equal
    texts the largest id stays; rows that repeat both text and id are all
    marked as kept, since nothing tells them apart.  Null ids lose to any other
    and stay only in groups that have no other.  An empty table gives an empty
    result.  Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    fps = rows.select(F.xxhash64("text").alias("fp"))
    routed = written(repeated_fingerprints(fps, docs.count()), "repeated-fingerprints").select("fp")
    groups = (
        rows.withColumn("fp", F.xxhash64("text"))
        .join(routed, "fp", "left_semi")
        .groupBy("fp", "text")
        .agg(F.max("doc_id").alias("largest"), F.count(F.lit(1)).alias("n"))
        .select(F.sha2("text", 256).alias("text_sha256"), "largest", "n")
    )
    digests = rows.select("doc_id", F.sha2("text", 256).alias("text_sha256"))
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("largest"))
    return digests.join(groups, "text_sha256", "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were.

    The row with the largest id stays; of rows that also repeat the id, one.
    Rows that no other shares a fingerprint with pass without a further shuffle.
    """
    fp, digest = fresh(docs, "text_fp"), fresh(docs, "text_digest")
    winner_id, winner_digest = fresh(docs, "winner_id"), fresh(docs, "winner_digest")
    text = F.coalesce(F.col(text_col), F.lit(""))
    routed = written(
        repeated_fingerprints(docs.select(F.xxhash64(text).alias("fp")), docs.count()), "repeated-fingerprints"
    ).select(F.col("fp").alias(fp))
    marked = docs.withColumn(fp, F.xxhash64(text))
    shared = marked.join(routed, fp, "left_semi").withColumn(digest, F.sha2(text, 256))
    winners = (
        shared.select(F.col(digest).alias(winner_digest), text.alias("text"), F.col(id_col).alias("id"))
        .groupBy(winner_digest, "text")
        .agg(F.max("id").alias(winner_id))
        .drop("text")
    )
    # the key holds the id, so a large group of copies is spread over all partitions
    won = F.col(id_col).eqNullSafe(F.col(winner_id)) & (F.col(digest) == F.col(winner_digest))
    kept = shared.join(winners, won, "left_semi").dropDuplicates([id_col, digest]).drop(digest)
    return marked.join(routed, fp, "left_anti").unionByName(kept).drop(fp)
