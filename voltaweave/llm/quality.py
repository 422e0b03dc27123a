"""Quality selection by importance resampling.

Two generative models over hashed n-grams are set against each other: the
target (texts labelled as good) and the raw corpus.  A document's log weight is
the log ratio of the probabilities that the two give to its n-grams, as if it had
no more than ``reach`` of them: n-grams of one document are not independent, and
a model's small bias, added up over a long one, would outweigh all evidence (the
README has figures).  With ``reach`` None it is the plain log ratio.  Gumbel noise on the log weights and a
top-k cut draw k documents without replacement with chances in proportion to
the weights: the noise decides between documents whose weights are within a few
units of the cut, and practically never for those far from it.

Three kinds of n-grams share the hashed table: character trigrams, word shapes
(case, digits, marks) in runs of one to three, and whether a word repeats the
one before it.  The raw model counts every document.  The target model and
the cut that sets k are fitted on at most ``SAMPLE`` labelled rows, the
documented bound; those rows' ids and one table of fixed length are all that is
broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, row_digest, ship, sized, text_chunks, written

#: Most labelled rows that the target model is fitted on.
SAMPLE = 20_000
#: Length of the hashed table, a power of two.
BUCKETS = 1 << 16
#: By default, how many n-grams a log weight stands for at most.
REACH = 100.0
#: Bins of the search for the k-th key, and the rows below which it reads them.
BINS, FEW = 4096, 20_000

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return ((x ^ (x >> np.uint32(12))) & np.uint32(BUCKETS - 1)).astype(np.int32)


def _byte_kinds() -> np.ndarray:
    """0 white space, 1 lower case, 2 upper case, 3 digit, 4 beyond ASCII, else a mark of its own."""
    kinds = np.arange(256, dtype=np.uint32) + 16
    kinds[[9, 10, 11, 12, 13, 32]] = 0
    kinds[ord("a") : ord("z") + 1], kinds[ord("A") : ord("Z") + 1] = 1, 2
    kinds[ord("0") : ord("9") + 1], kinds[128:] = 3, 4
    return kinds


_KINDS = _byte_kinds()


def hashed_ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, rows): one entry for each n-gram of each text."""
    datas = [x.encode("utf-8", "replace") for x in texts]
    joined = np.frombuffer(b" ".join(datas) + b" ", np.uint8)
    if not len(texts):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    lengths = np.array([len(x) + 1 for x in datas])
    row = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    c = joined.astype(np.uint32)
    buckets, rows = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    if len(c) >= 3:
        inside = row[:-2] == row[2:]
        buckets.append(_mixed(c[:-2] * _MULTIPLIERS[0] + c[1:-1] * _MULTIPLIERS[1] + c[2:] * _MULTIPLIERS[2])[inside])
        rows.append(row[:-2][inside])
    kind = _KINDS[joined]
    space = kind == 0
    first = np.flatnonzero(~space & np.r_[True, space[:-1]])
    if len(first):
        last = np.flatnonzero(~space & np.r_[space[1:], True])
        owner = row[first]
        # a word's shape: its first, second and last kinds and whether it is short
        size = last - first
        shape = kind[first] * np.uint32(331) + kind[np.minimum(first + 1, last)] * np.uint32(7919)
        shape += kind[last] * np.uint32(104729) + np.minimum(size, 3).astype(np.uint32) * np.uint32(15485863)
        h = np.add.reduceat(np.where(space, np.uint32(0), (c + np.uint32(1)) * np.uint32(2654435761)), first)
        h ^= size.astype(np.uint32)
        again = np.r_[False, (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])]
        shape = (shape + again.astype(np.uint32) * np.uint32(32452843)) * np.uint32(2246822519)
        grams = shape
        for n in range(3):
            if n:
                grams = grams[:-1] * np.uint32(31) + shape[n:]
            if len(grams):
                inside = owner[: len(grams)] == owner[n:]
                buckets.append(_mixed(grams + np.uint32((1 + n) * 40503))[inside])
                rows.append(owner[: len(grams)][inside])
    return np.concatenate(buckets), np.concatenate(rows)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all rows of the column ``text``."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for _, chunk in text_chunks(batches, "text"):
            total += np.bincount(hashed_ngrams(chunk)[0], minlength=BUCKETS)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(there.astype(np.int32)), pa.array(total[there])], names=["bucket", "n"]
        )

    rows = texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BUCKETS, np.float64)
    for r in rows:  # at most BUCKETS rows
        counts[r["bucket"]] = r["n"]
    return counts


def log_ratios(target: np.ndarray, raw: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """The log of the ratio of the two models' probabilities, bucket by bucket.

    Both are smoothed towards the raw distribution, so that a bucket which the
    smaller sample has not met weighs by the evidence that it should have.
    """
    prior = (raw + 1e-9) / (raw.sum() + 1e-9 * len(raw))
    p = (target + smoothing * len(raw) * prior) / (target.sum() + smoothing * len(raw))
    return np.log(np.maximum(p, 1e-12) / np.maximum(prior, 1e-12))


def gumbel(key: Column, seed: int) -> Column:
    """Gumbel noise drawn from a hash of ``key``: the same in every run and on every executor."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def cut_of_top_k(keys: DataFrame, k: int) -> tuple[float, int] | None:
    """(key, tie) of the last of the ``k`` largest rows of (key, tie), ties by smaller tie.

    Histograms narrow the range until few rows are left in the bin that holds
    the k-th; only those come to the driver.  None if there are no k rows.
    """
    lo, hi, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k < 1 or n < k:
        return None
    above = 0
    while True:
        part = keys.filter(F.col("key").between(lo, hi))
        step = (hi - lo) / BINS
        if n <= FEW or not step > abs(lo + hi) * 1e-13:
            break
        at = F.least(F.floor((F.col("key") - F.lit(lo)) / F.lit(step)), F.lit(BINS - 1)).cast("int")
        bins = {r["bin"]: r for r in part.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()}
        for b in sorted(bins, reverse=True):
            if above + bins[b]["n"] >= k:
                lo, hi, n = bins[b]["lo"], bins[b]["hi"], bins[b]["n"]
                break
            above += bins[b]["n"]
    last = part.orderBy(F.desc("key"), F.asc("tie")).limit(k - above).agg(F.min(F.struct(F.col("key"), -F.col("tie"))).alias("x")).first()["x"]
    return float(last[0]), -int(last[1])


def models(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: float | None = REACH) -> tuple[np.ndarray, float]:
    """The log ratio of each bucket, and the log weight that best parts the sample's good rows from its bad ones."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = written(rows.join(F.broadcast(sample), "doc_id"), "labelled-sample")
    target = bucket_counts(sample.filter("quality = 1").select("text"))
    if not target.sum():
        return np.zeros(BUCKETS), -1.0
    ratios = log_ratios(target, bucket_counts(rows.select("text")))
    seen = weighed(sample.select("text", "quality"), "text", ratios, reach).select("quality", "log_weight").toArrow()
    return ratios, best_cut(np.asarray(seen["log_weight"]), np.asarray(seen["quality"]) == 1)


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """Where the share of good rows above, less that of bad ones, is largest; halfway into the gap below."""
    if good.all() or not good.any():
        return float("-inf") if good.any() else -1.0
    order = np.argsort(-weights, kind="stable")
    w, g = weights[order], good[order]
    gain = np.cumsum(g) / g.sum() - np.cumsum(~g) / (~g).sum()
    gain[:-1][w[:-1] == w[1:]] = -1  # rows of one weight go together
    at = int(np.argmax(gain))
    return float((w[at] + w[min(at + 1, len(w) - 1)]) / 2)


def weighed(rows: DataFrame, text_col: str, ratios: np.ndarray, reach: float | None = REACH) -> DataFrame:
    """``rows`` with its text replaced by log_weight and n_grams."""
    table = rows.sparkSession.sparkContext.broadcast(ratios)
    rest = [c for c in rows.columns if c != text_col]
    most = float("inf") if reach is None else reach

    def weigh(batches):
        for batch, texts in text_chunks(batches, text_col):
            buckets, owner = hashed_ngrams(texts)
            n = np.bincount(owner, minlength=len(texts)).astype(np.int64)
            weight = np.bincount(owner, table.value[buckets], minlength=len(texts)) * np.minimum(1, most / np.maximum(n, 1))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(weight), pa.array(n)], names=[*rest, "log_weight", "n_grams"])

    schema = rows.select(*rest).schema.add("log_weight", "double").add("n_grams", "long")
    return rows.mapInArrow(weigh, schema)


def resample(
    docs: DataFrame,
    labels: DataFrame,
    k: int | None = None,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    reach: float | None = REACH,
) -> DataFrame:
    """For each row: doc_id, n_grams, log_weight, sample_key and kept.

    ``k`` rows with the largest keys (log weight plus Gumbel noise) are kept;
    ties go to the smaller id.  By default k is the number of documents whose
    log weight reaches the cut that best parts the labelled sample.  Null and
    empty texts have no n-grams and weigh 0, which is neutral.  Rows that repeat
    an id share their noise; null ids come before others in ties; an id with
    several labels has its best.  With no good label at all every weight is 0
    and all rows are kept.  An empty table gives an empty result.
    """
    return rated(docs, labels, k, seed, id_col, text_col, reach).drop("row")


def rated(docs: DataFrame, labels: DataFrame, k: int | None, seed: int, id_col: str, text_col: str, reach: float | None = REACH) -> DataFrame:
    """The result of :func:`resample` with each row's digest, row."""
    ship(docs.sparkSession)
    ratios, cut_at = models(docs, labels, id_col, text_col, reach)
    rows = docs.select(F.col(id_col).alias("doc_id"), row_digest(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    tie = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**62)))
    scored = weighed(rows, "text", ratios, reach).withColumn("tie", tie)
    scored = written(scored.withColumn("key", F.col("log_weight") + gumbel(F.col("tie"), seed)), "log-weights")
    if k is None:
        k = scored.filter(F.col("log_weight") >= cut_at).count()
    cut = cut_of_top_k(scored.select("key", "tie"), k)
    if cut is None:
        kept = F.lit(k >= 1)
    else:
        kept = (F.col("key") > F.lit(cut[0])) | ((F.col("key") == F.lit(cut[0])) & (F.col("tie") <= F.lit(cut[1])))
    return scored.select("doc_id", "row", "n_grams", "log_weight", F.col("key").alias("sample_key"), kept.alias("kept"))


def select(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`resample` keeps, all columns as they were.

    Rows that repeat id and text stay or go together; other texts of an id go their own way.
    """
    gone_row = fresh(docs, "gone_row")
    gone = rated(docs, labels, None, 42, id_col, text_col).filter("not kept").select(F.col("row").alias(gone_row)).distinct()
    return docs.join(sized(written(gone, "rejected")), row_digest(id_col, text_col) == F.col(gone_row), "left_anti")
