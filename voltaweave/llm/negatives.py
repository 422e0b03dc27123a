"""Hard negatives: for an anchor and a row of its label, the best rows of other labels within a window of scores.

Candidates are sorted by norm and packed into stripes, whose rows are searched
bucket by bucket, longest vectors first.  By Cauchy and Schwarz no row of a bucket
scores more than the anchor's norm times the bucket's greatest, so a bucket is
passed over by every anchor whose window begins above that, or that has enough
better rows already; and a whole stripe isn't sent to a block of anchors that it
can't serve.  Positives are found in stripes by label and norm, negatives in
stripes by norm alone.

The anchors, which are the stated queries, meet all rows in blocks: a task holds one
block of anchors and one stripe, and carries a block's best rows on to its next
stripe.  A ranked window over all tasks' best rows is the answer.

Components become whole numbers, floor(256 * x), and scores are exact inner products:
in doubles where these can't round, else in integers of any size (scores beyond a
long come out as the nearest long).  Vectors of unequal lengths are compared as if
zeros followed the shorter.  Rows with a null label, a null vector or a component
that is null or not finite take no part.  Rows are told apart by themselves, not by
id: a repeated row is another row, and a repeated anchor answers twice.  Null ids
come last among ties.  Anchors without a positive, or without a row in the window,
give no rows; so do empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, ship, written

BUCKET, STRIPE, BLOCK = 1024, 8192, 4096
#: Blocks that a task makes, and stripes that it searches, at least: so that these are full, and it has best rows to carry on.
STRIPES = 4
#: Components that a stripe or block holds at most, whatever its rows (but one row at least).
COMPONENTS = 1 << 21
#: Up to so many blocks of anchors are broadcast, and held by a task; more are joined by shuffle.
BROADCAST_BLOCKS = 8
#: Over so many parts the stripes' norms are dealt when blocks look for those that can serve them.
SHARDS = 64
NO_ID = 2**63 - 1
EXACT = float(1 << 53)

PACK = "stripe long, norm double, need double, labels array<long>, wide int, kind string, ids binary, rows binary, row_labels binary, vectors binary, scores binary"


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str, *more: Column) -> DataFrame:
    """(row, id, label, vector, norm, ...) of the rows that take part, each with a number of its own."""
    vector = F.col(vector_col)
    whole = F.col(label_col).isNotNull() & vector.isNotNull()
    whole = whole & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x))

    def component(x: Column) -> Column:  # doubles of that size have no fraction, and a long may not hold them
        y = x.cast("double") * 256
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)

    square = F.aggregate(vector, F.lit(0.0), lambda total, x: total + component(x) * component(x))
    made = rows.filter(whole).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(label_col).cast("long").alias("label"), vector.cast("array<double>").alias("vector"), square.alias("norm"), *more
    )
    return written(made.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _matrix(column: pa.Array, missing: float) -> np.ndarray:
    """The lists of a column as rows of one matrix, shorter ones filled up."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.full((len(sizes), int(sizes.max(initial=0))), missing, flat.dtype if len(flat) else float)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _stacked(parts: list[np.ndarray], missing: float) -> np.ndarray:
    wide = max(x.shape[1] for x in parts)
    return np.concatenate([np.pad(x, ((0, 0), (0, wide - x.shape[1])), constant_values=missing) for x in parts])


def packed(rows: DataFrame, most: int, number: int, *order: Column) -> DataFrame:
    """``number`` rows in ``order`` (range partitions, so that one label or norm can fill many) as blocks of at most ``most``, longest first.

    Tasks with too few rows for ``STRIPES`` blocks are put together.
    """
    ship(rows.sparkSession)
    if "scores" not in rows.columns:
        rows = rows.withColumn("scores", F.lit(None).cast("array<long>")).withColumn("need", F.lit(0.0))
    rows = rows.select("id", "row", "label", "need", "vector", "scores", "norm").repartitionByRange(*order, "row").sortWithinPartitions(*order, "row")
    rows = rows.coalesce(max(1, -(-number // (most * STRIPES))))
    names = [x.split()[0] for x in PACK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32

        def block(parts: list[tuple]) -> pa.RecordBatch:
            nonlocal made
            ids, row, labels, need = (np.concatenate([p[i] for p in parts]) for i in range(4))
            vectors, scores = _stacked([p[4] for p in parts], 0.0), _stacked([p[5] for p in parts], -1)
            norms = np.sqrt((vectors * vectors).sum(1))
            longest = np.argsort(-norms, kind="stable")
            kind = "<i2" if np.abs(vectors).max(initial=0) < 1 << 15 else "<f8"
            values = [made, float(norms.max()), float(need.min()), np.unique(labels).tolist(), vectors.shape[1], kind]
            values += [x[longest].astype(k).tobytes() for x, k in ((ids, "<i8"), (row, "<i8"), (labels, "<i8"), (vectors, kind), (scores, "<i8"))]
            made += 1
            return pa.RecordBatch.from_pylist([dict(zip(names, values, strict=True))], schema)

        held, size = [], 0
        for batch in batches:
            plain = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            vectors, scores = np.floor(_matrix(batch.column(4), 0.0).astype(float) * 256), _matrix(batch.column(5), -1)
            limit, at = max(1, min(most, COMPONENTS // max(1, vectors.shape[1]))), 0
            while at < batch.num_rows:
                if held and size >= limit:
                    yield block(held)
                    held, size = [], 0
                end = min(batch.num_rows, at + limit - size)
                held.append((*(x[at:end] for x in plain), vectors[at:end], scores[at:end]))
                size, at = size + end - at, end
        if held:
            yield block(held)

    kinds = {"long": pa.int64(), "double": pa.float64(), "array<long>": pa.list_(pa.int64()), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in PACK.split(", ")])
    return written(rows.mapInArrow(run, PACK), "packed")


class _Block:
    """One value of :func:`packed`, unpacked."""

    def __init__(self, row: dict, prefix: str):
        read = lambda name, kind: np.frombuffer(row[prefix + name], kind)
        self.ids, self.rows, self.labels = read("ids", "<i8"), read("rows", "<i8"), read("row_labels", "<i8")
        self.vectors = read("vectors", row[prefix + "kind"]).reshape(len(self.ids), row[prefix + "wide"]).astype(float)
        self.scores = read("scores", "<i8").reshape(len(self.ids), -1)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(1))


def _ranked(scores: np.ndarray) -> np.ndarray:
    return np.unique(scores, return_inverse=True)[1] if scores.dtype == object else scores


def _first(key: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the first ``k`` of their key, in order: higher scores, then smaller ids."""
    order = np.lexsort((rows, ids, -_ranked(scores), key))
    sorted_key = key[order]
    new = np.flatnonzero(np.r_[True, sorted_key[1:] != sorted_key[:-1]]) if len(key) else np.zeros(0, int)
    place = np.arange(len(key)) - np.repeat(new, np.diff(np.r_[new, len(key)]))
    return order[place < k]


Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _kth(found: Found, n: int, windows: int, k: int, kind: type) -> np.ndarray:
    """The k-th score of each window, which later rows have to reach, or minus infinity."""
    kth = np.full((n, windows), -np.inf, kind)
    full = np.flatnonzero(np.bincount(found[0], minlength=n * windows) >= k)
    kth.reshape(-1)[full] = found[1][np.searchsorted(found[0], full, side="right") - 1]  # found is sorted by key
    return kth


def searched(a: _Block, b: _Block, low: np.ndarray, high: np.ndarray, same: bool, k: int, found: Found | None = None) -> Found:
    """(anchor * windows + window, score, id, row) of the first ``k`` rows in each window of each anchor: of ``b`` and those ``found`` before.

    Row i of ``low`` and ``high`` has the windows of anchor i; ``same`` tells whether
    its own label is wanted or any other.
    """
    n, windows = low.shape
    wide = max(a.vectors.shape[1], b.vectors.shape[1])
    u, v = (np.pad(x.vectors, ((0, 0), (0, wide - x.vectors.shape[1]))) for x in (a, b))
    kind = float if wide * np.abs(u).max(initial=0) * np.abs(v).max(initial=0) < EXACT else object
    if kind is object:
        u, v = (np.array([[int(c) for c in r] for r in x], object).reshape(x.shape) for x in (u, v))
    dead = low > high
    found = found or (np.zeros(0, np.int64), np.zeros(0, kind), np.zeros(0, np.int64), np.zeros(0, np.int64))
    for start in range(0, len(b.ids), BUCKET):
        end = min(start + BUCKET, len(b.ids))
        kth = _kth(found, n, windows, k, object if found[1].dtype == object else kind)
        need = np.where(dead, np.inf, np.maximum(low, kth)).min(1)
        active = np.flatnonzero((a.norms * b.norms[start] * (1 + 1e-9) + 1e-6 >= need).astype(bool))
        if not len(active):
            break  # the rows that follow are shorter still
        parts = [found]
        for at in range(0, len(active), 256):
            some = active[at : at + 256]
            scores = u[some] @ v[start:end].T
            fits = ((a.labels[some][:, None] == b.labels[None, start:end]) == same) & (scores >= need[some][:, None]).astype(bool)
            if same:
                fits &= a.rows[some][:, None] != b.rows[None, start:end]
            i, j = np.nonzero(fits)
            s, i, j = scores[i, j], some[i], j + start
            for w in range(windows):
                inside = ~dead[i, w] & (s >= low[i, w]) & (s <= high[i, w]) & (s >= kth[i, w])
                parts.append((i[inside] * windows + w, s[inside], b.ids[j[inside]], b.rows[j[inside]]))
        key, score, ids, rows = (np.concatenate(x) for x in zip(*parts, strict=True))
        keep = _first(key, score, ids, rows, k)
        found = key[keep], score[keep], ids[keep], rows[keep]
    return found


def _limits(scores: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of whole scores from ``least`` to ``most`` per cent of positive scores; -1 stands for none."""
    low = [[-(-least * int(s) // 100) for s in r] for r in scores]
    high = [[most * int(s) // 100 if s >= 0 else -2 for s in r] for r in scores]
    kind = float if np.abs(scores).max(initial=0) < EXACT / 100 else object
    return np.array(low, kind).reshape(scores.shape), np.array(high, kind).reshape(scores.shape)


def _met(blocks: DataFrame, stripes: DataFrame, pairs: DataFrame, rows: int) -> DataFrame:
    """Rows of a block and a stripe each, for ``pairs`` of (block, stripe); a task takes about ``STRIPES`` times a stripe's rows, of ``rows`` in all."""
    a = blocks.select(F.col("stripe").alias("block"), *(F.col(c).alias(f"a_{c}") for c in blocks.columns if c not in ("stripe", "labels", "norm", "need")))
    b = stripes.select("stripe", *(F.col(c).alias(f"b_{c}") for c in stripes.columns if c not in ("stripe", "labels", "norm", "need")))
    number = blocks.count()
    a = F.broadcast(a) if number <= BROADCAST_BLOCKS else a
    return pairs.join(b, "stripe").join(a, "block").coalesce(max(1, number * -(-rows // (STRIPES * STRIPE))))


BEST = "anchor_row long, window int, row long, id long, score long"


def _best(met: DataFrame, same: bool, k: int, least: int, most: int) -> DataFrame:
    """The first ``k`` rows of each window.  A task carries what it found of a block from stripe to stripe, for some blocks at once."""

    def told(block: _Block, windows: int, found: Found) -> pa.RecordBatch:
        key, score, ids, rows = found
        score = np.array([max(-NO_ID, min(NO_ID, int(s))) for s in score], np.int64)
        columns = [block.rows[key // windows], (key % windows).astype(np.int32), rows, ids, score]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[x.split()[0] for x in BEST.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}  # block -> its anchors, windows and what was found
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: c[i].as_py() for name, c in zip(batch.schema.names, batch.columns, strict=True)}
                if row["block"] in held:
                    a, low, high, found = held.pop(row["block"])
                else:
                    a, found = _Block(row, "a_"), None
                    low, high = (np.full((len(a.ids), 1), x * np.inf) for x in (-1, 1)) if same else _limits(a.scores, least, most)
                    while len(held) >= BROADCAST_BLOCKS:
                        first, before, _, best = held.pop(next(iter(held)))
                        yield told(first, before.shape[1], best)
                held[row["block"]] = a, low, high, searched(a, _Block(row, "b_"), low, high, same, k, found)
        for a, low, _, found in held.values():
            yield told(a, low.shape[1], found)

    by = Window.partitionBy("anchor_row", "window").orderBy(F.desc("score"), "id", "row")
    return met.mapInArrow(run, BEST).withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows for which ``anchor`` holds.

    Negatives score from ``least`` to ``most`` per cent of the positive's score.
    """
    vectors = usable(rows, id_col, vector_col, label_col, F.coalesce(anchor, F.lit(False)).alias("anchor"))
    anchors = vectors.filter("anchor")
    rows_in_all, asking = vectors.count(), anchors.count()
    # positives: stripes of rows sorted by label and norm, met by the blocks that have a label in common
    blocks, stripes = packed(anchors, BLOCK, asking, F.col("label"), F.desc("norm")), packed(vectors, STRIPE, rows_in_all, F.col("label"), F.desc("norm"))
    labels = lambda df, name: df.select(F.col("stripe").alias(name), F.explode("labels").alias("label"))
    pairs = labels(blocks, "block").join(labels(stripes, "stripe"), "label").select("block", "stripe").distinct()
    found = written(_best(_met(blocks, stripes, pairs, rows_in_all), True, positives, least, most), "positives")
    forget(blocks, stripes)

    # negatives: stripes by norm alone; a block takes those whose longest row can reach its lowest window
    windows = found.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("of"))
    lowest = F.array_min(F.transform(F.filter("of", lambda x: x["score"] >= 0), lambda x: x["score"])) * (least / 100)
    wanted = anchors.join(windows, anchors["row"] == windows["anchor_row"]).withColumn("scores", F.transform("of", lambda x: x["score"]))
    wanted = wanted.withColumn("need", F.when(F.col("norm") > 0, lowest / F.sqrt("norm")).otherwise(0.0)).filter("need is not null")
    blocks, stripes = packed(wanted, BLOCK, asking, F.col("need")), packed(vectors, STRIPE, rows_in_all, F.desc("norm"))
    norms = stripes.select("stripe", "norm", F.pmod(F.xxhash64("stripe"), F.lit(SHARDS)).alias("shard"))
    asks = blocks.select(F.col("stripe").alias("block"), "need", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SHARDS - 1).cast("long"))).alias("shard"))
    pairs = asks.join(norms, "shard").filter(F.col("norm") * (1 + 1e-9) + 1e-6 >= F.col("need")).select("block", "stripe")
    mined = written(_best(_met(blocks, stripes, pairs, rows_in_all), False, negatives, least, most), "negatives")
    forget(blocks, stripes)

    named = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    ids = anchors.select(F.col("row").alias("anchor_row"), named("id").alias("anchor_id"))
    of = found.select("anchor_row", (F.col("rank") - 1).alias("window"), named("id").alias("positive_id"), F.col("score").alias("positive_score"))
    told = mined.select("anchor_row", "window", F.col("rank").cast("int").alias("rank"), named("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return told.join(of, ["anchor_row", "window"]).join(ids, "anchor_row").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
