"""Linking of texts whose shingle sets are similar: banding, b-bit estimates, exact confirmation, components.

1. One pass makes, for each text, the size and a 128-bit name of its shingle
   set, the low bits of its minima packed into 64-bit words, and band keys.
2. Equal sets become one: only the smallest id of each goes on.
3. Each task sorts its band keys and sends one row for each key, so a bucket of
   any size costs one row a task; keys that occur once in all are dropped.  In
   each bucket left, every member is paired with the smallest id (a star, never
   all pairs).  Pairs whose similarity, estimated from the packed bits and
   corrected for chance collisions, falls well short are dropped; the others
   are confirmed on the full shingle sets, and components are formed.
4. Buckets that still hold several components may hide links between members
   that are no bucket's smallest.  There members outside the bucket's most
   common component are compared with those of other components, by a join on
   the bucket or, where a component has many outsiders, in square blocks of
   members within tasks.  Likely pairs are confirmed on full sets, and
   components are formed again.

So two texts that share a bucket are either confirmed, ruled out, or known to
be connected already.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sketch
from .common import blocked, ship, sized, text_chunks, written

#: Members confirmed against one hub in one group, and the side of a block.
CHUNK, BLOCK = 64, 128
#: Rows confirmed by one call.
LOT = 500
#: A component whose outsiders and members make more pairs than this is compared in blocks.
MANY_PAIRS = 1 << 16
#: Band keys for each block of keys.
KEYS_PER_BLOCK = 500_000

MEMBER = np.dtype([("key", "<u8"), ("id", "<i8"), ("n", "<u4")])


@dataclass(frozen=True)
class Plan:
    """How texts are sketched.

    ``margin``: how far an estimate may fall short (over four deviations).
    """

    width: int = 5
    percent: int = 75
    perms: int = 208
    bands: int = 40
    rows: int = 5
    bits: int = 4
    margin: float = 0.18

    @property
    def words(self) -> list[str]:
        return [f"w{i}" for i in range(self.perms * self.bits // 64)]


def sketches(rows: DataFrame, plan: Plan) -> DataFrame:
    """(id, n_shingles, lo, hi, w0.., bands) of each row of (id, text); a set's columns are null if it is empty."""
    perms, layout = sketch.permutations(plan.perms), sketch.band_layout(plan.perms, plan.bands, plan.rows)
    words = plan.words

    def run(batches):
        for batch, texts in text_chunks(batches, "text"):
            sets = sketch.shingle_sets(texts, plan.width)
            n = np.array([len(s) for s in sets], np.int64)
            full = n > 0
            some = [s for s in sets if len(s)]
            at = np.cumsum(full) - 1

            def spread(values, full=full, at=at):
                values = np.ascontiguousarray(values[at]) if len(values) else np.zeros(len(full), np.int64)
                return pa.array(values, mask=~full)

            if some:
                flat = np.concatenate(some)
                starts = np.r_[0, np.cumsum(n[full])[:-1]]
                mins = sketch.minima(some, perms)
                # sums of two mixes of the members, whatever their order: a 128-bit name of the set
                names = [np.add.reduceat(sketch.mixed(flat ^ np.uint64(k)), starts).view(np.int64) for k in (0, 0xD6E8FEB86659FD93)]
            else:
                mins, names = np.zeros((0, plan.perms), np.uint32), [np.zeros(0, np.int64)] * 2
            packed = sketch.low_bits(mins, plan.bits)
            keys = (sketch.band_keys(mins, layout).view(np.uint64) >> np.uint64(32)).astype("<u4")
            bands = [keys[i].tobytes() if f else None for i, f in zip(at, full, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), *map(spread, names), *(spread(packed[:, i]) for i in range(len(words))), pa.array(bands, pa.binary())],
                names=["id", "n_shingles", "lo", "hi", *words, "bands"],
            )

    columns = ", ".join(f"{w} long" for w in words)
    return rows.select("id", "text").mapInArrow(run, f"id long, n_shingles long, lo long, hi long, {columns}, bands binary")


def live_members(sets: DataFrame, plan: Plan, blocks: int) -> DataFrame:
    """(key, id) of the buckets with more than one member, from (id, bands)."""

    def in_task(batches):
        held, n = [], 0

        def send():
            rows = np.concatenate(held)
            rows = rows[np.lexsort((rows["id"], rows["key"]))]
            first = np.r_[True, rows["key"][1:] != rows["key"][:-1]]
            one = rows[first].copy()
            one["n"] = np.diff(np.r_[np.flatnonzero(first), len(rows)])
            yield from blocked((sketch.mixed(one["key"]) % np.uint64(blocks)).astype(np.int32), one)
            # further members of a bucket need no merging; they are dealt out evenly
            rest = rows[~first]
            yield from blocked(blocks + (sketch.mixed(rest["id"].view(np.uint64)) % np.uint64(blocks)).astype(np.int32), rest)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(len(ids), plan.bands)
            out = np.empty(keys.size, MEMBER)
            out["key"] = (keys.astype(np.uint64) | (np.arange(plan.bands, dtype=np.uint64) << np.uint64(32))).ravel()
            out["id"], out["n"] = np.repeat(ids, plan.bands), 1
            held.append(out)
            n += len(out)
            if n >= 4_000_000:
                yield from send()
                held, n = [], 0
        if held:
            yield from send()

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = np.frombuffer(b"".join(pdf["data"]), MEMBER)
        if pdf["block"].iloc[0] < blocks:
            rows = rows[np.argsort(rows["key"], kind="stable")]
            first = np.r_[True, rows["key"][1:] != rows["key"][:-1]]
            starts = np.flatnonzero(first)
            total = np.add.reduceat(rows["n"].astype(np.int64), starts)
            rows = rows[np.repeat(total > 1, np.diff(np.r_[starts, len(rows)]))]
        return pd.DataFrame({"key": rows["key"].astype(np.int64), "id": rows["id"].astype(np.int64)})

    return sets.select("id", "bands").mapInArrow(in_task, "block int, data binary").groupBy("block").applyInPandas(merge, "key long, id long")


def picked(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The distinct rows of ``texts`` (id, text) whose id is among the written, distinct ``ids``."""
    return texts.join(sized(ids), "id", "left_semi").distinct()


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(pairs: DataFrame, texts: DataFrame, plan: Plan) -> DataFrame:
    """Those of ``pairs`` (u, hub) whose full shingle sets are similar enough, as (u, v).

    A hub's pairs are dealt out in chunks, each with a copy of the hub's text;
    chunks travel in lots of about ``LOT`` rows, as most have few.
    """
    hubs = written(pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks")), "hubs")
    dealt = pairs.join(hubs, "hub").select(F.col("u").alias("id"), "hub", F.pmod(F.xxhash64("u"), "chunks").cast("int").alias("chunk"))
    heads = hubs.select(F.col("hub").alias("id"), "hub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    need = written(dealt.unionByName(heads), "to-confirm")
    lots = max(1, need.count() // LOT)
    rows = picked(texts, written(need.select("id").distinct(), "confirm-ids")).join(need, "id")
    rows = rows.select(F.pmod(F.xxhash64("hub", "chunk"), F.lit(lots)).alias("lot"), "hub", "chunk", "id", "text")

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        hub, chunk, ids = (pdf[c].to_numpy() for c in ("hub", "chunk", "id"))
        sets = sketch.shingle_sets([x or "" for x in pdf["text"]], plan.width)
        order = np.lexsort((ids != hub, chunk, hub))  # each chunk's head first
        cuts = np.flatnonzero(np.diff(hub[order]) | np.diff(chunk[order])) + 1
        us, vs = [], []
        for group in np.split(order, cuts):
            heads = [sets[i] for i in group if ids[i] == hub[i]]
            good = [ids[i] for i in group if ids[i] != hub[i] and any(similar(sets[i], h, plan.percent) for h in heads)]
            us += good
            vs += [hub[group[0]]] * len(good)
        return pd.DataFrame({"u": np.array(us, np.int64), "v": np.array(vs, np.int64)})

    return rows.groupBy("lot").applyInPandas(judge, "u long, v long").distinct()


def likely(plan: Plan, a: str, b: str) -> Column:
    xs, ys = ([F.col(f"{t}.{w}") for w in plan.words] for t in (a, b))
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    fits = 100 * F.least(n, m) >= plan.percent * F.greatest(n, m)
    return fits & (sketch.estimated_similarity(xs, ys, plan.bits, plan.perms) >= plan.percent / 100 - plan.margin)


def likely_pairs(x: pd.DataFrame, y: pd.DataFrame, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Places of likely pairs between the rows of ``x`` and ``y``, of different labels, each pair once."""
    field = np.uint64(sum(1 << (plan.bits * i) for i in range(64 // plan.bits)))
    differ = np.zeros((len(x), len(y)), np.int32)
    for w in plan.words:
        d = x[w].to_numpy(np.int64).view(np.uint64)[:, None] ^ y[w].to_numpy(np.int64).view(np.uint64)[None, :]
        any_bit = d.copy()
        for k in range(1, plan.bits):
            any_bit |= d >> np.uint64(k)
        differ += np.bitwise_count(any_bit & field)
    chance = 2.0**-plan.bits
    estimate = ((plan.perms - differ) / plan.perms - chance) / (1 - chance)
    n, m = x["n_shingles"].to_numpy()[:, None], y["n_shingles"].to_numpy()[None, :]
    good = (estimate >= plan.percent / 100 - plan.margin) & (100 * np.minimum(n, m) >= plan.percent * np.maximum(n, m))
    good &= x["label"].to_numpy()[:, None] != y["label"].to_numpy()[None, :]
    return np.nonzero(good)


def compared_in_blocks(mixed: DataFrame, sets: DataFrame, texts: DataFrame, plan: Plan) -> DataFrame:
    """Links (u, v) between outsiders and members of the components ``main`` of (main, id, label).

    Outsiders and members are dealt into blocks; a task compares one block of
    each.  First only the packed bits travel, and rows that have no likely
    partner end there; then the others' texts.
    """
    outs, members = mixed.filter("label <> main"), mixed
    counts = mixed.groupBy("main").agg(
        F.ceil(F.count_if(F.col("label") != F.col("main")) / BLOCK).cast("int").alias("nx"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("ny"),
    )
    counts = written(counts, "block-counts")
    own = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = outs.join(counts, "main").select("main", own("nx").alias("bx"), every("ny").alias("by"), F.lit(0).alias("side"), "id", "label")
    y = members.join(counts, "main").select("main", every("nx").alias("bx"), own("ny").alias("by"), F.lit(1).alias("side"), "id", "label")
    keys = ["main", "bx", "by"]
    signed = x.unionByName(y).join(sets.select("id", "n_shingles", *plan.words), "id")

    def hopeful(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf[pdf["side"] == 0].reset_index(drop=True), pdf[pdf["side"] == 1].reset_index(drop=True)
        i, j = likely_pairs(x, y, plan)
        return pd.concat([x.iloc[np.unique(i)], y.iloc[np.unique(j)]])

    hoping = written(signed.groupBy(*keys).applyInPandas(hopeful, signed.select(*signed.columns).schema), "hopeful")
    with_text = picked(texts, written(hoping.select("id").distinct(), "hopeful-ids")).join(hoping, "id")

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf[pdf["side"] == 0].reset_index(drop=True), pdf[pdf["side"] == 1].reset_index(drop=True)
        sx, sy = (sketch.shingle_sets([t or "" for t in p["text"]], plan.width) for p in (x, y))
        good = [(x["id"][i], y["id"][j]) for i, j in zip(*likely_pairs(x, y, plan), strict=True) if similar(sx[i], sy[j], plan.percent)]
        return pd.DataFrame(good, columns=["u", "v"]).astype(np.int64)

    return with_text.groupBy(*keys).applyInPandas(judge, "u long, v long").distinct()


def clusters(rows: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """(sketches, roots) of the rows of (id long, text).

    ``roots`` has (id, lo, hi, root) for each id and set that is not empty; root
    is the smallest id of its component.  Rows that repeat an id share one.
    """
    ship(rows.sparkSession)
    made = sketches(rows, plan)
    made = written(made, "sketches")
    known = made.filter("n_shingles > 0 and id is not null")
    first = known.groupBy("lo", "hi").agg(F.min("id").alias("first"))
    # distinct before the join, so that nothing above it keeps a large group of equal sets together
    of_set = written(known.select("id", "lo", "hi").distinct().join(first, ["lo", "hi"]).select("id", "lo", "hi", "first"), "firsts")
    heads = of_set.filter("id = first").select("id", "lo", "hi")
    sets = written(known.join(heads, ["id", "lo", "hi"], "left_semi").drop("lo", "hi"), "sets")
    texts = rows.select("id", "text")
    # one id on several sets is one document
    alias = of_set.groupBy("id").agg(F.min("first").alias("a"), F.max("first").alias("b")).filter("a < b").select("id")
    same = of_set.join(alias, "id", "left_semi").select(F.col("id").alias("u"), F.col("first").alias("v"))

    blocks = 1 << max(3, min(22, (sets.count() * plan.bands // KEYS_PER_BLOCK).bit_length()))
    members = written(live_members(sets, plan, blocks), "members")
    # written, so that the joins with members can split a hot key
    hubs = written(members.groupBy("key").agg(F.min("id").alias("hub")), "bucket-hubs")
    stars = members.join(hubs, "key").filter("id <> hub").select("id", "hub").distinct()
    signed = sets.select("id", "n_shingles", *plan.words)
    pairs = (
        stars.join(signed.alias("x"), "id")
        .join(signed.withColumnRenamed("id", "hub").alias("y"), "hub")
        .filter(likely(plan, "x", "y"))
        .select(F.col("id").alias("u"), "hub")
    )
    links = written(confirmed(written(pairs, "pairs"), texts, plan).unionByName(same), "links")
    roots = sketch.components(links)

    labelled = members.join(roots.withColumnRenamed("u", "id"), "id", "left").select("key", "id", F.coalesce("v", "id").alias("label"))
    split = (
        labelled.groupBy("key", "label")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("labels"), F.max(F.struct("n", F.col("label"))).alias("most"))
        .filter("labels > 1")
        .select("key", F.col("most.label").alias("main"))
    )
    mixed = written(labelled.join(written(split, "split-buckets"), "key").select("key", "id", "label", "main"), "mixed-buckets")
    around = written(mixed.select("main", "id", "label").distinct(), "around")
    outside = F.count_if(F.col("label") != F.col("main"))
    many = around.groupBy("main").agg(outside.alias("x"), F.count(F.lit(1)).alias("y")).filter(F.col("x") * F.col("y") > MANY_PAIRS)
    many = written(many.select("main"), "many-outsiders")
    few = written(mixed.join(many, "main", "left_anti").join(signed, "id"), "few-outsiders")
    # of two outsiders the smaller id asks; what the main component holds is asked by outsiders only
    apart = (F.col("x.label") != F.col("y.label")) & ((F.col("x.id") < F.col("y.id")) | (F.col("y.label") == F.col("y.main")))
    more = (
        few.filter("label <> main").alias("x")
        .join(few.alias("y"), (F.col("x.key") == F.col("y.key")) & apart & likely(plan, "x", "y"))
        .select(F.col("x.id").alias("u"), F.col("y.id").alias("hub"))
        .distinct()
    )
    more = written(more, "more-pairs")
    extra = []
    if not more.isEmpty():
        extra.append(written(confirmed(more, texts, plan), "more-links"))
    if not many.isEmpty():
        extra.append(written(compared_in_blocks(around.join(many, "main", "left_semi"), sets, texts, plan), "block-links"))
    if extra:
        for found in extra:
            roots = roots.unionByName(found)
        roots = sketch.components(roots)

    root = roots.select(F.col("u").alias("first"), F.col("v").alias("root"))
    found = of_set.join(root, "first", "left").select("id", "lo", "hi", F.coalesce("root", "first").alias("root"))
    return made, written(found, "roots")
