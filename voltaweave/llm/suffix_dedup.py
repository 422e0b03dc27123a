"""Removal of every byte that lies in a string of ``length`` bytes that also starts earlier.

Suffixes are only ever compared to a depth of ``length`` bytes, so whole suffix
arrays are not needed: suffixes are sampled, the sampled ones are classed by
content, and the others are induced from the class of their sample.

1. Sampling.  The string of 100 bytes at p holds 51 substrings of 50 bytes; the
   one with the least hash (the leftmost of equals) is its anchor.  It depends
   on the string's bytes alone, so equal strings have equal anchors at equal
   distances.  The strings that share one anchor occurrence form a run.
2. Classes.  A run's class is a hash of all bytes that its strings cover.  Of
   runs of one class all but the first are repeats, string by string.
3. Induction.  Where an anchor's bytes occur in runs of several classes (at the
   edges of a shared passage, beside an edit), the strings of each class's
   first run are compared by their own hashes; the earliest of each stays.

All other strings have an anchor that occurs once, so they occur once.  What
tells classes and strings apart are hashes of 128 bits; an anchor's has 64, and
two anchors that share it are told apart by their classes.  Tuples travel as packed blocks, sorted and merged by NumPy inside
tasks; every task first settles what it can by itself and sends one tuple for
each class or anchor, so a passage that fills a third of the corpus sends one
tuple for each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocked, keyed, ship, written
from .sketch import mixed

#: Bytes that are hashed at a time; longer documents are cut, with an overlap that loses no string.
PIECE = 500_000
#: Tuples that a task settles at a time.
FLUSH = 400_000
#: Text bytes for each block of tuples.
BYTES_PER_BLOCK = 4_000_000

#: An anchor's hash and its run's class (128 bits); a string's hash (128 bits).
RUN = np.dtype([("h", "<u8"), ("c", "<u8"), ("c2", "<u8"), ("d", "<i8"), ("p", "<u4"), ("n", "<u2")])
STRING = np.dtype([("h", "<u8"), ("h2", "<u8"), ("d", "<i8"), ("p", "<u4")])
MARK = np.dtype([("d", "<i8"), ("p", "<u4"), ("n", "<u4")])  # n strings from p on; n = 0: to be induced

_POSITION = np.uint64((1 << 21) - 1)


class Hasher:
    """Hashes of any substring of a piece, by prefix sums of a polynomial modulo 2**64."""

    def __init__(self, longest: int, base: int = 0x9E3779B97F4A7C15, seed: int = 5):
        self.codes = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = np.full(longest + 1, base, np.uint64)
        self.inverse = np.full(longest + 1, pow(base, -1, 1 << 64), np.uint64)
        self.powers[0] = self.inverse[0] = 1
        np.multiply.accumulate(self.powers, out=self.powers)
        np.multiply.accumulate(self.inverse, out=self.inverse)

    def read(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.powers[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])

    def every(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def hashers(longest: int) -> tuple[Hasher, Hasher]:
    """Two hashers whose values together tell strings apart."""
    return Hasher(longest), Hasher(longest, 0xD6E8FEB86659FD93, 6)


def pieces(keys: list[int], datas: list[bytes], length: int, most: int = PIECE) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (key, offset, bytes) of at most ``most`` bytes; long documents overlap by length - 1."""
    out, size = [], 0
    for key, data in zip(keys, datas, strict=True):
        for at in range(0, max(1, len(data) - length + 1), most - length + 1):
            part = data[at : at + most]
            if len(part) < length:
                continue
            if size + len(part) > most and out:
                yield out
                out, size = [], 0
            out.append((key, at, part))
            size += len(part)
    if out:
        yield out


def runs_of(pair: tuple[Hasher, Hasher], part: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of a piece, and where each starts in it."""
    hasher, other = pair
    width = length // 2
    data = np.frombuffer(b"".join(x for _, _, x in part), np.uint8)
    sizes = np.array([len(x) for _, _, x in part])
    ends = np.cumsum(sizes)
    hasher.read(data)
    other.read(data)
    h = hasher.every(width)
    least = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
    window, have = length - width + 1, 1
    while 2 * have <= window:
        least = np.minimum(least[: len(least) - have], least[have:])
        have *= 2
    if have < window:
        least = np.minimum(least[: len(least) - (window - have)], least[window - have :])
    anchor = (least & _POSITION).astype(np.int64)
    owner = np.repeat(np.arange(len(part)), sizes)
    inside = np.arange(len(anchor)) <= (ends[owner[: len(anchor)]] - length)
    p = np.flatnonzero(inside)
    a, o = anchor[p], owner[p]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (o[1:] != o[:-1])])
    last = np.r_[first[1:], len(p)] - 1
    start, stop, a, o = p[first], p[last], a[first], o[first]
    out = np.empty(len(first), RUN)
    out["h"] = h[a]
    lies = mixed((((stop - start) << 32) + (a - start)).astype(np.uint64))
    out["c"], out["c2"] = (mixed(x.of(start, stop + length) ^ lies) for x in pair)
    out["d"] = np.array([k for k, _, _ in part], np.int64)[o]
    out["p"] = start - (ends - sizes)[o] + np.array([at for _, at, _ in part])[o]
    out["n"] = stop - start + 1
    return out, start


def marks(rows: np.ndarray, induce: bool = False) -> np.ndarray:
    out = np.empty(len(rows), MARK)
    out["d"], out["p"] = rows["d"], rows["p"]
    out["n"] = 0 if induce else (rows["n"] if "n" in rows.dtype.names else 1)
    return out


def settle_runs(rows: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """(runs to send on, marks) of some runs.

    A run with n = 0 only says that its anchor occurs elsewhere in several
    classes.  ``last``: these are all runs of their anchors, nothing is sent on.
    """
    rows = rows[np.lexsort((rows["p"], rows["d"], rows["n"] > 0, rows["c2"], rows["c"], rows["h"]))]
    h, c, c2, note = rows["h"], rows["c"], rows["c2"], rows["n"] == 0
    new_h = np.r_[True, h[1:] != h[:-1]] if len(rows) else np.zeros(0, bool)
    new_c = new_h | np.r_[True, (c[1:] != c[:-1]) | (c2[1:] != c2[:-1]) | (note[:-1] & ~note[1:])] if len(rows) else new_h
    of = np.cumsum(new_h) - 1
    several = np.bincount(of, new_c & ~note, minlength=1) > 1
    several |= np.bincount(of, note, minlength=1) > 0
    split = several[of] if len(rows) else note
    first = new_c & ~note
    made = [marks(rows[~first & ~note]), marks(rows[first & split], induce=True)]
    if last:
        return rows[:0], np.concatenate(made)
    notes = rows[new_h & split].copy()
    notes["n"] = 0
    notes["c"] = notes["c2"] = notes["d"] = notes["p"] = 0
    return np.concatenate([rows[first & ~split], notes]), np.concatenate(made)


def settle_strings(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the first of each string, marks of the others)."""
    h, h2 = (rows[x] for x in ("h", "h2"))
    order = np.lexsort((rows["p"], rows["d"], h2, h))
    rows, h, h2 = rows[order], h[order], h2[order]
    first = np.r_[True, (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])] if len(rows) else np.zeros(0, bool)
    return rows[first], marks(rows[~first])


def joined(column: pd.Series, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind)


def document_block(d: np.ndarray, blocks: int) -> np.ndarray:
    return (mixed(d.astype(np.int64).view(np.uint64)) % np.uint64(blocks)).astype(np.int32)


def as_frame(rows: np.ndarray, blocks: int) -> pd.DataFrame:
    made = [b.to_pandas() for b in blocked(document_block(rows["d"], blocks), rows)]
    return pd.concat(made) if made else pd.DataFrame({"block": np.zeros(0, np.int32), "data": np.zeros(0, object)})


def repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """For each row: doc_id, text, and starts and ends (arrays of int) of its removed byte runs.

    Earlier means a smaller id, or an earlier byte of the same document.  Null
    texts count as empty; texts shorter than ``length`` bytes lose nothing.
    Rows that repeat both id and text are one document and get one answer; of
    several texts under one id, or a null id (which comes first), the order is
    that of their digests.  An empty table gives an empty result.
    """
    if not 2 <= length <= 100_000 or not length < piece < 1 << 21:
        raise ValueError("a string has 2 to 100,000 bytes, a piece more, and less than 2**21")
    ship(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 << max(3, min(20, (size // BYTES_PER_BLOCK).bit_length()))
    bits = np.uint64(64 - blocks.bit_length() + 1)

    def read(batches, more=()):
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                keys, texts, *rest = (batch.column(i).to_pylist() for i in range(2 + len(more)))
                yield keys, [x.encode("utf-8", "replace") for x in texts], *rest

    def first_pass(batches):
        pair, held, n = hashers(piece), [], 0

        def send():
            on, made = settle_runs(np.concatenate(held), last=False)
            yield from blocked((mixed(on["h"]) >> bits).astype(np.int32), on)
            yield from blocked(document_block(made["d"], blocks) + blocks, made)

        for keys, datas in read(batches):
            for part in pieces(keys, datas, length, piece):
                held.append(runs_of(pair, part, length)[0])
                n += len(held[-1])
                if n >= FLUSH:
                    yield from send()
                    held, n = [], 0
        if held:
            yield from send()

    def merge_runs(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["block"].iloc[0])
        if block >= blocks:
            return pd.DataFrame({"block": pdf["block"] - blocks, "data": pdf["data"]})
        return as_frame(settle_runs(joined(pdf["data"], RUN), last=True)[1], blocks)

    texts = rows.select("key", "text")
    packed = "block int, data binary"
    found = written(texts.mapInArrow(first_pass, packed).groupBy("block").applyInPandas(merge_runs, packed), "run-marks")

    def open_runs(pdf: pd.DataFrame) -> pd.DataFrame:
        got = joined(pdf["data"], MARK)
        got = np.unique(got[got["n"] == 0])
        keys, at = np.unique(got["d"], return_index=True)
        return pd.DataFrame({"open_key": keys, "starts": [x.tobytes() for x in np.split(got["p"], at[1:])] if len(keys) else []})

    def second_pass(batches):
        pair, held, n = hashers(piece), [], 0

        def send():
            on, made = settle_strings(np.concatenate(held))
            yield from blocked((mixed(on["h"]) >> bits).astype(np.int32), on)
            yield from blocked(document_block(made["d"], blocks) + blocks, made)

        for keys, datas, starts in read(batches, more=("starts",)):
            wanted = {k: np.frombuffer(s, "<u4") for k, s in zip(keys, starts, strict=True)}
            for part in pieces(keys, datas, length, piece):
                runs, at = runs_of(pair, part, length)
                ends = np.flatnonzero(np.r_[runs["d"][1:] != runs["d"][:-1], True]) + 1 if len(runs) else []
                pick = np.zeros(len(runs), bool)
                begin = 0
                for end in ends:
                    pick[begin:end] = np.isin(runs["p"][begin:end], wanted[int(runs["d"][begin])])
                    begin = end
                runs, at = runs[pick], at[pick]
                if not len(runs):
                    continue
                many = runs["n"].astype(np.int64)
                step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                where = np.repeat(at, many) + step
                out = np.empty(len(where), STRING)
                out["h"], out["h2"] = (x.of(where, where + length) for x in pair)
                out["d"] = np.repeat(runs["d"], many)
                out["p"] = np.repeat(runs["p"], many) + step
                held.append(out)
                n += len(out)
                if n >= FLUSH:
                    yield from send()
                    held, n = [], 0
        if held:
            yield from send()

    def merge_strings(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["block"].iloc[0])
        if block >= blocks:
            return pd.DataFrame({"block": pdf["block"] - blocks, "data": pdf["data"]})
        return as_frame(settle_strings(joined(pdf["data"], STRING))[1], blocks)

    opened = found.groupBy("block").applyInPandas(open_runs, "open_key long, starts binary")
    induced = (
        texts.join(opened, F.col("key") == F.col("open_key"))
        .select("key", "text", "starts")
        .mapInArrow(second_pass, packed)
        .groupBy("block")
        .applyInPandas(merge_strings, packed)
    )

    def spans(pdf: pd.DataFrame) -> pd.DataFrame:
        got = joined(pdf["data"], MARK)
        got = got[got["n"] > 0]
        got = got[np.lexsort((got["p"], got["d"]))]
        keys, at = np.unique(got["d"], return_index=True)
        starts, ends = [], []
        for rows in np.split(got, at[1:]) if len(keys) else []:
            a = rows["p"].astype(np.int64)
            b = np.maximum.accumulate(a + rows["n"] - 1 + length)
            new = np.r_[True, a[1:] > b[:-1]]
            starts.append(a[new])
            ends.append(b[np.r_[new[1:], True]])
        return pd.DataFrame({"span_key": keys, "starts": starts, "ends": ends})

    # not written in between: one plan shuffles the texts by key once for both joins
    removed = found.unionByName(induced).groupBy("block").applyInPandas(spans, "span_key long, starts array<int>, ends array<int>")
    none, kind = F.array().cast("array<int>"), docs.schema[id_col].dataType
    doc_id = F.col("doc_id") if "doc_id" in rows.columns else F.col("key").cast(kind).alias("doc_id")
    return rows.join(removed, F.col("key") == F.col("span_key"), "left").select(
        doc_id, "text", F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends")
    )


def kept_bytes(data: bytes, starts: list[int], ends: list[int]) -> bytes:
    out, at = [], 0
    for a, b in zip(starts, ends, strict=True):
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for each row of :func:`repeats`."""

    def run(batches):
        for batch in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):
            ids, texts, starts, ends = (batch.column(i) for i in range(4))
            made = []
            for text, a, b in zip(texts.to_pylist(), starts.to_pylist(), ends.to_pylist(), strict=True):
                data = text.encode("utf-8", "replace")
                kept = kept_bytes(data, a, b)
                made.append((len(data), len(data) - len(kept), len(a), hashlib.sha256(kept).hexdigest()))
            n, removed, spans, digest = zip(*made, strict=True) if made else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(x, pa.int64()) for x in (n, removed, spans)), pa.array(digest, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
