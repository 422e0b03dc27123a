"""Word shingles, minimum hashes and connected components, for the near-duplicate operators."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, written

_FOLD, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all texts' words in one array, and each text's number of words.

    Words are what ASCII white space parts, with A-Z lower-cased.
    """
    split = [x.encode("utf-8", "replace").lower().split() for x in texts]
    sizes = np.array([len(x) for x in split], np.int64)
    return np.fromiter((h for x in split for h in map(xxhash.xxh3_64_intdigest, x)), np.uint64, int(sizes.sum())), sizes


def folded(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each place at which ``width`` words in a row start."""
    n = max(0, len(words) - width + 1)
    out = words[:n].copy()
    for k in range(1, width):
        out = out * _FOLD + words[k : n + k]
    return mixed(out)


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of ``width`` words in a row.

    A text of fewer words, but not none, has the one shingle of all its words.
    """
    words, sizes = word_hashes(texts)
    starts = np.cumsum(sizes) - sizes
    every = folded(words, width)
    out = []
    for a, n in zip(starts, sizes, strict=True):
        if n >= width:
            out.append(np.unique(every[a : a + n - width + 1]))
        elif n:
            one = np.array([n], np.uint64)
            for w in words[a : a + n]:
                one = mixed(one * _FOLD + w)
            out.append(one)
        else:
            out.append(words[:0])
    return out


def permutations(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def minima(sets: list[np.ndarray], perms: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One row for each set, which must not be empty: its minimum under each permutation."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.r_[0, np.cumsum([len(x) for x in sets])[:-1]]
    out = np.empty((len(sets), len(perms[0])), np.uint32)
    for i, (a, b) in enumerate(zip(*perms, strict=True)):
        out[:, i] = np.minimum.reduceat(flat * a + b, starts)
    return out


def tuned_bands(read: int, similarity: float, recall: float) -> tuple[int, int]:
    """(bands, rows): the most minima a band may read, of ``read`` in all, to find pairs of ``similarity`` with ``recall``."""
    for rows in range(read, 0, -1):
        if 1 - (1 - similarity**rows) ** (read // rows) >= recall:
            return read // rows, rows
    return read, 1


def band_layout(n_perms: int, bands: int, rows: int, seed: int = 11) -> np.ndarray:
    """Which minima each band reads: every round deals all of them out once."""
    rng = np.random.default_rng(seed)
    dealt = np.concatenate([rng.permutation(n_perms) for _ in range(-(-bands * rows // n_perms))])
    return dealt[: bands * rows].reshape(bands, rows)


def band_keys(mins: np.ndarray, layout: np.ndarray) -> np.ndarray:
    """One 64-bit key for each row and band; the band's number is part of it."""
    keys = np.empty((len(mins), len(layout)), np.uint64)
    for band, where in enumerate(layout):
        key = np.full(len(mins), band + 1, np.uint64)
        for column in where:
            key = mixed(key * _FOLD + mins[:, column].astype(np.uint64))
        keys[:, band] = key
    return keys.view(np.int64)


def low_bits(mins: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` low bits of each (remixed) minimum, packed into 64-bit words."""
    per = 64 // bits
    low = ((mins * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.uint64)
    packed = np.zeros((len(mins), mins.shape[1] // per), np.uint64)
    for i in range(per):
        packed |= low[:, i::per] << np.uint64(bits * i)
    return packed.view(np.int64)


def estimated_similarity(a: list[Column], b: list[Column], bits: int, n_perms: int) -> Column:
    """Jaccard similarity from packed low bits, corrected for chance collisions.

    A field agrees if the exclusive or leaves none of its bits; fields that
    differ are counted by a population count.  Of unequal minima 2^-bits agree
    by chance, which the last step takes out.
    """
    field = sum(1 << (bits * i) for i in range(64 // bits))
    ones = F.lit(field - (1 << 64) if field >> 63 else field).cast("long")
    differ = F.lit(0)
    for x, y in zip(a, b, strict=True):
        d = x.bitwiseXOR(y)
        any_bit = d
        for k in range(1, bits):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(d, k))
        differ = differ + F.bit_count(any_bit.bitwiseAND(ones))
    chance = 2.0**-bits
    return ((n_perms - differ) / float(n_perms) - chance) / (1 - chance)


def components(edges: DataFrame) -> DataFrame:
    """(u, v) for each vertex u that is not the smallest of its component, v the smallest.

    Large-star and small-star rounds on tables in the shared folder: the edges
    stay distributed, and only a count and a checksum come to the driver.
    """

    def ordered(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = written(ordered(edges), "edges")
    before = state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join below meets plain tables and a hub's many edges can be split over tasks
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")).withColumnRenamed("u", "v"), "least")
        large = now.join(least, "v").select("u", F.col("least").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("least"))
        small = (
            large.join(low, "u")
            .select(F.col("v").alias("u"), F.col("least").alias("v"))
            .unionByName(low.select("u", F.col("least").alias("v")))
        )
        old, now = now, written(small.filter("u <> v").distinct(), "edges")
        forget(old, least)
        after = state(now)
        if after == before:
            break
        before = after
    return now
