"""Hard negatives against plain sorting of all scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltaweave.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score int, norm string, anchor string"


def brute(rows, positives=5, negatives_=10, least=30, most=90):
    good = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    name = lambda i: (i is None, i or 0)
    for at, (i, v, label) in enumerate(good):
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=False)), j, m) for k, (j, w, m) in enumerate(good) if k != at]
        scored.sort(key=lambda s: (-s[0], name(s[1])))
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and least * ps <= 100 * s[0] <= most * ps][:negatives_]
            out += [(i, p, r, n, ps, ns) for r, (ns, n, _) in enumerate(fit, 1)]
    return sorted(out, key=str)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, "a", 1, "b", "c") for r in rows], SCHEMA).repartition(3)
    got = negatives.mine(df, F.col("vec_id") % 100 == 0, **more)
    return sorted((tuple(r) for r in got.collect()), key=str)


def vectors(n, dims, seed, labels=4, spread=1.0):
    rng = np.random.default_rng(seed)
    v = rng.normal(0.3, 1, (n, dims)) * rng.lognormal(0, spread, (n, 1))
    return [(i * 10, [float(x) for x in v[i]], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_against_all_scores(spark, spread):
    rows = vectors(400, 6, 3, spread=spread)
    want = brute(rows)
    assert want and mined(spark, rows) == want
    assert mined(spark, rows, positives=2, negatives=3, least=50, most=100) == brute(rows, 2, 3, 50, 100)


def test_awkward_rows(spark):
    rng = random.Random(2)
    nan, inf = float("nan"), float("inf")
    odd = [[], [1.0], [0.0] * 3, [nan, 1.0], [inf], [-inf], [1.0, None], None, [1.0, 1.0, 1.0, 1.0], [-0.001], [0.5, 0.5], [3e4, 2e4]]
    rows = [(rng.choice([None, *range(0, 1000, 50)]), rng.choice(odd), rng.choice([None, 0, 0, 1, 2])) for _ in range(300)]
    want = brute(rows)
    assert want and mined(spark, rows) == want  # repeated ids and ties, vectors of all lengths


def test_scores_beyond_doubles(spark):
    rng = random.Random(6)
    rows = [(i * 20, [rng.choice([3e6, 2.9e6, -1.0, 7.0]) + rng.random() for _ in range(3)], i % 3) for i in range(120)]
    want = brute(rows)
    assert want and max(abs(r[4]) for r in want) > 2**53 and mined(spark, rows) == want


@pytest.mark.parametrize("rows", [[], [(100, [1.0], 1)], [(100, [1.0], 1), (101, [1.0], 1)], [(100, None, None)], [(7, [1.0], 1), (8, [1.0], 2)]])
def test_nothing_to_mine(spark, rows):
    assert mined(spark, rows) == []


def test_several_stripes_and_one_hot_label(spark):
    rng = np.random.default_rng(9)
    n = 20_000
    v = np.floor(256 * (rng.normal(0.2, 1, (n, 4)) * rng.lognormal(0, 1, (n, 1))).astype(np.float32).astype(float))
    label = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 50, n))
    rows = [(int(i), [float(x) / 256 for x in v[i]], int(label[i])) for i in range(n)]
    got = mined(spark, rows)
    want = []
    for a in range(0, n, 100):
        s = (v @ v[a]).astype(np.int64)
        order = np.lexsort((np.arange(n), -s))
        order = order[order != a]
        for p in order[label[order] == label[a]][:5]:
            fit = order[(label[order] != label[a]) & (30 * s[p] <= 100 * s[order]) & (100 * s[order] <= 90 * s[p])][:10]
            want += [(a, int(p), r, int(j), int(s[p]), int(s[j])) for r, j in enumerate(fit, 1)]
    assert got == sorted(want, key=str)
