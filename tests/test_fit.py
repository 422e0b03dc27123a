"""Fitted weights and numbered rows, against plain arithmetic."""

import random

import numpy as np

from voltaweave.operators import fit, radar


def test_weights_of_capped_signals(spark):
    rng = random.Random(3)
    caps, true = {"a": 20.0, "b": 15.0, "c": 10.0, "d": 5.0}, {"a": 0.4, "b": 0.05, "c": 2.0, "d": 0.01}
    rows = []
    for _ in range(800):
        x = [rng.choice([None, rng.uniform(0, 100)]), rng.expovariate(1 / 200), float(rng.randint(0, 9)), rng.uniform(-50, 400)]
        rows.append((*x, sum(min(caps[k], true[k] * (v or 0.0)) for k, v in zip("abcd", x, strict=True))))
    df = spark.createDataFrame([*rows, (1.0, 1.0, 1.0, 1.0, None)], "a double, b double, c double, d double, score double").repartition(3)
    found = fit.capped_weights(df, "score", caps)
    assert all(abs(found[k] - true[k]) < 1e-6 for k in true)
    again = fit.refitted(df, "score", caps).filter("score is not null").selectExpr("max(abs(score - fitted))").first()[0]
    assert again < 1e-6


def test_fit_without_caps_is_least_squares(spark):
    rng = np.random.default_rng(4)
    x, noise = rng.normal(size=(300, 3)), rng.normal(size=300)
    y = x @ [1.5, -2.0, 0.25] + noise
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, score double")
    found = fit.capped_weights(df, "score", {"a": 1e9, "b": 1e9, "c": 1e9}, start={"a": 0.0, "b": 0.0, "c": 0.0})
    assert np.allclose([found[k] for k in "abc"], np.linalg.lstsq(x, y, rcond=None)[0])


def test_undetermined_weights_stay(spark):
    df = spark.createDataFrame([(float(i), 0.0, 2.0 * i) for i in range(10)], "a double, b double, score double")
    assert fit.capped_weights(df, "score", {"a": 1e9, "b": 1.0}, start={"a": 1.0, "b": 7.0}) == {"a": 2.0, "b": 7.0}
    none = df.limit(0)
    assert fit.capped_weights(none, "score", {"a": 1.0}, start={"a": 3.0}) == {"a": 3.0}
    assert fit.capped_weights(none, "score", {"a": 1.0}) == {"a": 0.0}


def test_numbered_rows(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, 1.0, 2.0, 3.0]), "x") for i in range(500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = radar.numbered(spark.createDataFrame(rows, "id int, v double, _at string").repartition(5), "v", "id").collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [(r.id, r.v, r["_at"]) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 501))
    assert radar.numbered(spark.createDataFrame([], "id int, v double"), "v", "id").collect() == []
