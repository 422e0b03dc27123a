"""Weights of a score of capped signals, fitted to scores that are known."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import scratch
from .radar import capped_score


def _sums(terms: list[Column], rest: Column) -> list[Column]:
    """The sums that least squares needs: every product of two terms, and of each with what is to be explained."""
    squares = [F.sum(a * b) for i, a in enumerate(terms) for b in terms[i:]]
    return [*squares, *(F.sum(a * rest) for a in terms), F.sum(rest * rest)]


#: Factors by which one weight at a time is tried.
FACTORS = [2.0**e for e in (-6, -3, -2, -1, -0.5, 0.5, 1, 2, 3, 6)]


def capped_weights(df: DataFrame, score: str, caps: Mapping[str, float], start: Mapping[str, float] | None = None, rounds: int = 30, settled: float = 1e-10) -> dict[str, float]:
    """The weight of each signal with which ``radar.capped_score`` comes nearest to ``score``, by least squares.

    Given the weights, each signal of a row is capped or not; given that, the weights
    solve a linear system, whose solution is the next step if the error falls.
    As the error has several valleys, each round also tries one weight at a time,
    smaller and larger by up to 64 times, and goes where the error is least; it ends where no
    try is better.  That need not be the least error of all, if one has to change two weights at once to leave a valley.

    A round is two aggregates of some sums, whatever the number of rows; only these
    come to the driver.  Weights that the rows don't determine stay as they are.  Rows without a
    score are left out, missing signals count 0.
    """
    names, k, spark = list(caps), len(caps), df.sparkSession
    home = scratch.folder(spark, "scores")
    df.filter(F.col(score).isNotNull()).select(F.col(score).cast("double").alias(score), *names).write.parquet(home)  # read twice a round
    rows = spark.read.parquet(home)
    x = {n: F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in names}
    if start is None:
        means = rows.agg(*(F.avg(F.abs(x[n])).alias(n) for n in names)).first()
        start = {n: caps[n] / 2 / means[n] if means[n] else 0.0 for n in names}
    total = rows.agg(F.sum(F.col(score) * F.col(score))).first()[0] or 0.0
    now = np.array([float(start[n]) for n in names])
    for _ in range(rounds):
        free = {n: F.lit(float(w)) * x[n] < caps[n] for n, w in zip(names, now, strict=True)}
        terms = [F.when(free[n], x[n]).otherwise(0.0) for n in names]
        taken = sum((F.when(free[n], 0.0).otherwise(float(caps[n])) for n in names), F.lit(0.0))
        own = [float(v or 0.0) for v in rows.agg(*(c.alias(f"s{i}") for i, c in enumerate(_sums(terms, F.col(score) - taken)))).first()]
        matrix = np.zeros((k, k))
        matrix[np.triu_indices(k)] = own[: k * (k + 1) // 2]
        matrix = matrix + np.triu(matrix, 1).T
        right = np.array(own[k * (k + 1) // 2 : -1])
        # columns of one scale, and the step of least size: a signal that is always capped, or always 0, keeps its weight
        scale = np.sqrt(np.where(matrix.diagonal() > 0, matrix.diagonal(), 1.0))
        step = np.linalg.pinv(matrix / np.outer(scale, scale), rcond=1e-10, hermitian=True) @ ((right - matrix @ now) / scale) / scale
        tries = [now, now + step, now + step / 2, now + step / 8]
        tries += [np.where(np.arange(k) == i, now * f, now) for i in range(k) for f in FACTORS]
        # the tries are data, not code: one plan, compiled once, serves all rounds
        tried = F.array(*(F.struct(F.lit(i).alias("i"), F.array(*(F.lit(float(w)) for w in t)).alias("w")) for i, t in enumerate(tries)))
        each = rows.select(score, *(x[n].alias(f"x{j}") for j, n in enumerate(names)), F.explode(tried).alias("t"))
        off = F.col(score) - sum((F.least(F.lit(float(caps[n])), F.col("t.w")[j] * F.col(f"x{j}")) for j, n in enumerate(names)), F.lit(0.0))
        found = {r["i"]: float(r["e"] or 0.0) for r in each.groupBy("t.i").agg(F.sum(off * off).alias("e")).collect()}  # a row for each try
        errors = [found.get(i, 0.0) for i in range(len(tries))]
        single, noise = 4 + int(np.argmin(errors[4:])), 1e-14 * total
        near = int(np.argmin(errors[:4]))
        if errors[single] < 0.999 * errors[near] - noise:
            now = tries[single]
        elif errors[1] <= errors[0] * (1 + 1e-6) + noise:
            now = tries[1]
            if np.abs(step).max(initial=0.0) <= settled * max(np.abs(now).max(initial=0.0), 1e-300) or (np.abs(step) <= settled * np.abs(now)).all():
                break
        elif near:
            now = tries[near]
        else:
            break
    scratch.remove(spark, home)
    return {n: float(w) for n, w in zip(names, now, strict=True)}


def refitted(df: DataFrame, score: str, caps: Mapping[str, float], name: str = "fitted", **options) -> DataFrame:
    """``df`` with the score that its fitted weights give."""
    weights = capped_weights(df, score, caps, **options)
    return df.withColumn(name, capped_score({n: (weights[n], caps[n]) for n in caps}))
