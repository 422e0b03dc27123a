"""Near names, latest records, exact ranks and phrase rules, against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from voltaweave.operators import asof, keyed, quantiles, rules, similar


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def changed(rng, name, letters):
    for _ in range(rng.randint(0, 3)):
        i = rng.randint(0, len(name))
        name = rng.choice([name[:i] + name[i + 1 :], name[:i] + rng.choice(letters) + name[i:], name[:i] + rng.choice(letters) + name[i + 1 :]])
    return name


@pytest.mark.parametrize(("k", "q", "letters"), [(2, 2, "ABCDEFGHIJKLMN "), (1, 2, "AB"), (2, 3, "ABÑ"), (3, 2, "ABCDEFG"), (0, 2, "AB"), (1, 1, "ABC")])
def test_all_names_within_a_distance(spark, k, q, letters):
    rng = random.Random(k * 10 + q)
    right = {"".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9, 14]))) for _ in range(150)} | {"SAN " + str(i) for i in range(60)}
    left = {changed(rng, rng.choice(sorted(right)), letters) for _ in range(150)} | {"", "A", "AAAAAAAAAA"}
    a, b = (spark.createDataFrame([(x,) for x in [*names, None]], "name string").repartition(3) for names in (left, right))
    got = similar.within_distance(a, b.withColumnRenamed("name", "other"), "name", "other", k, q).collect()
    want = {(x, y, distance(x, y)) for x in left for y in right if distance(x, y) <= k}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_two_thousand_names(spark):
    rng = random.Random(11)
    syllables = ["SAN", "TA", "MI", "GUEL", "RO", "LA", "PE", "ÑA", "TOR", "RE", "VAL", "DE"]
    right = sorted({" ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 2))) for _ in range(2000)})
    left = sorted({changed(rng, x, "AEIOUSTRL") for x in rng.sample(right, 400)})
    a, b = spark.createDataFrame([(x,) for x in left], "l string"), spark.createDataFrame([(x,) for x in right], "r string")
    got = {tuple(r) for r in similar.within_distance(a, b, "l", "r").collect()}
    want = set()
    for x in left:
        for y in right:
            if abs(len(x) - len(y)) <= 2 and (d := distance(x, y)) <= 2:
                want.add((x, y, d))
    assert got == want and len(want) > 400


def test_first_letters_may_be_wrong(spark):
    left = spark.createDataFrame([("ZAN MIGUEL 66",), ("SNA MIGUEL 66",), ("La Nátion 220",), ("far away 5",), (None,)], "name string")
    right = spark.createDataFrame([("SAN MIGUEL 66",), ("SAN MIGUEL 220",), ("NATON 220",)], "place string")
    got = {r.name: (r.place, r.distance) for r in keyed.fuzzy_link(left, right, "name", "place").collect()}
    assert got == {"ZAN MIGUEL 66": ("SAN MIGUEL 66", 1), "SNA MIGUEL 66": ("SAN MIGUEL 66", 2), "La Nátion 220": ("NATON 220", 1), "far away 5": (None, None), None: (None, None)}
    ranked = {(r.name, r.rank): r.place for r in keyed.fuzzy_candidates(left, right, "name", "place").collect()}
    assert ranked["ZAN MIGUEL 66", 2] == "SAN MIGUEL 220"


def test_latest_before(spark):
    rng = random.Random(9)
    keys = ["hot"] * 5 + ["b", "c", None]
    records = [(rng.choice(keys), rng.choice([None, *range(0, 5000, 7)]), i, rng.random()) for i in range(400)]
    events = [(rng.choice([*keys, "none"]), rng.choice([None, *range(-100, 6000, 3)]), f"e{i}") for i in range(400)]
    timed = lambda df: df.withColumn("at", F.timestamp_seconds("at"))
    e, r = timed(spark.createDataFrame(events, "k string, at int, name string")), timed(spark.createDataFrame(records, "k string, at int, id int, v double"))
    for within in (None, 20):
        found = asof.latest_before(e.repartition(3), r.repartition(3), ["k"], "at", ["id", "v"], order=["id"], width=100, within=within)
        got = {x.name: (x.k, x.at, x.last_at, x.last_id, x.last_v) for x in found.withColumns({"at": F.unix_timestamp("at"), "last_at": F.unix_timestamp("last_at")}).collect()}
        assert len(got) == len(events)
        for k, at, name in events:
            fit = [(t, i, v) for kk, t, i, v in records if kk == k and t is not None and at is not None and t <= at and (within is None or at - t <= within)]
            assert got[name] == (k, at, *(max(fit) if fit else (None, None, None)))
    none = asof.latest_before(e, r.limit(0), ["k"], "at", ["v"]).collect()
    assert len(none) == len(events) and all(x.last_v is None and x.last_at is None for x in none)


def test_quantiles(spark):
    rng = random.Random(2)
    odd = [math.inf, -math.inf, 0.0, -0.0, 1e-300, -1e-300, 1.7e308, -1.7e308, 5e-324, None]
    rows = [("even", rng.random()) for _ in range(500)] + [("same", 3.5)] * 40 + [("one", -2.0), ("nulls", None), (None, 1.0), (None, 2.0)]
    rows += [("spread", 10.0 ** rng.randint(-200, 200) * rng.choice([-1, 1])) for _ in range(200)] + [("odd", rng.choice(odd)) for _ in range(150)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    got = {r.k: r.quantiles for r in quantiles.quantiles(df, ["k"], "v", shares, bins=16).collect()}
    assert got == {k: [sorted(v)[max(math.ceil(len(v) * s) - 1, 0)] for s in shares] for k, v in groups.items()}
    some = {r.k: r.quantiles for r in quantiles.quantiles(df.filter("k <> 'odd'"), ["k"], "v", shares, interpolated=True).collect()}
    for k, points in some.items():
        v = sorted(groups[k])
        for s, p in zip(shares, points, strict=True):
            at = (len(v) - 1) * s
            lo, hi = v[math.floor(at)], v[math.ceil(at)]
            assert math.isclose(p, lo + (hi - lo) * (at - math.floor(at)), rel_tol=1e-12)
    assert quantiles.quantiles(df.limit(0), ["k"], "v", shares).collect() == []


def test_not_a_number_is_greatest(spark):
    df = spark.createDataFrame([(1, float("nan")), (1, 1.0), (1, math.inf), (2, float("nan"))], "k int, v double")
    got = {r.k: r.quantiles for r in quantiles.quantiles(df, ["k"], "v", [0.1, 0.5, 1.0]).collect()}
    assert got[1][:2] == [1.0, math.inf] and math.isnan(got[1][2]) and all(map(math.isnan, got[2]))


def test_first_rules(spark):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcé ") for _ in range(n))
    phrases = [(i, rng.choice([None, "", word(1), word(2), word(3), word(5), word(8)]), f"name{i}") for i in range(300)]
    texts = [(i, rng.choice([None, "", word(2), word(12), word(40), "a"])) for i in range(200)]
    t, r = spark.createDataFrame(texts, "id int, said string"), spark.createDataFrame(phrases, "rank int, phrase string, name string")
    got = {x.id: (x.rank, x.phrase, x.name) for x in rules.first_rule(t, "said", r, "phrase", "rank").collect()}
    want = {i: next(((n, p, name) for n, p, name in phrases if p and s is not None and p in s), (None, None, None)) for i, s in texts}
    assert got == want and any(v[0] is not None for v in want.values())


@pytest.mark.parametrize("lengths", [1, 3, 8])
def test_rules_are_not_broadcast(spark, lengths):
    rng = random.Random(lengths)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    phrases = [(i, word(rng.randint(2, 14)), f"name{i}") for i in range(400)]
    texts = [(i, word(rng.randint(0, 40))) for i in range(150)]
    t, r = spark.createDataFrame(texts, "id int, said string"), spark.createDataFrame(phrases, "rank int, phrase string, name string")
    found = rules.first_rule(t, "said", r, "phrase", "rank", lengths=lengths)
    got = {x.id: (x.rank, x.phrase, x.name) for x in found.collect()}
    assert got == {i: next((x for x in phrases if x[1] in s), (None, None, None)) for i, s in texts}
    assert [x for x in rules.first_rule(t, "said", r.limit(0), "phrase", "rank").collect() if x.phrase] == []
    # rules can be as many as texts: no join may gather one side in the driver
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
