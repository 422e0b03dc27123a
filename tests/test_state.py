"""Streams with state and watched folders, against plain loops."""

import os
import random
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from voltaweave import scratch
from voltaweave.operators import keyed
from voltaweave.streaming import listing, live, sessions, watch

MASKS = {0: ["a", "b"], 1: ["a", "c"], 2: ["a", "b", "c"]}
RECORDS = "key string, month string, src int, o1 long, version long, gone boolean, a double, b string, c long"


def plain(rows):
    """The merged record of each key by the newest versions, one record after the other."""
    newest = {}
    for key, month, src, o1, version, gone, *fields in rows:
        one = (version, gone, [(x is not None, x if x is not None else 0) for x in fields], fields)
        place = (key, month, src, o1)
        if place not in newest or one[:3] > newest[place][:3]:
            newest[place] = one
    out = {}
    for (key, month, src, _), (_, gone, _, fields) in sorted(newest.items(), key=lambda x: x[0]):
        if gone:
            continue
        if (key, month) not in out:
            out[key, month] = [*fields, src]
            continue
        have = out[key, month]
        for i, f in enumerate("abc"):
            if have[i] is None and f in MASKS[src]:
                have[i] = fields[i]
    return {k: tuple(v) for k, v in out.items()}


def records(seed, n=600):
    rng = random.Random(seed)
    maybe = lambda x: rng.choice([None, x])
    return [
        (f"K{rng.randint(0, 9)}", f"2024-0{rng.randint(1, 3)}", rng.randint(0, 2), rng.randint(0, 5), rng.randint(1, 4), rng.random() < 0.3, maybe(rng.randint(0, 9) / 2), maybe(rng.choice("xyz")), maybe(rng.randint(0, 99)))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_gives_the_batch_result(spark, tmp_path, seed):
    rows = records(seed)
    cuts = [rows[0:50], rows[50:400], [], rows[400:]]
    args = (["key", "month"], ["a", "b", "c"], MASKS, "src", ["o1"])
    for cut in cuts:
        spark.createDataFrame(cut, RECORDS).repartition(2).write.mode("append").parquet(f"{tmp_path}/landing")
        stream = spark.readStream.schema(RECORDS).parquet(f"{tmp_path}/landing")
        live.follow_history(stream, f"{tmp_path}/out", f"{tmp_path}/state", *args).awaitTermination()
    batches = len(os.listdir(f"{tmp_path}/out/changes"))
    got = watch.upserted(spark, f"{tmp_path}/out", batches - 1, ["key", "month"]).filter("present").collect()
    assert {(r.key, r.month): (r.a, r.b, r.c, r.src) for r in got} == plain(rows)
    # and what the batch operator makes of the survivors
    newest = {}
    for r in rows:
        place = r[:4]
        rank = lambda x: (x[4], x[5], [(v is not None, v if v is not None else 0) for v in x[6:]])
        if place not in newest or rank(r) > rank(newest[place]):
            newest[place] = r
    alive = spark.createDataFrame([r for r in newest.values() if not r[5]], RECORDS)
    batch = keyed.masked_fill_upsert(alive, ["key", "month"], ["a", "b", "c"], MASKS, "src", F.col("o1"))
    assert {(r.key, r.month): (r.a, r.b, r.c, r.src) for r in batch.collect()} == plain(rows)
    # settings of the session are as before
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


class Handle:
    """A state in a dict, which counts its calls."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def getMapState(self, name, key, value):  # noqa: N802
        return self

    def getValue(self, key):  # noqa: N802
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.calls += 1
        self.held[key] = value


def test_calls_to_the_state_follow_shelves_not_keys():
    from pyspark.sql.types import StructType

    made = StructType.fromDDL("key string, month string, a double, b string, c long, src long, present boolean")
    handle, out = Handle(), {}
    merge = live.LiveMerge(["key", "month"], ["a", "b", "c"], MASKS, ["src", "o1"], None, made)
    merge.init(handle)
    rows = [(f"{r[0]}-{i % 40}", *r[1:]) for i, r in enumerate(records(3, 1500))]
    row = Row("_bucket", "_shelf", *(c.split()[0] for c in RECORDS.split(", ")))
    for cut in (rows[:700], rows[700:]):
        for r in merge.handleInputRows((0,), iter([row(0, sum(map(ord, x[0] + x[1])) % 4, *x) for x in cut]), None):
            out[r.key, r.month] = (r.present, (r.a, r.b, r.c, r.src))
    assert {k: v for k, (there, v) in out.items() if there} == plain(rows)
    assert len(out) > 500 and handle.calls <= 2 * 2 * 4


def test_upserts_leave_only_what_is_read(spark, tmp_path):
    publish = watch.upsert_into(str(tmp_path), ["k"], "at", every=3)
    rng, want = random.Random(3), {}
    for n in range(11):
        rows = [(rng.randint(0, 5), rng.randint(0, 9), n) for _ in range(4)]
        for k, at, v in sorted(rows, key=lambda r: (r[1], r[2])):
            if k not in want or at >= want[k][0]:
                want[k] = (at, v)
        publish(spark.createDataFrame(rows, "k int, at int, v int"), n)
        if n % 4 == 3:
            publish(spark.createDataFrame(rows, "k int, at int, v int"), n)  # a batch that comes again
        got = {r.k: r.at for r in watch.upserted(spark, str(tmp_path), n, ["k"], "at", every=3).collect()}
        assert got == {k: at for k, (at, _) in want.items()}
    assert sorted(os.listdir(tmp_path / "changes")) == ["batch=10"] + [f"batch={i}" for i in range(6, 10)]
    assert sorted(os.listdir(tmp_path / "merged")) == ["batch=5", "batch=8"]


def test_folder_of_files(spark, tmp_path):
    folder, home = tmp_path / "in", str(tmp_path / "state")
    folder.mkdir()

    def tick(n):
        now = listing.digested(spark, str(folder), listing.listed(spark, str(folder)), listing.state(spark, home, n - 1))
        return {r.path.rsplit("/", 1)[1]: r.kind for r in listing.step(now, home, n).collect()}

    def put(name, text, at):
        (folder / name).write_text(text)
        os.utime(folder / name, (at, at))

    for i, name in enumerate("abcd"):
        put(name, name, 1000 + i)
    assert tick(0) == dict.fromkeys("abcd", "added")
    assert tick(1) == {}
    put("a", "other", 500)  # rewritten, and its time goes back
    put("b", "b", 2000)  # written again as it was
    os.remove(folder / "c")
    put("e", "new", 1)
    put("f", "", 1)  # not there as long as it is empty
    want = {"a": "changed", "b": "touched", "c": "removed", "e": "added"}
    assert tick(2) == want
    assert tick(2) == want  # a tick that failed is done again
    put("c", "c", 3000)
    put("d", "D", 1003)  # another text of the same length at the same time can't be seen
    assert tick(3) == {"c": "returned"}
    os.remove(folder / "a")
    put("e", "", 7)
    assert tick(4) == {"a": "removed", "e": "removed"} and tick(5) == {}
    state = {r.path.rsplit("/", 1)[1]: r.gone for r in listing.state(spark, home, 5).collect()}
    assert state == {"a": True, "b": False, "c": False, "d": False, "e": True}


def test_ticks_against_a_plain_diff(spark, tmp_path):
    rng, known, home = random.Random(7), {}, str(tmp_path / "state")
    for n in range(5):
        now = {f"p{i}": (rng.randint(1, 3), rng.choice("xyz")) for i in range(30) if rng.random() < 0.7}
        want = {}
        for p in now | known:
            if p not in now:
                if not known[p][2]:
                    continue
                want[p], known[p] = "removed", (*known[p][:2], False)
            else:
                at, text = now[p]
                if p not in known:
                    want[p] = "added"
                elif not known[p][2]:
                    want[p] = "returned"
                elif known[p][1] != text:
                    want[p] = "changed"
                elif known[p][0] != at:
                    want[p] = "touched"
                known[p] = (at, text, True)
        rows = [(p, at, 1, text) for p, (at, text) in now.items()]
        df = spark.createDataFrame(rows, "path string, at int, length long, digest string").select("path", F.timestamp_seconds("at").alias("modified"), "length", "digest")
        assert {r.path: r.kind for r in listing.step(df, home, n).collect()} == want


def test_followed_folder(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a").write_text("one")
    told = []
    query = listing.follow(spark, str(folder), str(tmp_path / "state"), lambda df, n: told.append((n, {(r.path[-1], r.kind) for r in df.collect()})), str(tmp_path / "clock"), every="1 second")
    try:
        def until(kinds):
            for _ in range(60):
                if [k for _, k in told] == kinds:
                    return
                time.sleep(0.5)
            assert [k for _, k in told] == kinds

        until([{("a", "added")}])
        (folder / "a").write_text("another")
        (folder / "b").write_text("two")
        for _ in range(60):
            if {k for _, kinds in told[1:] for k in kinds} == {("a", "changed"), ("b", "added")}:
                break
            time.sleep(0.5)
        assert {k for _, kinds in told[1:] for k in kinds} == {("a", "changed"), ("b", "added")}  # in one tick or two
    finally:
        query.stop()
    assert [n for n, _ in told] == sorted({n for n, _ in told})


def test_sessions_of_late_events(spark, tmp_path):
    rng = random.Random(5)
    events = [(rng.choice([None, 1, 2, 3]), rng.randint(0, 20_000), i) for i in range(300)]
    want = []
    for user in {u for u, _, _ in events}:
        run = sorted(t for u, t, _ in events if u == user)
        start = last = run[0]
        n = 1
        for t in [*run[1:], None]:
            if t is None or t - last > 60:
                want.append((user, start, last + 60, n))
                start, n = t, 0
            last, n = t, n + 1
    schema = "user int, at int, i int"
    df = spark.createDataFrame(events, schema).withColumn("at", F.timestamp_seconds("at"))
    told = lambda d: sorted(((r.user, r.start, r.end, r.n) for r in d.select("user", F.unix_timestamp("start").alias("start"), F.unix_timestamp("end").alias("end"), "n").collect()), key=str)
    assert told(sessions.sessions(df, ["user"], "at", "60 seconds")) == sorted(want, key=str)

    last = spark.createDataFrame([(99, 90_000, -1)], schema).withColumn("at", F.timestamp_seconds("at"))
    for part in (df.filter("i % 3 = 0"), df.filter("i % 3 = 1"), df.filter("i % 3 = 2").unionByName(last)):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = sessions.sessions(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), ["user"], "at", "60 seconds", late="30000 seconds")
        stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").outputMode("append").trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    assert told(spark.read.parquet(f"{tmp_path}/out").filter("user is null or user <> 99")) == sorted(want, key=str)
    with pytest.raises(ValueError):
        sessions.sessions(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), ["user"], "at", "60 seconds")


def test_scratch_folders(spark, tmp_path):
    path = scratch.folder(spark, "x")
    assert not scratch.exists(spark, path)
    spark.range(1).write.parquet(path)
    assert scratch.exists(spark, path)
    scratch.remove(spark, path)
    scratch.remove(spark, path)
    assert not scratch.exists(spark, path)
