"""Queries that run streams and ticks over the driver's tables; their SQL is the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import scratch
from ..streaming import listing, live, sessions, watch
from .catalog import query, table

_MASKS = {0: ["a", "b", "c"], 1: ["a"], 2: ["b", "c"]}


@query("""
    WITH r AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderkey, (CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1) // 2 AS src,
                      CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS a, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS b, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS c
               FROM orders WHERE o_orderkey % 11 <> 0),
    n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, month ORDER BY src, o_orderkey) AS rn FROM r)
    SELECT o_custkey, month, coalesce(max(a) FILTER (WHERE rn = 1), arg_min(a, rn) FILTER (WHERE a IS NOT NULL AND src IN (0, 1))) AS a,
           coalesce(max(b) FILTER (WHERE rn = 1), arg_min(b, rn) FILTER (WHERE b IS NOT NULL AND src IN (0, 2))) AS b,
           coalesce(max(c) FILTER (WHERE rn = 1), arg_min(c, rn) FILTER (WHERE c IS NOT NULL AND src IN (0, 2))) AS c, CAST(arg_min(src, rn) AS BIGINT) AS src
    FROM n GROUP BY 1, 2
""")
def live_history(spark, sf_dir):
    """Orders as records of three sources that arrive in three deliveries: a fifth first with other values, an eleventh taken back, newer versions before older ones."""
    k = F.col("o_orderkey")
    status = lambda s: F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey", F.expr("(cast(substr(o_orderpriority, 1, 1) as int) - 1) div 2").alias("src"),
        status("F").alias("a"), status("O").alias("b"), F.when(k % 2 == 0, k).alias("c"),
    )
    none = {f: F.lit(None).cast(rows.schema[f].dataType) for f in "abc"}
    sent = [
        rows.withColumns({"version": F.lit(2), "gone": F.lit(False)}),
        rows.filter(k % 5 == 0).withColumns({"a": F.col("b"), "b": F.lit(1.0), "c": -k, "version": F.lit(1), "gone": F.lit(False)}),
        rows.filter(k % 11 == 0).withColumns({**none, "version": F.lit(3), "gone": F.lit(True)}),
    ]
    sent = sent[0].unionByName(sent[1]).unionByName(sent[2])
    # records of one order come in any of the orders in which versions can come
    sent = sent.withColumn("delivery", F.pmod(F.xxhash64("o_orderkey") + F.col("version") * F.pmod(k, F.lit(7)), F.lit(3)).cast("int"))
    home = scratch.folder(spark, "live")
    names = [c for c in sent.columns if c != "delivery"]
    for i in range(3):
        sent.filter(F.col("delivery") == i).select(names).write.parquet(f"{home}/landing/delivery={i}")
        stream = spark.readStream.schema(sent.select(names).schema).option("recursiveFileLookup", "true").parquet(f"{home}/landing")
        live.follow_history(stream, f"{home}/out", f"{home}/state", ["o_custkey", "month"], ["a", "b", "c"], _MASKS, "src", ["o_orderkey"]).awaitTermination()
    scratch.remove(spark, f"{home}/landing")
    scratch.remove(spark, f"{home}/state")
    return watch.upserted(spark, f"{home}/out", 2, ["o_custkey", "month"]).filter("present").drop("present")


def _shown(t: int) -> str:
    """The pages as files of tick ``t``: one in eleven is missing, a fifth has another text, a third another time."""
    return f"""
        SELECT page_id AS id, concat('/pages/', CAST(page_id AS VARCHAR(20)), '.html') AS path, CAST(length(html) + CASE WHEN page_id % 5 = {t} THEN 1 ELSE 0 END AS BIGINT) AS length,
               CASE WHEN page_id % 3 = {t} THEN 1 ELSE 2 END AS at, md5(CASE WHEN page_id % 5 = {t} THEN concat(html, '!') ELSE html END) AS digest
        FROM pages WHERE page_id % 11 <> {t}
    """


def _changes(t: int) -> str:
    """What tick ``t`` changes: the tick before shows what is there, earlier ones whether a path is known."""
    seen = " UNION ".join(f"SELECT id FROM shown{i}" for i in range(t)) or "SELECT id FROM shown0 WHERE false"
    before = f"shown{t - 1}" if t else "(SELECT * FROM shown0 WHERE false)"
    return f"""
        SELECT coalesce(n.path, b.path) AS path, coalesce(n.length, b.length) AS length, coalesce(n.at, b.at) AS at, coalesce(n.digest, b.digest) AS digest, n.id IS NULL AS gone,
               CASE WHEN n.id IS NULL THEN 'removed' WHEN b.id IS NULL THEN CASE WHEN n.id IN ({seen}) THEN 'returned' ELSE 'added' END
                    WHEN n.digest <> b.digest THEN 'changed' ELSE 'touched' END AS kind, CAST({t} AS BIGINT) AS tick
        FROM shown{t} n FULL JOIN {before} b ON n.id = b.id WHERE n.id IS NULL OR b.id IS NULL OR n.digest <> b.digest OR n.at <> b.at
    """


@query(f"WITH {', '.join(f'shown{t} AS ({_shown(t)})' for t in range(4))} {' UNION ALL '.join(f'SELECT * FROM ({_changes(t)})' for t in range(4))}")
def listing_changes(spark, sf_dir):
    """Four ticks of a folder that holds the pages as files."""
    home = scratch.folder(spark, "listing")
    pages, out = table(spark, sf_dir, "pages"), None
    for t in range(4):
        now = spark.sql(_shown(t).replace("FROM pages", "FROM {pages}"), pages=pages).select("path", F.timestamp_seconds(F.col("at")).alias("modified"), "length", "digest")
        made = listing.step(now, home, t)
        out = made if out is None else out.unionByName(made)
    return out.select("path", "length", F.unix_timestamp("modified").cast("int").alias("at"), "digest", "gone", "kind", "tick")


@query("""
    WITH e AS (SELECT user_id, ts, event_type, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS since FROM events),
    s AS (SELECT *, count(*) FILTER (WHERE since IS NULL OR since > INTERVAL 6 HOUR) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM e)
    SELECT user_id, epoch_us(min(ts)) AS start, epoch_us(max(ts)) + 21600000000 AS "end", count(*) AS n, count(DISTINCT event_type) FILTER (WHERE event_type <> 'view') AS kinds
    FROM s GROUP BY user_id, session
""")
def event_sessions(spark, sf_dir):
    """Sessions of events that arrive in two deliveries, a tenth of the first half so late that sessions have to be merged."""
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "event_id")
    span = e.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    middle = span.first + (span.last - span.first) / 2
    early = (F.col("ts") < F.lit(middle)) & (F.col("event_id") % 10 != 0)
    home = scratch.folder(spark, "sessions")
    names = ["user_id", "ts", "event_type"]
    e.filter(early).select(names).write.parquet(f"{home}/landing/delivery=0")
    kinds = F.size(F.array_remove(F.collect_set("event_type"), "view")).cast("long").alias("kinds")
    days = (span.last - span.first).days + 2
    for i in range(2):
        if i:
            # one event after all others moves the watermark past every session
            end = spark.range(1).select(F.lit(None).cast("long").alias("user_id"), (F.lit(span.last) + F.expr(f"INTERVAL {2 * days} DAYS")).alias("ts"), F.lit("end").alias("event_type"))
            e.filter(~early).select(names).unionByName(end).write.parquet(f"{home}/landing/delivery=1")
        stream = spark.readStream.schema(e.select(names).schema).option("recursiveFileLookup", "true").parquet(f"{home}/landing")
        made = sessions.sessions(stream, ["user_id"], "ts", "6 hours", kinds, late=f"{days} days")
        made.writeStream.format("parquet").option("checkpointLocation", f"{home}/state").outputMode("append").trigger(availableNow=True).start(f"{home}/out").awaitTermination()
    out = spark.read.schema(made.schema).parquet(f"{home}/out").filter("user_id is not null")
    return out.select("user_id", F.unix_micros("start").alias("start"), F.unix_micros("end").alias("end"), "n", "kinds")
