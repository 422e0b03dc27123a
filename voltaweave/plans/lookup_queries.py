"""Queries of lookups that need more than an equi-join: the latest record before, ranks of large groups, phrase rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, quantiles, rules
from .catalog import query, table


@query("""
    WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'), v AS (SELECT * FROM events WHERE event_type = 'view'),
    m AS (SELECT p.event_id, p.user_id, p.value, p.ts, v.ts AS vts, v.event_id AS vid, v.value AS vvalue, row_number() OVER (PARTITION BY p.event_id ORDER BY v.ts DESC, v.event_id DESC) AS rn
          FROM p LEFT JOIN v ON v.user_id = p.user_id AND v.ts <= p.ts)
    SELECT event_id, user_id, value, epoch_us(ts) AS at, epoch_us(vts) AS last_at, vid AS last_event_id, vvalue AS last_value FROM m WHERE rn = 1
""")
def asof_lookup(spark, sf_dir):
    """The latest view at or before each purchase of a user."""
    e = table(spark, sf_dir, "events")
    bought, seen = (e.filter(F.col("event_type") == t).select("event_id", "user_id", "value", "ts") for t in ("purchase", "view"))
    found = asof.latest_before(bought, seen, ["user_id"], "ts", ["event_id", "value"], order=["event_id"])
    return found.select("event_id", "user_id", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.unix_micros(F.col("last_ts").cast("timestamp")).alias("last_at"), "last_event_id", "last_value")


@query("""
    SELECT o_orderpriority, quantile_disc(o_totalprice, 0.25) AS p25, quantile_disc(o_totalprice, 0.5) AS median, quantile_disc(o_totalprice, 0.75) AS p75,
           round(quantile_cont(o_totalprice, 0.25), 4) AS c25, round(quantile_cont(o_totalprice, 0.5), 4) AS cmedian, round(quantile_cont(o_totalprice, 0.75), 4) AS c75
    FROM orders GROUP BY 1
""")
def group_quantiles(spark, sf_dir):
    """Three quantiles of the prices of each priority: values that occur, and points between them."""
    orders, shares = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice"), [0.25, 0.5, 0.75]
    one = quantiles.quantiles(orders, ["o_orderpriority"], "o_totalprice", shares)
    two = quantiles.quantiles(orders, ["o_orderpriority"], "o_totalprice", shares, interpolated=True)
    names = lambda df, *to: df.select("o_orderpriority", *(f("quantiles", i).alias(t) for i, t in enumerate(to)))
    f = F.get
    return names(one, "p25", "median", "p75").join(names(two, "c25", "cmedian", "c75").select("o_orderpriority", *(F.round(c, 4).alias(c) for c in ("c25", "cmedian", "c75"))), "o_orderpriority")


_PHRASE = "CASE WHEN p_partkey % 97 = 0 THEN substr(md5(CAST(p_partkey AS VARCHAR(20))), 1, 2) WHEN p_partkey % 3 = 0 THEN substr(md5(CAST(p_partkey AS VARCHAR(20))), 1, 5) ELSE substr(md5(CAST(p_partkey AS VARCHAR(20))), 1, 3) END"


@query(f"""
    WITH r AS (SELECT p_partkey, {_PHRASE} AS phrase FROM part), t AS (SELECT c_custkey, md5(c_name) AS said FROM customer),
    m AS (SELECT c_custkey, min(p_partkey) AS p_partkey FROM t JOIN r ON contains(said, phrase) GROUP BY 1)
    SELECT t.c_custkey, said, m.p_partkey, phrase FROM t LEFT JOIN m ON t.c_custkey = m.c_custkey LEFT JOIN r ON r.p_partkey = m.p_partkey
""")
def phrase_rules(spark, sf_dir):
    """A rule for each part, and for each customer the first whose phrase its text contains."""
    said = table(spark, sf_dir, "customer").select("c_custkey", F.md5(F.col("c_name").cast("binary")).alias("said"))
    rule = table(spark, sf_dir, "part").select("p_partkey", F.expr(_PHRASE.replace("md5(CAST(p_partkey AS VARCHAR(20)))", "md5(CAST(CAST(p_partkey AS STRING) AS BINARY))")).alias("phrase"))
    return rules.first_rule(said, "said", rule, "phrase", "p_partkey")
