"""The registered queries and the SQL that each is held against.

Every query binds one operator to the driver's tables, whole; the operators
themselves are generic and are bound to grid data in ``voltaweave.plans.grid``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, numeric, text
from ..operators import cases, forecast, headers, keyed, radar, series, stats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
ASOF = "2002-02-10"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# ---- numbers, text and keys

_MESSY = """
    CASE event_id % 9 WHEN 0 THEN 'N/A' WHEN 1 THEN '' WHEN 2 THEN '1d' WHEN 3 THEN '1_000' WHEN 4 THEN 'nan'
         WHEN 5 THEN '-' WHEN 6 THEN concat(CAST(event_id AS VARCHAR(20)), ',5') WHEN 7 THEN ' 1.5 '
         ELSE CAST(event_id AS VARCHAR(20)) END
"""


@query(f"""
    WITH raw AS (SELECT event_id, {_MESSY} AS raw FROM events),
    pat AS (SELECT *, '^\\s*[+-]?((\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?)\\s*$' AS p FROM raw)
    SELECT event_id, raw,
           CASE WHEN raw NOT IN ('', 'N/A') AND regexp_matches(raw, p) THEN try_cast(trim(raw) AS DOUBLE) END AS plain,
           CASE WHEN trim(raw) NOT IN ('', 'N/A', 'N/D', '-', 'NA') AND regexp_matches(replace(raw, ',', '.'), p)
                THEN try_cast(trim(replace(raw, ',', '.')) AS DOUBLE) END AS with_comma
    FROM pat
""")
def numeric_sanitize(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select("event_id", F.expr(_MESSY).alias("raw"))
    return raw.select("event_id", "raw", numeric.to_float(F.col("raw")).alias("plain"), numeric.to_float_with_comma(F.col("raw")).alias("with_comma"))


@query("""
    SELECT p_partkey,
           upper(trim(p_name)) || ' ' || CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR)
                ELSE CAST(p_retailprice AS VARCHAR) END AS key
    FROM part
""")
def key_build_trim_upper(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", text.name_and_tension(F.concat(F.lit(" "), "p_name", F.lit("\t")), F.col("p_retailprice")).alias("key"))


@query("""
    WITH named AS (SELECT c_custkey, c_name || ' (x)  ' || CAST(c_custkey % 500 AS VARCHAR) AS name FROM customer)
    SELECT c_custkey, try_cast(regexp_extract(name, '(\\S+)$', 1) AS DOUBLE) AS last_token,
           try_cast(nullif(regexp_extract(name, '\\b(\\d{2,4})\\s*$', 1), '') AS INTEGER) AS closing,
           coalesce(nullif(trim(regexp_replace(name, '\\b(\\d{2,4})\\s*$', '')), ''), name) AS without_closing,
           regexp_extract(name, '^(\\S+)', 1) || ' (x)' AS but_last,
           regexp_extract(name, '^(\\S+)', 1) || ' ' || CAST(c_custkey % 500 AS VARCHAR) AS normal
    FROM named
""")
def tail_token_extract(spark, sf_dir):
    named = table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit(" (x)  "), (F.col("c_custkey") % 500).cast("string")).alias("name"))
    name = F.col("name")
    return named.select(
        "c_custkey",
        text.tension_of_last_token(name).alias("last_token"),
        text.tension_of_end(name).alias("closing"),
        text.without_tension(name).alias("without_closing"),
        text.all_but_last_token(name).alias("but_last"),
        text.normal_key(name).alias("normal"),
    )


@query("""
    SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%red%' THEN 'Red' WHEN lower(p_name) LIKE '%ring%' THEN 'Ring' WHEN lower(p_name) LIKE '%small%' THEN 'Small'
                ELSE array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') END AS canonical
    FROM part
""")
def rule_canonicalise(spark, sf_dir):
    rules = [("red", "Red"), ("ring", "Ring"), ("small", "Small")]
    return table(spark, sf_dir, "part").select("p_partkey", text.canonical(F.col("p_name"), rules).alias("canonical"))


@query("""
    WITH v AS (SELECT l_orderkey, l_linenumber, nullif(l_quantity, 1) AS a, nullif(l_tax, 0) AS b, nullif(l_discount, 0) AS c FROM lineitem)
    SELECT l_orderkey, l_linenumber, round(a - b, 4) AS change, CASE WHEN coalesce(b, c) IS NOT NULL THEN round(coalesce(b, 0) + coalesce(c, 0), 4) END AS known_sum,
           round(a - coalesce(b, 0), 4) AS net FROM v
""")
def null_aware_arith(spark, sf_dir):
    a, b, c = (F.nullif(F.col(x), F.lit(v)) for x, v in (("l_quantity", 1.0), ("l_tax", 0.0), ("l_discount", 0.0)))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", numeric.delta(a, b).alias("change"), numeric.add_known(b, c).alias("known_sum"), numeric.less_pending(a, b).alias("net")
    )


@query("""
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'DSO' ELSE 'REE' END AS kind, 2000 + CAST(c_custkey % 100 AS INTEGER) AS year,
           CAST(c_custkey % 12 + 1 AS INTEGER) AS month
    FROM customer WHERE c_custkey % 5 <> 0
""")
def sheet_routing(spark, sf_dir):
    from ..sources.bronze import monthly_sheet

    short = F.substring(F.element_at(F.array(*map(F.lit, text.MONTHS)), (F.col("c_custkey") % 12 + 1).cast("int")), 1, 3)
    kind = F.when(F.col("c_custkey") % 3 == 0, "dso ").otherwise("REE ")
    name = F.when(F.col("c_custkey") % 5 == 0, "Notes").otherwise(F.concat(kind, F.initcap(short), F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0")))
    routed = table(spark, sf_dir, "customer").select("c_custkey", *monthly_sheet(name))
    return routed.filter("kind is not null")


@query("""
    SELECT s_suppkey, (s_suppkey % 28 + 1) || '' AS day_text, CASE WHEN s_suppkey % 3 <> 0
           THEN printf('%d-%02d-%02d', 2010 + s_suppkey % 20, s_suppkey % 12 + 1, s_suppkey % 28 + 1) END AS day,
           CASE WHEN s_suppkey % 3 <> 0 THEN CAST(2010 + s_suppkey % 20 AS INTEGER) END AS year, CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey % 12 + 1 AS INTEGER) END AS month
    FROM supplier
""")
def dated_sheet_routing(spark, sf_dir):
    from ..sources.bronze import dated_sheet, map_sheet

    key = F.col("s_suppkey")
    day = (key % 28 + 1).cast("string")
    month = F.when(key % 3 == 0, "brumario").otherwise(F.element_at(F.array(*map(F.lit, text.MONTHS)), (key % 12 + 1).cast("int")))
    name = F.concat_ws(" ", day, F.initcap(month), (2010 + key % 20).cast("string"))
    year, number = map_sheet(name)
    return table(spark, sf_dir, "supplier").select("s_suppkey", day.alias("day_text"), dated_sheet(name).alias("day"), year.alias("year"), number.alias("month"))


@query("""
    WITH cells AS (SELECT p_partkey // 8 AS sheet, CAST(p_partkey % 8 + 1 AS INTEGER) AS row_idx, pos, CASE pos WHEN 0 THEN p_type WHEN 1 THEN p_name ELSE p_name || ' ' || p_type END AS cell
                   FROM part, (VALUES (0), (1), (2)) t(pos)),
    hits AS (SELECT sheet, 'ring' AS field, row_idx, pos, row_idx * 10 + pos AS ord FROM cells WHERE cell LIKE '%ring%'
             UNION ALL SELECT sheet, 'gear', row_idx, pos, -(row_idx * 10 + pos) FROM cells WHERE cell LIKE '%gear%'
             UNION ALL SELECT sheet, 'bolt', row_idx, pos, row_idx * 10 + pos FROM cells WHERE cell LIKE '%hot bolt%'
             UNION ALL SELECT sheet, 'bolt', row_idx, pos, 1000 + row_idx * 10 + pos FROM cells WHERE cell LIKE '%bolt%')
    SELECT 'S' || sheet AS sheet, field, CAST(arg_min(row_idx, ord) AS INTEGER) AS row_idx, CAST(arg_min(pos, ord) AS INTEGER) AS pos FROM hits GROUP BY ALL
""")
def header_resolve(spark, sf_dir):
    cells = F.array("p_type", "p_name", F.concat("p_name", F.lit(" "), "p_type"))
    sheet, row = F.concat(F.lit("S"), F.expr("p_partkey div 8").cast("string")), (F.col("p_partkey") % 8 + 1).cast("int")
    bronze = table(spark, sf_dir, "part").select(sheet.alias("sheet"), row.alias("row_idx"), cells.alias("cells"))
    rules = [
        headers.Rule("ring", lambda t: t.contains("ring"), headers.EIGHT),
        headers.Rule("gear", lambda t: t.contains("gear"), headers.EIGHT, last=True),
        headers.Rule("bolt", lambda t: t.contains("hot bolt"), headers.EIGHT),
        headers.Rule("bolt", lambda t: t.contains("bolt"), headers.EIGHT, priority=1),
    ]
    return headers.resolve_columns(bronze, rules, text.stripped)


# ---- keyed operators


@query("""
    WITH l AS (SELECT s_suppkey, 'NATION_' || s_nationkey AS n,
                      CASE s_suppkey % 4 WHEN 0 THEN 'NATION_' || s_nationkey WHEN 1 THEN 'NATION_' || s_nationkey || ' (ALT)'
                           WHEN 2 THEN 'X (NATION_' || s_nationkey || ') 220' ELSE 'NONE' END AS k FROM supplier)
    SELECT s_suppkey, k, CASE WHEN s_suppkey % 4 < 3 THEN CAST(s_suppkey % 4 AS INTEGER) END AS match_rank, n_name, n_regionkey
    FROM l LEFT JOIN nation ON n_name = n AND s_suppkey % 4 < 3
""")
def priority_cascade_match(spark, sf_dir):
    n, turn = F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")), F.col("s_suppkey") % 4
    k = F.when(turn == 0, n).when(turn == 1, F.concat(n, F.lit(" (ALT)"))).when(turn == 2, F.concat(F.lit("X ("), n, F.lit(") 220"))).otherwise("NONE")
    left = table(spark, sf_dir, "supplier").select("s_suppkey", k.alias("k"))
    alias = F.nullif(F.regexp_extract("k", r"^(.+?)\s*\((.+?)\)\s*(\d+)$", 2), F.lit(""))
    matched = keyed.priority_match(
        left.select("s_suppkey", "k"), table(spark, sf_dir, "nation").select("n_name", "n_regionkey"), "s_suppkey", "n_name",
        [(F.col("k"), False), (F.col("k"), True), (alias, False), (alias, True)], text.normal_key,
    )
    return matched.select("s_suppkey", "k", "match_rank", "n_name", "n_regionkey")


@query("""
    WITH c AS (SELECT 'K' || c_custkey AS key, c_name AS name FROM customer), s AS (SELECT 'K' || s_suppkey * 30 AS key, s_name AS name FROM supplier)
    SELECT key, name, 'left' AS side FROM c
    UNION ALL SELECT CASE WHEN key IN (SELECT key FROM c) THEN key || ' (REE)' ELSE key END,
                     CASE WHEN key IN (SELECT key FROM c) THEN name || ' (REE)' ELSE name END, 'right' FROM s
""")
def collision_rename_union(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(F.concat(F.lit("K"), F.col("c_custkey").cast("string")).alias("key"), F.col("c_name").alias("name"), F.lit("left").alias("side"))
    right = table(spark, sf_dir, "supplier").select(F.concat(F.lit("K"), (F.col("s_suppkey") * 30).cast("string")).alias("key"), F.col("s_name").alias("name"), F.lit("right").alias("side"))
    return keyed.rename_collisions(left, right, "key", " (REE)", also=["name"])


@query("""
    WITH r AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderkey, (CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1) // 2 AS src,
                      CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS a, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS b,
                      CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS c FROM orders),
    n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, month ORDER BY src, o_orderkey) AS rn FROM r)
    SELECT o_custkey, month,
           coalesce(max(CASE WHEN rn = 1 THEN a END), arg_min(a, rn) FILTER (WHERE a IS NOT NULL AND src IN (0, 1))) AS a,
           coalesce(max(CASE WHEN rn = 1 THEN b END), arg_min(b, rn) FILTER (WHERE b IS NOT NULL AND src IN (0, 2))) AS b,
           coalesce(max(CASE WHEN rn = 1 THEN c END), arg_min(c, rn) FILTER (WHERE c IS NOT NULL AND src IN (0, 2))) AS c,
           CAST(min(src) AS INTEGER) AS src
    FROM n GROUP BY 1, 2
""")
def masked_fill_upsert(spark, sf_dir):
    status = lambda s: F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey",
        F.expr("(cast(substr(o_orderpriority, 1, 1) as int) - 1) div 2").cast("int").alias("src"),
        status("F").alias("a"), status("O").alias("b"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).alias("c"),
    )
    masks = {0: ["a", "b", "c"], 1: ["a"], 2: ["b", "c"]}
    return keyed.masked_fill_upsert(rows, ["o_custkey", "month"], ["a", "b", "c"], masks, "src", F.col("o_orderkey"))


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def last_wins_dedup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return keyed.last_wins(orders, ["o_custkey"], F.col("o_orderdate"), F.col("o_orderkey")).drop("o_orderdate")


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
""")
def first_wins_dedup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return keyed.first_wins(orders, ["o_custkey"], F.col("o_orderdate"), F.col("o_orderkey")).drop("o_orderdate")


@query("""
    SELECT c_nationkey, c_custkey, c_acctbal, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS rank
    FROM customer QUALIFY rank <= 5
""")
def topn_per_group(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return keyed.top_per_group(customer, ["c_nationkey"], 5, F.desc("c_acctbal"), F.asc("c_custkey"))


@query("""
    SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) IN (SELECT DISTINCT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_quantity = 50)
""")
def backfill_semi_join(spark, sf_dir):
    days = table(spark, sf_dir, "lineitem").filter("l_quantity = 50").select(F.to_date("l_shipdate").alias("day")).distinct()
    orders = table(spark, sf_dir, "orders")
    return orders.join(days, F.to_date("o_orderdate") == F.col("day"), "left_semi").select("o_orderkey", "o_custkey")


@query("""
    WITH l AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 1 THEN 'NATON ' ELSE 'NATION ' END || CAST(s_nationkey % 10 AS VARCHAR) AS base, CASE WHEN s_suppkey % 2 = 0 THEN 66 ELSE 220 END AS kv FROM supplier),
    r AS (SELECT 'NATION ' || CAST(n_nationkey % 10 AS VARCHAR) || 'X' || CASE WHEN n_nationkey < 10 THEN ' 66' WHEN n_nationkey < 20 THEN ' 132' ELSE ' 220' END AS place,
                 'NATION ' || CAST(n_nationkey % 10 AS VARCHAR) || 'X' AS base, CASE WHEN n_nationkey < 10 THEN 66 WHEN n_nationkey < 20 THEN 132 ELSE 220 END AS kv FROM nation)
    SELECT s_suppkey, place, CAST(levenshtein(l.base, r.base) AS INTEGER) AS distance FROM l JOIN r ON levenshtein(l.base, r.base) <= 2
    QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY levenshtein(l.base, r.base), abs(l.kv - r.kv), place) = 1
""")
def fuzzy_name_link(spark, sf_dir):
    n = F.col("s_nationkey") % 10
    raw = F.concat(F.when(F.col("s_suppkey") % 3 == 1, "La Náton ").when(F.col("s_suppkey") % 3 == 2, "SET Natiòn ").otherwise("nation-"), n.cast("string"), F.when(F.col("s_suppkey") % 2 == 0, " 66 kV").otherwise(" 220"))
    kv = F.when(F.col("n_nationkey") < 10, " 66").when(F.col("n_nationkey") < 20, " 132").otherwise(" 220")
    places = table(spark, sf_dir, "nation").select(F.concat(F.lit("NATION "), (F.col("n_nationkey") % 10).cast("string"), F.lit("X"), kv).alias("place"))
    left = table(spark, sf_dir, "supplier").select("s_suppkey", raw.alias("name"))
    return keyed.fuzzy_link(left, places, "name", "place").select("s_suppkey", "place", "distance")


_TYPO = """
    SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN substr(p_name, 2) WHEN 1 THEN concat(substr(p_name, 2, 1), substr(p_name, 1, 1), substr(p_name, 3))
           WHEN 2 THEN concat(substr(p_name, 1, 4), 'q', substr(p_name, 6)) WHEN 3 THEN concat('xx', p_name) WHEN 4 THEN substr(p_name, 1, length(p_name) - 2)
           ELSE concat(substr(p_name, 1, 1 + p_partkey % 5), 'zz', substr(p_name, 3 + p_partkey % 5)) END AS name
    FROM part
"""


@query(f"""
    WITH n AS ({_TYPO}), l AS (SELECT DISTINCT upper(name) AS l FROM n), r AS (SELECT DISTINCT upper(p_name) AS r FROM part),
    m AS (SELECT l, r, CAST(levenshtein(l, r) AS INTEGER) AS distance FROM l JOIN r ON abs(length(l) - length(r)) <= 2 AND levenshtein(l, r) <= 2)
    SELECT p_partkey, name, r AS place, distance, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY distance, r) AS INTEGER) AS rank
    FROM n JOIN m ON upper(name) = l QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY distance, r) <= 3
""")
def fuzzy_typo_links(spark, sf_dir):
    """Part names with letters lost, swapped, added and replaced, at the start too, and the three nearest true names of each."""
    part = table(spark, sf_dir, "part")
    names = spark.sql(_TYPO.replace("FROM part", "FROM {part}"), part=part)
    found = keyed.fuzzy_candidates(names, part.select(F.upper("p_name").alias("place")).distinct(), "name", "place")
    return names.join(found, "name").select("p_partkey", "name", "place", "distance", "rank")


@query("""
    SELECT 'customer' AS source, c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_name, s_nationkey FROM supplier
""")
def union_with_provenance(spark, sf_dir):
    named = lambda t, p: table(spark, sf_dir, t).select(F.lit(t).alias("source"), F.col(f"{p}_name").alias("name"), F.col(f"{p}_nationkey").alias("nation"))
    return named("customer", "c").unionByName(named("supplier", "s"))


# ---- series


def _monthly(spark, sf_dir):
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    return table(spark, sf_dir, "orders").groupBy("o_custkey", month).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


_MONTHLY = "SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2"


@query(f"""
    WITH m AS ({_MONTHLY}) SELECT o_custkey, CAST(count(*) AS INTEGER) AS n, string_agg(month || ':' || CAST(CAST(round(total * 100) AS BIGINT) AS VARCHAR), '|' ORDER BY month) AS series
    FROM m GROUP BY 1
""")
def monthly_series_collect(spark, sf_dir):
    rows = series.collected(_monthly(spark, sf_dir), ["o_custkey"], "month", ["total"])
    cents = lambda x: F.round(x["total"] * 100).cast("long").cast("string")
    return rows.select("o_custkey", F.size("series").alias("n"), F.array_join(F.transform("series", lambda x: F.concat(x["month"], F.lit(":"), cents(x))), "|").alias("series"))


@query(f"""
    WITH m AS ({_MONTHLY}) SELECT o_custkey, month, total, round(total - lag(total) OVER (PARTITION BY o_custkey ORDER BY month), 4) AS change FROM m
""")
def period_delta(spark, sf_dir):
    return series.with_change(_monthly(spark, sf_dir), ["o_custkey"], "month", "total")


@query(f"""
    WITH m AS ({_MONTHLY}), d AS (SELECT *, round(total - lag(total) OVER (PARTITION BY o_custkey ORDER BY month), 4) AS change FROM m)
    SELECT * FROM d WHERE change >= 250000
""")
def positive_jumps(spark, sf_dir):
    return series.jumps(_monthly(spark, sf_dir), ["o_custkey"], "month", "total", 250_000.0)


@query(f"""
    WITH m AS ({_MONTHLY}), d AS (SELECT *, lag(total, 3) OVER (PARTITION BY o_custkey ORDER BY month) AS before FROM m)
    SELECT o_custkey, month, total, CASE WHEN before IS NOT NULL THEN greatest(round(before - total, 4), 0) END AS "drop" FROM d
""")
def queue_drop_3(spark, sf_dir):
    return series.queue_drop(_monthly(spark, sf_dir), ["o_custkey"], "month", "total")


@query("""
    WITH d AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, round(sum(value), 2) AS total FROM events GROUP BY 1, 2),
    c AS (SELECT *, round(total - lag(total) OVER (PARTITION BY user_id ORDER BY day), 4) AS change FROM d),
    z AS (SELECT *, avg(change) OVER w AS mean, stddev_samp(change) OVER w AS spread, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS rn FROM c
          WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT user_id, day, total, change, round(CASE WHEN spread > 0 THEN (change - mean) / spread END, 6) AS z FROM z WHERE rn = 1
""")
def zscore_last_change(spark, sf_dir):
    days = table(spark, sf_dir, "events").groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.round(F.sum("value"), 2).alias("total"))
    scored = series.change_scores(days, ["user_id"], "day", "total")
    return series.last_of_series(scored, ["user_id"], "day").withColumn("z", F.round("z", 6))


@query(f"""
    SELECT o_custkey, CAST(floor(date_diff('month', max(CAST(o_orderdate AS DATE)), DATE '{ASOF}')
           - CASE WHEN day(max(o_orderdate)) > 10 THEN 1 ELSE 0 END) AS INTEGER) AS months,
           count_if(CAST(o_orderdate AS DATE) BETWEEN DATE '2001-01-31' AND DATE '2001-07-31') AS due
    FROM orders GROUP BY 1
""")
def months_since_and_due(spark, sf_dir):
    day, asof = F.to_date("o_orderdate"), F.to_date(F.lit(ASOF))
    due = series.within_months(day, F.to_date(F.lit("2001-01-31")), 6)
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(series.months_since(F.max(day), asof).alias("months"), F.count_if(due).alias("due"))


# ---- forecasts, cases and scores


@query(f"""
    WITH e AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, o_totalprice AS v FROM orders WHERE o_totalprice >= 300000),
    q AS (SELECT o_custkey, quarter(d) AS q, count(*) AS n, min(d) AS first FROM e GROUP BY 1, 2),
    p AS (SELECT o_custkey, q, n FROM q QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, first) = 1),
    s AS (SELECT o_custkey, count(*) AS n_events, count(DISTINCT year(d)) AS n_years, round(round(sum(v) * 100) / count(*)) / 100 AS mean, max(v) AS max_size, max(d) AS last,
                 string_agg(strftime(d, '%Y-%m-%d'), '|' ORDER BY d) AS event_days FROM e GROUP BY 1),
    w AS (SELECT s.*, q, n, make_date(2002 + CASE WHEN q < 1 THEN 1 ELSE 0 END, CAST(q * 3 - 2 AS BIGINT), 1) AS start FROM s JOIN p USING (o_custkey))
    SELECT o_custkey, n_events, CAST(n_years AS INTEGER) AS n_years, CAST(q AS INTEGER) AS pattern_quarter, round(100.0 * n / n_events, 1) AS concentration_pct,
           mean AS mean_size, max_size, strftime(last, '%Y-%m-%d') AS last_event, strftime(start, '%Y-%m-%d') AS window_start,
           strftime(start + INTERVAL 3 MONTH - INTERVAL 1 DAY, '%Y-%m-%d') AS window_end,
           CASE WHEN q = 1 THEN 'EN_CURSO' ELSE 'en ' || date_diff('day', DATE '{ASOF}', CAST(start AS DATE)) || 'd' END AS window_state,
           round(0.4 * n / n_events + 0.3 * least(n_events / 10, 1.0) + 0.3 * least(n_years / 3, 1.0), 2) AS confidence, event_days
    FROM w WHERE n_events >= 2 AND round(100.0 * n / n_events, 1) >= 50
""")
def recurrence_forecast(spark, sf_dir):
    events = table(spark, sf_dir, "orders").filter("o_totalprice >= 300000").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    found = forecast.recurrence(events, ["o_custkey"], "day", "o_totalprice", ASOF)
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("last_event", "window_start", "window_end")})


def _ship_lags(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.datediff("l_shipdate", "o_orderdate").alias("lag")).filter("lag > 0")


_LAGS = "SELECT date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS lag FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) > 0"


@query(f"""
    SELECT count(*) AS n, CAST(quantile_disc(lag, 0.25) AS INTEGER) AS p25, CAST(quantile_disc(lag, 0.5) AS INTEGER) AS median, CAST(quantile_disc(lag, 0.75) AS INTEGER) AS p75,
           CAST(min(lag) AS INTEGER) AS least, CAST(max(lag) AS INTEGER) AS most FROM ({_LAGS})
""")
def lag_quantiles(spark, sf_dir):
    found = cases.lag_quantiles(_ship_lags(spark, sf_dir), "lag")
    return found.withColumns({c: F.col(c).cast("int") for c in ("p25", "median", "p75")})


@query(f"SELECT CAST(ceil(lag / 180) AS INTEGER) AS band, count(*) AS n FROM ({_LAGS}) GROUP BY 1")
def lag_bands(spark, sf_dir):
    return cases.lag_bands(_ship_lags(spark, sf_dir), "lag", 180)


@query("""
    WITH e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) // 86400000000 AS day FROM events),
    c AS (SELECT event_id AS cause, user_id, value, day FROM e WHERE event_type = 'error'), f AS (SELECT event_id AS effect, user_id, value, day FROM e WHERE event_type = 'purchase' AND value >= 5)
    SELECT cause, effect, c.user_id, CAST(f.day - c.day AS INTEGER) AS lag, round(f.value / nullif(c.value, 0), 2) AS ratio FROM c JOIN f ON c.user_id = f.user_id
    WHERE f.day - c.day BETWEEN 1 AND 3 AND f.value / nullif(c.value, 0) BETWEEN 0.4 AND 2.0
""")
def interval_match(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.unix_date(F.to_date("ts")))
    causes = events.filter("event_type = 'error'").select(F.col("event_id").alias("cause"), "user_id", F.col("value").alias("size"), F.col("day").alias("at"))
    effects = events.filter("event_type = 'purchase'").select(F.col("event_id").alias("effect"), "user_id", F.col("value").alias("gain"), F.col("day").alias("then"))
    found = cases.interval_match(causes, effects, "user_id", "at", "then", 3, 5.0, (0.4, 2.0), "size", "gain")
    return found.select("cause", "effect", "user_id", F.col("lag").cast("int").alias("lag"), "ratio")


@query("""
    WITH c AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderkey % 400 AS INTEGER) END AS lag, o_orderkey % 2 AS src, o_orderkey % 5 AS tech FROM orders)
    SELECT o_orderkey, strftime(CASE WHEN lag IS NOT NULL THEN d + lag ELSE greatest(DATE '2001-06-01', d + 98) END, '%Y-%m-%d') AS window_start,
           strftime(CASE WHEN lag IS NOT NULL THEN d + lag ELSE d + 426 END, '%Y-%m-%d') AS window_end,
           CASE WHEN lag IS NOT NULL THEN 'CONFIRMADO' WHEN DATE '2001-06-01' > d + 98 THEN 'SOBREPLAZO' ELSE 'PENDIENTE' END AS window_state,
           CASE WHEN lag IS NOT NULL THEN CASE WHEN src = 0 THEN 75 ELSE 100 END END AS chance, CASE WHEN tech = 0 THEN 'gen+alm' ELSE 'gen' END AS technology_kind FROM c
""")
def adverse_forecast(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("adverse_day"), F.when(key % 4 < 3, (key % 400).cast("int")).alias("real_lag"),
        F.when(key % 2 == 0, "boe_texto").otherwise("historial_dso").alias("source"), F.when(key % 5 == 0, "PV + Bess").otherwise("PV").alias("technology"),
    )
    found = cases.adverse_forecast(rows, "2001-06-01", 98, 426)
    return found.select("o_orderkey", *(F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("window_start", "window_end")), "window_state", "chance", "technology_kind")


@query("""
    WITH s AS (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1)
    SELECT c_custkey, round(least(35.0, 0.00001 * coalesce(total, 0)) + least(30.0, 2.5 * coalesce(n, 0)) + least(25.0, 0.00005 * coalesce(top, 0)) + least(10.0, 0.002 * c_acctbal), 4) AS score
    FROM customer LEFT JOIN s ON c_custkey = o_custkey
""")
def weighted_capped_score(spark, sf_dir):
    sums = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    joined = table(spark, sf_dir, "customer").join(sums, F.col("c_custkey") == F.col("o_custkey"), "left")
    signals = {"total": (0.00001, 35.0), "n": (2.5, 30.0), "top": (0.00005, 25.0), "c_acctbal": (0.002, 10.0)}
    return joined.select("c_custkey", F.round(radar.capped_score(signals), 4).alias("score"))


@query("""
    WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    SELECT o_custkey, count(*) AS n_largest, round(sum(o_totalprice), 2) AS sum_largest, string_agg(CAST(o_orderkey AS VARCHAR), '|' ORDER BY rn) FILTER (WHERE rn <= 5) AS largest FROM r GROUP BY 1
""")
def nested_top_lists(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    found = radar.top_list(orders, "o_custkey", 5, "o_totalprice", "o_orderkey", ["o_orderkey"], "largest")
    return found.select("o_custkey", "n_largest", F.round("sum_largest", 2).alias("sum_largest"), F.array_join(F.transform("largest", lambda x: x["o_orderkey"].cast("string")), "|").alias("largest"))


@query("""
    SELECT c_custkey AS k, concat_ws('|', CASE WHEN k % 3 = 0 AND k % 50 > 0 THEN 'decaimiento_tramite:media' END, CASE WHEN k % 4 >= 1 THEN 'estancado:media' END,
           CASE WHEN k % 4 >= 2 THEN 'estancado:media' END, CASE WHEN k % 2 = 1 THEN CASE WHEN k % 5 = 0 THEN 'hito:alta' ELSE 'hito:media' END END,
           CASE WHEN k % 7 = 0 THEN CASE WHEN k % 6 >= 3 THEN 'anomalia:alta' ELSE 'anomalia:media' END END) AS told
    FROM customer
""")
def score_predictions(spark, sf_dir):
    k = F.col("k")
    stalled = F.transform(F.slice(F.array(*map(F.lit, range(3))), F.lit(1), (k % 4).cast("int")), lambda i: F.struct(F.lit("p").alias("p"), i.cast("double").alias("mw"), F.lit(30).alias("months")))
    one = F.array(F.struct(F.lit("p").alias("p"), F.lit(1.0).alias("mw"), F.lit("AAP").alias("milestone"), F.when(k % 5 == 0, "ocupada").otherwise("libre").alias("confidence")))
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k")
    ).select(
        "k", F.when(k % 3 == 0, (k % 50).cast("double")).otherwise(0.0).alias("queue_drop"), stalled.alias("stalled"), F.when(k % 2 == 1, one).alias("milestones"),
        F.when(k % 7 == 0, F.struct((k % 100).cast("double").alias("mw"), F.lit("up").alias("dir"), (k % 6).cast("double").alias("z"))).alias("anomaly"),
    )
    return radar.predictions(rows).select("k", F.array_join(F.transform("predictions", lambda p: F.concat(p["mechanism"], F.lit(":"), p["chance"])), "|").alias("told"))


# ---- summaries


@query("""
    SELECT c_mktsegment, count(*) AS total, count_if(c_acctbal > 0) AS positive, count_if(c_acctbal < 0) AS negative, count_if(c_nationkey < 5) AS near,
           CAST(floor(100 * count_if(c_acctbal > 0) / count(*)) AS BIGINT) AS positive_pct, CAST(floor(100 * count_if(c_acctbal < 0) / count(*)) AS BIGINT) AS negative_pct,
           CAST(floor(100 * count_if(c_nationkey < 5) / count(*)) AS BIGINT) AS near_pct FROM customer GROUP BY 1
""")
def conditional_stats(spark, sf_dir):
    counts = {"positive": F.col("c_acctbal") > 0, "negative": F.col("c_acctbal") < 0, "near": F.col("c_nationkey") < 5}
    return stats.conditional_counts(table(spark, sf_dir, "customer"), counts, ["c_mktsegment"])


@query("""
    WITH g AS (SELECT l_orderkey, bool_or(nullif(l_tax, 0) IS NULL) AS free, bool_or(CASE WHEN l_returnflag = 'R' THEN 1 END IS NOT NULL) AS returned FROM lineitem GROUP BY 1)
    SELECT count(*) AS groups, count_if(free) AS with_free, count_if(returned) AS with_returned FROM g
""")
def existential_count(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_tax") == 0, 1).alias("free"), F.when(F.col("l_returnflag") == "R", 1).alias("returned"))
    return stats.groups_with_any(rows, "l_orderkey", ["free", "returned"])


@query("SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS first, strftime(max(o_orderdate), '%Y-%m-%d') AS last, count(DISTINCT CAST(o_orderdate AS DATE)) AS n_distinct FROM orders")
def distinct_range(spark, sf_dir):
    return stats.extent(table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")), "day")


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def group_count_by_owner(spark, sf_dir):
    return stats.group_counts(table(spark, sf_dir, "customer"), "c_mktsegment")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def largest_positive(spark, sf_dir):
    return stats.largest(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 10, "c_custkey")


# ---- geography and nested text


def _coordinate_sql() -> str:
    """The series with its constants written out, level by level."""
    r = geo.SCALE * geo._RADIUS
    xi1 = "xi" + "".join(f" - ({b!r}) * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, b in enumerate(geo._BETA, 1))
    eta1 = "eta" + "".join(f" - ({b!r}) * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, b in enumerate(geo._BETA, 1))
    lat = "chi" + "".join(f" + ({d!r}) * sin({2 * j} * chi)" for j, d in enumerate(geo._DELTA, 1))
    return f"""
        WITH a AS (SELECT c_custkey, (4400000.0 + c_acctbal * 10) / {r!r} AS xi, (400000.0 + c_custkey * 100 - 500000.0) / {r!r} AS eta,
                          CASE WHEN c_nationkey % 2 = 0 THEN -15.0 ELSE -3.0 END AS meridian FROM customer),
        b AS (SELECT *, {xi1} AS xi1, {eta1} AS eta1 FROM a), c AS (SELECT *, asin(sin(xi1) / cosh(eta1)) AS chi FROM b),
        d AS (SELECT c_custkey, degrees({lat}) AS lat, meridian + degrees(atan2(sinh(eta1), cos(xi1))) AS lon FROM c)
        SELECT c_custkey, CASE WHEN lon BETWEEN -18 AND 5 AND lat BETWEEN 27 AND 44 THEN round(lat, 6) END AS lat,
               CASE WHEN lon BETWEEN -18 AND 5 AND lat BETWEEN 27 AND 44 THEN round(lon, 6) END AS lon FROM d
    """


@query(_coordinate_sql())
def coord_inverse(spark, sf_dir):
    province = F.when(F.col("c_nationkey") % 2 == 0, "Palmas, Las").otherwise("Teruel")
    lat, lon = geo.lat_lon(400000.0 + F.col("c_custkey") * 100, 4400000.0 + F.col("c_acctbal") * 10, province)
    return table(spark, sf_dir, "customer").select("c_custkey", lat.alias("lat"), lon.alias("lon"))


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_extract(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k int")["k"].alias("k"))
    return events.groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"))


# ---- the grid's own plans, on bronze cells made of the driver's tables
from . import grid_queries, lookup_queries, outlook_queries, source_queries, stream_queries  # noqa: E402, F401
