"""Queries of the grid's plans: bronze sheets are made of the driver's tables and read as workbooks are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric, text
from ..operators import radar, series
from . import grid
from .catalog import query, table


def _row(n: int, **cells: Column) -> Column:
    """A sheet row of ``n`` cells, given by place as ``c10=...``."""
    return F.array(*(cells[f"c{i}"].cast("string") if f"c{i}" in cells else F.lit(None).cast("string") for i in range(n)))


def _sheet(rows: DataFrame, name: Column | str, idx: int, row: Column, cells: Column) -> DataFrame:
    name = F.lit(name) if isinstance(name, str) else name
    return rows.select(F.lit("w").alias("workbook"), name.alias("sheet"), F.lit(idx).alias("sheet_idx"), row.cast("int").alias("row_idx"), cells.alias("cells"))


def _monitor(spark, sf_dir: str) -> DataFrame:
    """Two current sheets: distribution from customers, where later rows repeat keys, and transmission from suppliers, half of them colliding."""
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    dso = _row(
        36, c1=F.concat(F.when(c % 3 == 0, "i-DE ").when(c % 3 == 1, "Unión Fenosa ").otherwise("local "), F.lower("c_mktsegment")), c3=F.lit(" Teruel "), c4=F.concat(F.lit("M"), F.col("c_nationkey")),
        c5=F.when(c % 2 == 0, F.col("c_name")), c9=F.lit("66"), c10=F.concat(F.lit(" SUB "), c % 997, F.lit(" 66 ")), c11=F.concat((c % 50).cast("string"), F.lit(".5")), c12=F.when(c % 7 == 0, F.lit("N/A")).otherwise((c % 20).cast("string")),
        c15=F.lit("66d"), c16=c % 5, c21=c % 40, c22=F.when(c % 5 == 0, F.lit("")).otherwise((c % 30).cast("string")), c25=F.lit("3"), c26=c % 4, c30=F.when(c % 3 == 0, F.lit("9.25")), c34=F.lit("1"), c35=F.lit("2"),
    )
    key = F.when(s % 2 == 0, F.concat(F.lit("SUB "), s, F.lit(" 66"))).otherwise(F.concat(F.lit("NODE  "), s, F.lit(" (X) 220")))
    ree = _row(
        110, c1=key, c3=F.lit("Aragon"), c4=s % 90, c5=F.when(s % 3 == 0, F.lit("-")).otherwise((s % 40).cast("string")), c7=s % 8, c8=F.lit("2"), c10=s % 6, c33=F.lit("8"), c40=F.when(s % 4 != 0, s % 3), c44=F.lit("50"), c51=F.lit("77"),
        c89=F.when(s % 5 == 0, F.lit("1")), c93=F.when(s % 2 == 0, F.lit("4")), c101=F.lit("2"),
    )
    one = table(spark, sf_dir, "region").limit(1)
    day = _row(2, c1=F.lit("2026-01-15 00:00:00"))
    head = _row(36, c30=F.lit("Capacidad de acceso disponible para MPE RdD"))
    parts = [
        _sheet(one, "DSO Actual", 0, F.lit(3), day), _sheet(one, "REE Actual", 1, F.lit(3), day), _sheet(one, "DSO Actual", 0, F.lit(5), head),
        _sheet(table(spark, sf_dir, "customer"), "DSO Actual", 0, 6 + c, dso), _sheet(one, "REE Actual", 1, F.lit(1), _row(110, c50=F.lit("MPE RdD MGES"), c51=F.lit("MPE  RdD"))),
        _sheet(table(spark, sf_dir, "supplier"), "REE Actual", 1, 9 + s, ree), _sheet(table(spark, sf_dir, "customer").filter("c_custkey % 4 = 0"), "DSO Dic25", 2, 6 + c, dso),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_DSO = """
    SELECT 'SUB ' || CAST(c_custkey % 997 AS VARCHAR) || ' 66' AS key, c_custkey AS c, c_name, c_nationkey, c_mktsegment FROM customer
    QUALIFY row_number() OVER (PARTITION BY c_custkey % 997 ORDER BY c_custkey DESC) = 1
"""
_REE = """
    SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'SUB ' || CAST(s_suppkey AS VARCHAR) || ' 66' ELSE 'NODE  ' || CAST(s_suppkey AS VARCHAR) || ' (X) 220' END AS key, s_suppkey AS s FROM supplier
"""
_SNAPSHOT = f"""
    WITH dso AS ({_DSO}), ree AS ({_REE}),
    a AS (SELECT key, CASE WHEN c % 2 = 0 THEN c_name ELSE 'SUB ' || CAST(c % 997 AS VARCHAR) END AS short_name, 'Teruel' AS province, 'M' || CAST(c_nationkey AS VARCHAR) AS municipality, 66.0::DOUBLE AS kv,
                 (c % 50) + 0.5::DOUBLE AS cap, CASE WHEN c % 7 <> 0 THEN CAST(c % 20 AS DOUBLE) END AS cap_before, NULL::DOUBLE AS cap_taken, 1.0::DOUBLE AS accept, 2.0::DOUBLE AS accept_before,
                 CASE c % 3 WHEN 0 THEN 'iDE' WHEN 1 THEN 'UFD' ELSE 'Local ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) END AS owner, 'Distribución' AS grid,
                 CAST(c % 40 AS DOUBLE) AS demand, CASE WHEN c % 5 <> 0 THEN CAST(c % 40 AS DOUBLE) - CAST(c % 30 AS DOUBLE) END AS demand_change FROM dso),
    b AS (SELECT key || CASE WHEN key IN (SELECT key FROM dso) THEN ' (REE)' ELSE '' END AS key,
                 CASE WHEN s % 2 = 0 THEN 'SUB ' || CAST(s AS VARCHAR) ELSE 'NODE ' || CAST(s AS VARCHAR) || ' (X)' END AS short_name, '' AS province, 'Aragon' AS municipality, CASE WHEN s % 2 = 0 THEN 66.0 ELSE 220.0 END::DOUBLE AS kv,
                 CAST(s % 90 AS DOUBLE) AS cap, CASE WHEN s % 3 <> 0 THEN CAST(s % 40 AS DOUBLE) END AS cap_before, NULL::DOUBLE AS cap_taken, CAST(s % 6 AS DOUBLE) AS accept, CAST(s % 6 AS DOUBLE) AS accept_before,
                 'REE' AS owner, 'Transporte' AS grid, CAST(s % 8 AS DOUBLE) AS demand, s % 8 - 2.0::DOUBLE AS demand_change FROM ree)
    SELECT *, round(cap - cap_before, 4) AS change FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
"""


@query(f"SELECT key, key AS display_name, short_name, province, municipality, kv, cap, cap_before, cap_taken, accept, accept_before, owner, grid, change, demand, demand_change FROM ({_SNAPSHOT})")
def grid_snapshot(spark, sf_dir):
    return grid.snapshot(_monitor(spark, sf_dir)).drop("lat", "lon")


@query(f"""
    SELECT to_json(key) || ':' || '[' || concat_ws(',', to_json(key), to_json(short_name), to_json(province), to_json(municipality), to_json(kv), to_json(cap), coalesce(to_json(cap_before), 'null'), 'null', to_json(accept), to_json(accept_before),
           to_json(owner), to_json(grid), coalesce(to_json(change), 'null'), 'null', 'null', to_json(demand), coalesce(to_json(demand_change), 'null')) || ']' AS value FROM ({_SNAPSHOT})
""")
def grid_snapshot_lists(spark, sf_dir):
    return grid.snapshot_entries(grid.snapshot(_monitor(spark, sf_dir)))


_HISTORY = f"""
    WITH now AS ({_DSO}), old AS ({_DSO.replace("FROM customer", "FROM customer WHERE c_custkey % 4 = 0")}), ree AS ({_REE}),
    dso AS (SELECT key, '2026-01' AS month, c FROM now UNION ALL SELECT key, '2025-12', c FROM old),
    d AS (SELECT key, month, CAST(c % 40 AS DOUBLE) AS cap_gen, 3.0::DOUBLE AS cap_gen_ocup, CAST(c % 4 AS DOUBLE) AS cap_gen_tram, c % 50 + 0.5::DOUBLE AS cap_dem, NULL::DOUBLE AS cap_dem_ocup, CAST(c % 5 AS DOUBLE) AS cap_dem_tram,
                 CASE WHEN month = '2026-01' AND c % 3 = 0 THEN 9.25::DOUBLE END AS cap_gen_RdD, CAST(c % 40 AS DOUBLE) AS cap_gen_disp, CAST(c % 40 AS DOUBLE) AS cap_gen_neta, c % 50 + 0.5::DOUBLE AS cap_dem_disp, c % 50 + 0.5::DOUBLE AS cap_dem_neta FROM dso),
    d2 AS (SELECT *, cap_gen_RdD - cap_gen_tram AS acept FROM d),
    r AS (SELECT key, CAST(s % 90 AS DOUBLE) AS cap_gen, 8.0::DOUBLE AS cap_gen_ocup, CASE WHEN s % 4 <> 0 THEN CAST(s % 3 AS DOUBLE) END AS cap_gen_tram, CAST(s % 8 AS DOUBLE) AS cap_dem,
                 CASE WHEN s % 5 = 0 OR s % 2 = 0 THEN CASE WHEN s % 5 = 0 THEN 1.0 ELSE 0.0 END + CASE WHEN s % 2 = 0 THEN 4.0 ELSE 0.0 END END::DOUBLE AS cap_dem_ocup, 2.0::DOUBLE AS cap_dem_tram, NULL::DOUBLE AS cap_gen_RdD,
                 50.0::DOUBLE AS cap_gen_disp, 50.0 - coalesce(CASE WHEN s % 4 <> 0 THEN s % 3 END, 0)::DOUBLE AS cap_gen_neta, NULL::DOUBLE AS cap_dem_disp, CAST(s % 8 AS DOUBLE) AS cap_dem_neta, CAST(s % 6 AS DOUBLE) AS acept FROM ree),
    r2 AS (SELECT *, 77.0::DOUBLE AS rdd FROM r)
    SELECT coalesce(d2.key, r2.key) AS key, coalesce(d2.month, '2026-01') AS month, coalesce(d2.cap_gen, r2.cap_gen) AS cap_gen, coalesce(d2.cap_gen_ocup, r2.cap_gen_ocup) AS cap_gen_ocup, coalesce(d2.cap_gen_tram, r2.cap_gen_tram) AS cap_gen_tram,
           coalesce(d2.cap_dem, r2.cap_dem) AS cap_dem, coalesce(d2.cap_dem_ocup, r2.cap_dem_ocup) AS cap_dem_ocup, coalesce(d2.cap_dem_tram, r2.cap_dem_tram) AS cap_dem_tram, coalesce(d2.acept, r2.acept) AS acept,
           coalesce(d2.cap_gen_disp, r2.cap_gen_disp) AS cap_gen_disp, coalesce(d2.cap_gen_neta, r2.cap_gen_neta) AS cap_gen_neta, coalesce(d2.cap_dem_disp, r2.cap_dem_disp) AS cap_dem_disp, coalesce(d2.cap_dem_neta, r2.cap_dem_neta) AS cap_dem_neta,
           CASE WHEN d2.key IS NULL THEN rdd ELSE d2.cap_gen_RdD END AS "cap_gen_RdD"
    FROM d2 FULL JOIN r2 ON d2.key = r2.key AND d2.month = '2026-01'
"""


@query(_HISTORY)
def grid_monitor_history(spark, sf_dir):
    return grid.history(_monitor(spark, sf_dir)).drop("source")


@query(f"""
    WITH h AS ({_HISTORY}), v AS (SELECT key, month, '["' || month || '",' || concat_ws(',', {", ".join(f"coalesce(CAST(to_json({m}) AS VARCHAR), 'null')" for m in grid.MEASURES)}) || ']' AS record FROM h)
    SELECT '"' || key || '":[' || string_agg(record, ',' ORDER BY month) || ']' AS value FROM v GROUP BY key
""")
def grid_history_lists(spark, sf_dir):
    return grid.history_entries(grid.history(_monitor(spark, sf_dir)))


@query("""
    SELECT printf('%d-%02d-%02d', 2023 + p_partkey % 3, 1 + p_partkey % 12, 5) AS fecha, 'REE' AS distribuidora, '' AS provincia, '' AS municipio, 'NODE ' || p_partkey AS subestacion,
           CASE WHEN p_partkey % 2 = 0 THEN 220 END::INTEGER AS tension_kv, p_partkey % 30 + 0.5::DOUBLE AS disponible_bruta, p_partkey % 30 + 0.5 - CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_partkey % 4 END::DOUBLE AS disponible_neta,
           CASE WHEN p_partkey % 7 <> 0 THEN 4.0::DOUBLE END AS cap_gen_ocup, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 4 <> 0 THEN CAST(p_partkey % 4 AS DOUBLE) END AS cap_gen_tram, 'Aragón' AS ccaa
    FROM part WHERE p_partkey % 11 NOT IN (0, 1) AND printf('%d-%02d-%02d', 2023 + p_partkey % 3, 1 + p_partkey % 12, 5) >= '2023-12-01'
""")
def grid_tidy(spark, sf_dir):
    p = F.col("p_partkey")
    name = F.concat(F.lit("05 "), F.element_at(F.array(*map(F.lit, text.MONTHS)), (1 + p % 12).cast("int")), F.lit(" "), (2023 + p % 3).cast("string"))
    part = table(spark, sf_dir, "part")
    row = _row(
        5, c0=F.when(p % 11 == 0, F.lit("TOTAL")).otherwise(F.concat(F.lit(" NODE "), p.cast("string"), F.when(p % 2 == 0, " 220").otherwise(""))), c1=F.lit("Aragón "), c2=F.when(p % 11 == 1, F.lit("-")).otherwise(F.concat((p % 30).cast("string"), F.lit(",5"))),
        c3=F.when(p % 3 == 0, F.lit("N/D")).otherwise((p % 4).cast("string")), c4=F.when(p % 7 == 0, F.lit("NA")).otherwise("4"),
    )
    head = F.array(*map(F.lit, ("Nombre y tensión", "Comunidad Autónoma", "disponible para MPE RdT", "solicitada MPE", "otorgada MPE")))
    sheets = part.select(name.alias("sheet")).distinct()
    bronze = _sheet(part, name, 0, 5 + p, row).unionByName(_sheet(sheets, F.col("sheet"), 0, F.lit(4), head))
    found = grid.tidy(bronze)
    # a name of one to four closing digits is a tension where no other follows
    return found.withColumns({"subestacion": F.when(F.col("tension_kv") == 220, F.col("subestacion")).otherwise(F.concat(F.col("subestacion"), F.coalesce(F.concat(F.lit(" "), F.col("tension_kv").cast("string")), F.lit("")))), "tension_kv": F.when(F.col("tension_kv") == 220, 220)})


@query("""
    WITH d AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, round(sum(value), 2) AS total FROM events GROUP BY 1, 2),
    c AS (SELECT *, lag(total) OVER (PARTITION BY user_id ORDER BY day) AS prev FROM d), e AS (SELECT *, round(total - prev, 4) AS change FROM c),
    z AS (SELECT *, avg(change) OVER w AS mean, stddev_samp(change) OVER w AS spread, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS rn FROM e
          WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT user_id, abs(change) AS mw, CASE WHEN change > 0 THEN 'sube' ELSE 'baja' END AS dir, 'gen' AS lbl, round(abs((change - mean) / spread), 1) AS z, day AS fecha, prev, total AS curr
    FROM z WHERE rn = 1 AND spread > 0 AND abs((change - mean) / spread) >= 0.5 AND abs(change) >= 10
""")
def last_anomaly(spark, sf_dir):
    days = table(spark, sf_dir, "events").groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.round(F.sum("value"), 2).alias("total"))
    return series.last_anomaly(days, ["user_id"], "day", "total", "gen", least_z=0.5, least_change=10.0).select("user_id", "anomaly.*")


@query("""
    WITH m AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2),
    c AS (SELECT *, lag(total) OVER (PARTITION BY o_custkey ORDER BY month) AS prev FROM m), e AS (SELECT *, round(total - prev, 4) AS change FROM c),
    z AS (SELECT *, avg(change) OVER w AS mean, stddev_samp(change) OVER w AS spread, row_number() OVER (PARTITION BY o_custkey ORDER BY month DESC) AS rn FROM e
          WINDOW w AS (PARTITION BY o_custkey ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT o_custkey, abs(change) AS mw, CASE WHEN change > 0 THEN 'sube' ELSE 'baja' END AS dir, 'dem' AS lbl, round(abs((change - mean) / spread), 1) AS z, month AS fecha, prev, total AS curr
    FROM z WHERE rn = 1 AND spread > 0 AND abs((change - mean) / spread) >= 1.5 AND abs(change) >= 30
""")
def last_anomaly_monthly(spark, sf_dir):
    """As :func:`last_anomaly`, at the limits of a z-score of 1.5 and a change of 30, on monthly series."""
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    months = table(spark, sf_dir, "orders").groupBy("o_custkey", month).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return series.last_anomaly(months, ["o_custkey"], "month", "total", "dem").select("o_custkey", "anomaly.*")


@query("SELECT c_custkey, CAST(least(50, floor(c_acctbal / 100)) AS BIGINT) AS score FROM customer ORDER BY score DESC, c_custkey LIMIT 200")
def radar_ranked(spark, sf_dir):
    score = F.least(F.lit(50), F.floor(F.col("c_acctbal").cast("double") / 100)).cast("long")
    return radar.ranked(table(spark, sf_dir, "customer").select("c_custkey", score.alias("score")), "score", "c_custkey", 200)


@query("SELECT o_orderkey, CAST(o_orderkey % 97 AS INTEGER) AS confidence, row_number() OVER (ORDER BY o_orderkey % 97 DESC, o_orderkey) AS rank FROM orders")
def forecast_ranked(spark, sf_dir):
    return radar.numbered(table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 97).cast("int").alias("confidence")), "confidence", "o_orderkey")


@query("""
    SELECT l_orderkey, l_linenumber, nullif(l_tax, 0) AS tax, CAST(floor(100 * l_linenumber / nullif(l_linenumber % 4, 0)) AS BIGINT) AS share FROM lineitem
""")
def zero_and_percent(spark, sf_dir):
    n = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", numeric.zero_as_null(F.col("l_tax")).alias("tax"), numeric.percent_floor(n, n % 4).alias("share"))
