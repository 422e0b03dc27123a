"""Queries of what is told about a substation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cases, fit, outlook, radar
from .catalog import query, table


@query("""
    WITH c AS (SELECT c_custkey AS k, c_mktsegment AS promoter FROM customer),
    p AS (
        SELECT k, 0 AS pos, 'alta' AS chance, CASE WHEN k % 2 = 1 THEN 'gen' ELSE 'dem' END AS direction, k % 80 + 0.125 * (k % 4) AS mw, 'caducidad_solicitud' AS mechanism,
               CASE k % 4 WHEN 0 THEN 'Denegación' WHEN 1 THEN 'Desistimiento' WHEN 2 THEN 'Archivo' ELSE 'otro' END || '. ' || printf('%.2f', round_even(k % 80 + 0.125 * (k % 4), 2)) || ' MW liberados en cola — ' || promoter AS text,
               CASE WHEN (k % 200) // 30 <= 3 THEN 'inmediata' ELSE 'próximos 6 meses' END AS "window"
        FROM c WHERE k % 9 = 0
        UNION ALL
        SELECT k, 1, 'media', 'gen', k % 50 + 0.5, 'decaimiento_tramite', 'Decaimiento — Liberación consumada. ' || CAST(CAST(round_even(k % 50 + 0.5, 0) AS BIGINT) AS VARCHAR) || ' MW en cola liberados', 'inmediata'
        FROM c WHERE k % 3 = 0
        UNION ALL
        SELECT k, 2 + i, 'media', 'gen', 10 * i + k % 7 + 0.5, 'estancado', 'Caducidad de solicitud. ' || CAST(CAST(round_even(10 * i + k % 7 + 0.5, 0) AS BIGINT) AS VARCHAR) || ' MW en cola sin actividad ' || (20 + i) || ' meses', 'próximos 18 meses'
        FROM c, range(0, 2) r(i) WHERE k % 4 > i
        UNION ALL
        SELECT k, 4 + i, CASE WHEN (k + i) % 5 = 0 THEN 'alta' ELSE 'media' END, 'gen', 15 * i + k % 11, 'hito_rdl', 'Hito AAP vence 2026-0' || (1 + i) || '. ' || (15 * i + k % 11) || ' MW sin cumplimiento registrado', 'próximos 6 meses'
        FROM c, range(0, 2) r(i) WHERE k % 2 = 1
        UNION ALL
        SELECT k, 6, CASE WHEN k % 6 + 0.5 >= 3 THEN 'alta' ELSE 'media' END, 'dem', k % 100, 'anomalia_historica',
               CASE WHEN k % 2 = 0 THEN 'Liberación' ELSE 'Caída' END || ' brusca de capacidad — ' || (k % 100) || ' MW en 2026-08 (z=' || (k % 6) || '.5σ vs histórico). 0.0 → ' || (k % 100) || '.0 MW', 'inmediata'
        FROM c WHERE k % 7 = 0)
    SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY chance <> 'alta', mw DESC, pos) AS INTEGER) AS place, chance, direction, CAST(mw AS DOUBLE) AS mw, mechanism, text, "window" FROM p
""")
def radar_outlook(spark, sf_dir):
    """The ranked sentences of each customer, taken for a substation."""
    k = F.col("k")
    few = lambda n, f: F.transform(F.slice(F.array(*map(F.lit, range(3))), F.lit(1), n.cast("int")), f)
    state = F.when(k % 4 == 0, "denegado").when(k % 4 == 1, "desistido").when(k % 4 == 2, "archivado").otherwise("otro")
    failed = F.struct(
        F.lit("p").alias("p"), (k % 80 + F.lit(0.125).cast("double") * (k % 4)).alias("mw"), (k % 200).alias("days"), F.when(k % 2 == 1, "gen").otherwise("dem").alias("affects"), state.alias("state"),
        F.col("c_mktsegment").alias("promoter"),
    )
    half = F.lit(0.5).cast("double")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment").select(
        "k", F.when(k % 9 == 0, F.array(failed)).alias("failed"), F.when(k % 3 == 0, k % 50 + half).otherwise(F.lit(0.0)).alias("queue_drop"),
        few(k % 4, lambda i: F.struct(F.lit("p").alias("p"), (i * 10 + k % 7 + half).alias("mw"), (i + 20).alias("months"))).alias("stalled"),
        F.when(k % 2 == 1, few(F.lit(2), lambda i: F.struct(
            F.lit("p").alias("p"), (i * 15 + k % 11).cast("double").alias("mw"), F.lit("AAP").alias("milestone"), F.concat(F.lit("2026-0"), i + 1, F.lit("-15")).alias("due"),
            F.when((k + i) % 5 == 0, "ocupada").otherwise("baja").alias("confidence"),
        ))).alias("milestones"),
        F.when(k % 7 == 0, F.struct(
            (k % 100).cast("double").alias("mw"), F.when(k % 2 == 0, "sube").otherwise("baja").alias("dir"), F.lit("dem").alias("lbl"), (k % 6 + half).alias("z"), F.lit("2026-08").alias("fecha"),
            F.lit(0.0).cast("double").alias("prev"), (k % 100).cast("double").alias("curr"),
        )).alias("anomaly"),
    )
    told = outlook.outlook(rows).select("k", F.posexplode("predictions").alias("at", "p"))
    return told.select("k", (F.col("at") + 1).alias("place"), "p.*")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN 0.85 ELSE 0.95 END::DOUBLE AS confidence,
           CASE WHEN o_orderkey % 4 = 3 THEN 'Estimado: 98–250d tras AAP denegado (base historial DSO: 135 casos  ·  total confirmados: 135).'
                WHEN o_orderkey % 2 = 0 THEN 'Afloración confirmada por resolución BOE: ' || (o_orderkey % 90) || '.5 MW liberados en ' || (o_orderkey % 400) || 'd tras AAP denegado.'
                ELSE 'Afloración confirmada (historial DSO): +' || (o_orderkey % 90) || '.5 MW en ' || (o_orderkey % 400) || 'd tras AAP denegado.' END AS description
    FROM orders
""")
def adverse_descriptions(spark, sf_dir):
    """The sentence of each forecast, orders taken for adverse decisions."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("adverse_day"), F.when(k % 4 < 3, (k % 400).cast("int")).alias("real_lag"), F.when(k % 2 == 0, "boe_texto").otherwise("historial_dso").alias("source"),
        F.lit("PV").alias("technology"), F.lit("AAP").alias("kind"), F.lit("denegado").alias("state"), (k % 90 + F.lit(0.5).cast("double")).alias("freed_mw"),
    )
    return outlook.described(cases.adverse_forecast(rows, "2001-06-01", 98, 426), 98, 250, 135).select("o_orderkey", "confidence", "description")


@query("""
    WITH o AS (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1)
    SELECT c_custkey, round(least(35, 0.00004 * coalesce(total, 0)) + least(30, 1.5 * coalesce(n, 0)) + least(25, 0.00006 * coalesce(top, 0)) + least(10, 0.002 * c_acctbal) + 0.00000003, 4) AS score, round(least(35, 0.00004 * coalesce(total, 0)) + least(30, 1.5 * coalesce(n, 0)) + least(25, 0.00006 * coalesce(top, 0)) + least(10, 0.002 * c_acctbal) + 0.00000003, 4) AS fitted
    FROM customer LEFT JOIN o ON o_custkey = c_custkey
""")
def refitted_scores(spark, sf_dir):
    """Scores of four capped signals, and what weights fitted to these scores make of the same signals."""
    sums = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    rows = table(spark, sf_dir, "customer").join(sums, F.col("c_custkey") == F.col("o_custkey"), "left")
    caps = {"total": 35.0, "n": 30.0, "top": 25.0, "c_acctbal": 10.0}
    weights = {"total": 0.00004, "n": 1.5, "top": 0.00006, "c_acctbal": 0.002}
    known = rows.withColumn("score", radar.capped_score({c: (weights[c], caps[c]) for c in caps}))
    last = {"total": 0.00003, "n": 2.0, "top": 0.00008, "c_acctbal": 0.001}  # weights to start from
    apart = lambda c: F.round(F.col(c) + 0.00000003, 4).alias(c)  # noqa: E731  sums of up to seven places may lie halfway between two roundings
    return fit.refitted(known, "score", caps, start=last).select("c_custkey", apart("score"), apart("fitted"))
