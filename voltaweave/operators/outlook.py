"""What is likely to free capacity at a substation, as ranked sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The noun of each state that ends a project.
ENDINGS = {"denegado": "Denegación", "desistido": "Desistimiento", "archivado": "Archivo"}
#: When an effect is expected.
NOW, HALF_YEAR, LONG = "inmediata", "próximos 6 meses", "próximos 18 meses"
#: Months up to which a failed project counts as just now: inferred from three published cases of 2, 5 and 5 months.
JUST = 3


def _whole(mw: Column) -> Column:
    """Rounded to a whole number, halves to the even one."""
    return F.bround(mw, 0).cast("long").cast("string")


def _told(chance: Column | str, direction: Column | str, mw: Column, mechanism: str, window: Column | str, *text: Column | str) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(
        lit(chance).alias("chance"), lit(direction).alias("direction"), mw.cast("double").alias("mw"), F.lit(mechanism).alias("mechanism"),
        F.concat(*map(lit, text)).alias("text"), lit(window).alias("window"),
    )


def failed_with_months(failed: Column) -> Column:
    """Failed projects with ``months``, the whole months of thirty days since they failed."""
    return F.transform(failed, lambda x: x.withField("months", F.floor(x["days"] / 30).cast("int")))


def outlook(df: DataFrame) -> DataFrame:
    """Add ``predictions``: structs of chance, direction, mw, mechanism, text and window, the surest first, then the largest.

    ``df`` has ``failed`` (p, mw, days, affects, state, promoter), ``queue_drop``, ``stalled`` (p, mw,
    months), ``milestones`` (p, mw, milestone, due, confidence) and ``anomaly`` (mw, dir, lbl, z, fecha, prev,
    curr); null arrays are empty.  All failed projects count, of the stalled and of the
    milestones the first two.  A failed project is sure, so is a milestone on
    occupied capacity, and an anomaly from a z-score of 3 on.  Ties keep this order.
    ``failed`` gets its months.
    """
    ending = F.create_map(*(F.lit(x) for pair in ENDINGS.items() for x in pair))
    df = df.withColumn("failed", failed_with_months(F.col("failed")))
    failed = F.transform(
        "failed",
        lambda x: _told(
            "alta", x["affects"], x["mw"], "caducidad_solicitud", F.when(x["months"] <= JUST, NOW).otherwise(HALF_YEAR),
            F.coalesce(ending[x["state"]], x["state"]), ". ", F.format_string("%.2f", F.bround(x["mw"], 2)), " MW liberados en cola — ", x["promoter"],
        ),
    )
    drop = F.col("queue_drop").cast("double")
    queue = F.when(drop > 0, F.array(_told("media", "gen", drop, "decaimiento_tramite", NOW, "Decaimiento — Liberación consumada. ", _whole(drop), " MW en cola liberados")))
    stalled = F.transform(
        F.slice("stalled", 1, 2),
        lambda x: _told("media", "gen", x["mw"], "estancado", LONG, "Caducidad de solicitud. ", _whole(x["mw"]), " MW en cola sin actividad ", x["months"].cast("string"), " meses"),
    )
    due = F.transform(
        F.slice("milestones", 1, 2),
        lambda x: _told(
            F.when(x["confidence"] == "ocupada", "alta").otherwise("media"), "gen", x["mw"], "hito_rdl", HALF_YEAR,
            "Hito ", x["milestone"], " vence ", F.substring(x["due"], 1, 7), ". ", _whole(x["mw"]), " MW sin cumplimiento registrado",
        ),
    )
    a = F.col("anomaly")
    number = lambda c: c.cast("double").cast("string")
    odd = F.when(
        a.isNotNull(),
        F.array(_told(
            F.when(a["z"] >= 3, "alta").otherwise("media"), a["lbl"], a["mw"], "anomalia_historica", NOW,
            F.when(a["dir"] == "sube", "Liberación").otherwise("Caída"), " brusca de capacidad — ", _whole(a["mw"]), " MW en ", F.substring(a["fecha"], 1, 7),
            " (z=", number(a["z"]), "σ vs histórico). ", number(a["prev"]), " → ", number(a["curr"]), " MW",
        )),
    )
    every = F.flatten(F.array_compact(F.array(failed, queue, stalled, due, odd)))
    placed = F.transform(every, lambda x, i: F.struct((x["chance"] != "alta").alias("later"), (-x["mw"]).alias("less"), i.alias("i"), x.alias("x")))
    return df.withColumn("predictions", F.transform(F.array_sort(placed), lambda p: p["x"]))


def described(found: DataFrame, p25: int, p75: int, n: int) -> DataFrame:
    """Add confidence and description to forecasts of ``cases.adverse_forecast`` that have kind, state and freed_mw besides.

    Confirmed cases are told with what came free and after how long, others with
    the span of days that ``n`` confirmed cases took.
    """
    lag = F.col("real_lag").cast("int").cast("string")
    after = F.concat(lag, F.lit("d tras "), "kind", F.lit(" "), "state", F.lit("."))
    mw = F.col("freed_mw").cast("double").cast("string")
    text = (
        F.when(F.col("real_lag").isNull(), F.concat(F.lit(f"Estimado: {p25}–{p75}d tras "), "kind", F.lit(" "), "state", F.lit(f" (base historial DSO: {n} casos  ·  total confirmados: {n}).")))
        .when(F.col("source") == "boe_texto", F.concat(F.lit("Afloración confirmada por resolución BOE: "), mw, F.lit(" MW liberados en "), after))
        .otherwise(F.concat(F.lit("Afloración confirmada (historial DSO): +"), mw, F.lit(" MW en "), after))
    )
    return found.withColumns({"confidence": F.when(F.col("real_lag").isNull(), 0.85).otherwise(0.95), "description": text})
