"""Ranked sentences against the ones expected for hand-made rows."""

from pyspark.sql import functions as F

from voltaweave.operators import outlook

SCHEMA = """
    key string, failed array<struct<p: string, mw: double, days: int, affects: string, state: string, promoter: string>>, queue_drop double, stalled array<struct<p: string, mw: double, months: int>>,
    milestones array<struct<p: string, mw: double, milestone: string, due: string, confidence: string>>, anomaly struct<mw: double, dir: string, lbl: string, z: double, fecha: string, prev: double, curr: double>
"""


def test_outlook(spark):
    rows = [
        ("A", [("p", 63.8, 74, "gen", "denegado", "Sol, SL"), ("q", 0.0, 153, "gen", "archivado", "Mar, SL")], 0.0, [("x", 346.5, 35), ("y", 347.5, 29), ("z", 900.0, 1)], [("m", 294.7, "Explotación", "2026-12-03", "baja")], None),
        ("B", None, 437.0, None, [("m", 5.0, "AAP", "2027-01-01", "ocupada"), ("n", 30.0, "AAC", "2026-10-01", "baja")], (30.0, "baja", "gen", 3.9, "2026-08", -2.0, -32.0)),
        ("C", [], None, [], [], (1166.0, "sube", "dem", 2.6, "2026-08-01", 0.0, 1166.0)),
        ("D", None, None, None, None, None),
    ]
    got = {r.key: r for r in outlook.outlook(spark.createDataFrame(rows, SCHEMA)).collect()}
    told = {k: [(p.chance, p.direction, p.mw, p.mechanism, p.text, p.window) for p in r.predictions] for k, r in got.items()}
    assert told == {
        "A": [
            ("alta", "gen", 63.8, "caducidad_solicitud", "Denegación. 63.80 MW liberados en cola — Sol, SL", "inmediata"),
            ("alta", "gen", 0.0, "caducidad_solicitud", "Archivo. 0.00 MW liberados en cola — Mar, SL", "próximos 6 meses"),
            ("media", "gen", 347.5, "estancado", "Caducidad de solicitud. 348 MW en cola sin actividad 29 meses", "próximos 18 meses"),
            ("media", "gen", 346.5, "estancado", "Caducidad de solicitud. 346 MW en cola sin actividad 35 meses", "próximos 18 meses"),
            ("media", "gen", 294.7, "hito_rdl", "Hito Explotación vence 2026-12. 295 MW sin cumplimiento registrado", "próximos 6 meses"),
        ],
        "B": [
            ("alta", "gen", 30.0, "anomalia_historica", "Caída brusca de capacidad — 30 MW en 2026-08 (z=3.9σ vs histórico). -2.0 → -32.0 MW", "inmediata"),
            ("alta", "gen", 5.0, "hito_rdl", "Hito AAP vence 2027-01. 5 MW sin cumplimiento registrado", "próximos 6 meses"),
            ("media", "gen", 437.0, "decaimiento_tramite", "Decaimiento — Liberación consumada. 437 MW en cola liberados", "inmediata"),
            ("media", "gen", 30.0, "hito_rdl", "Hito AAC vence 2026-10. 30 MW sin cumplimiento registrado", "próximos 6 meses"),
        ],
        "C": [("media", "dem", 1166.0, "anomalia_historica", "Liberación brusca de capacidad — 1166 MW en 2026-08 (z=2.6σ vs histórico). 0.0 → 1166.0 MW", "inmediata")],
        "D": [],
    }
    assert [f.months for f in got["A"].failed] == [2, 5]


def test_descriptions(spark):
    df = spark.createDataFrame([(0, "boe_texto", 56.5), (426, "historial_dso", 7.6), (None, None, None)], "real_lag int, source string, freed_mw double")
    got = outlook.described(df.withColumns({"kind": F.lit("AAP"), "state": F.lit("denegado")}), 98, 250, 135).collect()
    assert [(r.confidence, r.description) for r in got] == [
        (0.95, "Afloración confirmada por resolución BOE: 56.5 MW liberados en 0d tras AAP denegado."),
        (0.95, "Afloración confirmada (historial DSO): +7.6 MW en 426d tras AAP denegado."),
        (0.85, "Estimado: 98–250d tras AAP denegado (base historial DSO: 135 casos  ·  total confirmados: 135)."),
    ]
