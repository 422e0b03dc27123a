"""Operators on small hand-made rows."""

import io
import math
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from voltaweave.functions import geo, numeric, text
from voltaweave.operators import cases, forecast, headers, keyed, radar, series, stats
from voltaweave.plans import grid
from voltaweave.sources import bronze as sheets
from voltaweave.sources import files, xlsx
from voltaweave.streaming import watch

BRONZE = "workbook string, sheet string, sheet_idx int, row_idx int, cells array<string>"


def column(spark, values, kind, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(f(F.col("v")).alias("x"), "i").orderBy("i").collect()]


MESSY = [None, "", "N/A", "N/D", "-", "NA", "1,5", " 1.5 ", "1d", "1_000", "1.234,5", "abc", "0x10", "-.5", "2.", "1e3", "nan"]


def test_numbers(spark):
    plain = [None, None, None, None, None, None, None, 1.5, None, None, None, None, None, -0.5, 2.0, 1000.0, None]
    assert column(spark, MESSY, "string", numeric.to_float) == plain
    comma = list(plain)
    comma[6] = 1.5
    assert column(spark, MESSY, "string", numeric.to_float_with_comma) == comma
    kept = column(spark, ["nan", "inf", "2"], "string", numeric.to_float_keeping_nan)
    assert math.isnan(kept[0]) and kept[1:] == [math.inf, 2.0]


def test_missing_values(spark):
    df = spark.createDataFrame([(1.0, 0.25), (None, 0.25), (1.0, None), (None, None), (2.0, 0.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    got = [tuple(r) for r in df.select(numeric.delta(a, b), numeric.add_known(a, b), numeric.less_pending(a, b), numeric.zero_as_null(b)).collect()]
    assert got == [(0.75, 1.25, 0.75, 0.25), (None, 0.25, None, 0.25), (None, 1.0, 1.0, None), (None, None, None, None), (2.0, 2.0, 2.0, None)]


def test_names(spark):
    names = ["ALFA 66", "LA SERNA 220 ", "X (Y) 400", "SOLO", "A 5", "B12345", "N\t132", None, ""]
    assert column(spark, names, "string", text.tension_of_end) == [66, 220, 400, None, None, None, 132, None, None]
    assert column(spark, names, "string", text.without_tension) == ["ALFA", "LA SERNA", "X (Y)", "SOLO", "A 5", "B12345", "N", "", ""]
    assert column(spark, names, "string", text.tension_of_last_token) == [66, 220, 400, None, 5, None, 132, None, None]
    assert column(spark, names[:4], "string", text.all_but_last_token) == ["ALFA", "LA SERNA", "X (Y)", "SOLO"]
    assert column(spark, names[:4], "string", text.normal_key) == ["ALFA 66", "LA SERNA 220", "X 400", "SOLO"]
    owners = ["i-DE Redes", "VIESGO-E s.l.u.", "Residencial SL", "barras-e s.l.u.", "", None, "Red Eléctrica de España", "e-distribución"]
    assert column(spark, owners, "string", text.canonical) == ["iDE", "Viesgo", "iDE", "Barras-E S.L.U.", "", None, "REE", "Endesa"]
    assert column(spark, [66.0, 1.7, None, math.nan], "double", text.tension_label) == ["66", "1.7", "", ""]
    assert column(spark, ["Nátiòn Ñ"], "string", text.accents_folded) == ["NATION N"]


def test_sheet_names(spark):
    df = spark.createDataFrame([("DSO Oct25",), ("ree ENERO26",), ("DSO Foo25",), ("Notes",), ("20 junio 2022",), ("Mapa de marzo 2021 (v2)",)], "s string")
    got = [tuple(r) for r in df.select(*sheets.monthly_sheet(F.col("s")), sheets.dated_sheet(F.col("s")), F.struct(*sheets.map_sheet(F.col("s"))).cast("string")).collect()]
    none = (None, None, None)
    assert got == [
        ("DSO", 2025, 10, None, "{null, null}"), ("REE", 2026, 1, None, "{null, null}"), (*none, None, "{null, null}"), (*none, None, "{null, null}"),
        (*none, "2022-06-20", "{2022, 6}"), (*none, None, "{2021, 3}"),
    ]


def forward(lat, lon, meridian):
    """Easting and northing by Redfearn's series: another formula than the one under test."""
    a, f, k0 = 6378137.0, 1 / 298.257222101, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    p, dl = math.radians(lat), math.radians(lon - meridian)
    n, t, c, aa = a / math.sqrt(1 - e2 * math.sin(p) ** 2), math.tan(p) ** 2, ep2 * math.cos(p) ** 2, math.cos(p) * dl
    m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * p - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * p) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * p) - 35 * e2**3 / 3072 * math.sin(6 * p))
    x = k0 * n * (aa + (1 - t + c) * aa**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * aa**5 / 120) + 500000
    y = k0 * (m + n * math.tan(p) * (aa**2 / 2 + (5 - t + 9 * c + 4 * c * c) * aa**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * aa**6 / 720))
    return x, y


def test_coordinates(spark):
    places = [(40.4168, -3.7038, "Madrid"), (43.3, 2.9, "Girona"), (36.1, -6.2, "Cádiz"), (28.1, -15.4, "PALMAS, LAS"), (28.47, -16.25, "Santa Cruz de Tenerife")]
    made = [(*forward(lat, lon, -15 if i > 2 else -3), p, lat, lon) for i, (lat, lon, p) in enumerate(places)]
    df = spark.createDataFrame([*made, (None, 1.0, "x", None, None), (1e9, 1e9, "x", None, None), (500000.0, 0.0, "x", None, None)], "x double, y double, p string, lat0 double, lon0 double")
    lat, lon = geo.lat_lon(F.col("x"), F.col("y"), F.col("p"))
    for r in df.select(lat.alias("lat"), lon.alias("lon"), "lat0", "lon0").collect():
        if r.lat0 is None:
            assert r.lat is None and r.lon is None
        else:
            assert abs(r.lat - r.lat0) < 2e-6 and abs(r.lon - r.lon0) < 2e-6


def test_keyed(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, o int, v string")
    assert sorted(map(tuple, keyed.last_wins(df, ["k"], F.col("o")).collect())) == [("a", 2, None), ("b", 1, "y")]
    assert sorted(map(tuple, keyed.first_wins(df, ["k"], F.col("o")).collect())) == [("a", 1, "x"), ("b", 1, "y")]
    right = spark.createDataFrame([("a", 9, "r"), ("c", 9, "s")], "k string, o int, v string")
    left = keyed.last_wins(df, ["k"], F.col("o")).unionByName(spark.createDataFrame([("a (R)", 0, "gone")], df.schema))
    assert sorted(map(tuple, keyed.rename_collisions(left, right, "k", " (R)").collect())) == [("a", 2, None), ("a (R)", 9, "r"), ("b", 1, "y"), ("c", 9, "s")]


def test_masked_upsert_against_a_loop(spark):
    rng = random.Random(1)
    masks, fields = {0: ["a", "b"], 1: ["b"], 2: ["a", "b", "c"]}, ["a", "b", "c"]
    rows = [(f"k{rng.randint(0, 9)}", rng.randint(0, 2), i, *(rng.choice([None, float(i)]) for _ in fields)) for i in range(120)]
    want = {}
    for k, s, _, *values in sorted(rows, key=lambda r: (r[1], r[2])):
        if k not in want:
            want[k] = dict(zip(fields, values, strict=True))
        else:
            for f, v in zip(fields, values, strict=True):
                if f in masks[s] and want[k][f] is None:
                    want[k][f] = v
    df = spark.createDataFrame(rows, "k string, s int, i int, a double, b double, c double")
    once = keyed.masked_fill_upsert(df, ["k"], fields, masks, "s", F.col("i"))
    assert {r.k: {f: r[f] for f in fields} for r in once.collect()} == want
    again = once.withColumn("i", F.lit(0)).unionByName(once.withColumn("i", F.lit(1)))
    assert sorted(map(tuple, keyed.masked_fill_upsert(again, ["k"], fields, masks, "s", F.col("i")).collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_match_cascade(spark):
    places = spark.createDataFrame([("A 220", 1.0, 1.0), ("B  132", 2.0, 2.0), ("B (x) 132", 3.0, 3.0), ("ALIAS 66", 4.0, 4.0), ("E", 5.0, 5.0)], "name string, lat double, lon double")
    keys = spark.createDataFrame([("A 220",), ("B (old) 132",), ("C (ALIAS) 66",), ("E (REE)",), ("none",)], "key string")
    got = {r.key: r.lat for r in grid.match_places(keys, places).collect()}
    assert got == {"A 220": 1.0, "B (old) 132": 2.0, "C (ALIAS) 66": 4.0, "E (REE)": 5.0, "none": None}


def test_the_first_place_of_a_normal_form_wins(spark):
    places = spark.createDataFrame([("B (y) 132", 1.0, 1.0, 0), ("B (a) 132", 2.0, 2.0, 1)], "name string, lat double, lon double, place_idx long")
    keys = spark.createDataFrame([("B 132",), ("B (a) 132",)], "key string")
    assert {r.key: r.lat for r in grid.match_places(keys, places).collect()} == {"B 132": 1.0, "B (a) 132": 2.0}


def test_fuzzy_links(spark):
    left = spark.createDataFrame([("LA SERNA 66",), ("GAROA",), ("Lousame 220 kV",), ("Nowhere 66",), (None,)], "name string")
    right = spark.createDataFrame([("SERNA 220",), ("SERNA 66",), ("GAROÑA 220",), ("LOUSAME 220",), ("LOUSAMO 66",)], "place string")
    got = {r.name: (r.place, r.distance) for r in keyed.fuzzy_link(left, right, "name", "place").collect()}
    assert got == {"LA SERNA 66": ("SERNA 66", 0), "GAROA": ("GAROÑA 220", 1), "Lousame 220 kV": ("LOUSAME 220", 0), "Nowhere 66": (None, None), None: (None, None)}


def test_published_lists(spark, monitor):
    import json

    shown = [json.loads("{" + r.value + "}") for r in grid.snapshot_entries(grid.snapshot(monitor)).collect()]
    record = next(x["ALFA 66"] for x in shown if "ALFA 66" in x)
    assert len(record) == 17 and record[0] == "ALFA 66" and record[4] == 66.0 and record[8] is None and record[10] == "iDE"
    rows = {k: v for r in grid.history_entries(grid.history(monitor)).collect() for k, v in json.loads("{" + r.value + "}").items()}
    assert [len(x) for x in rows["ALFA 66"]] == [13, 13] and rows["ALFA 66"][0][:2] == ["2025-12", 4.0]


def test_headers(spark):
    def sheet(name, *rows):
        return [("w", name, 0, i, list(r)) for i, r in rows]

    old = sheet("old", (4, ["x", "Nombre y tensión del nudo", "Comunidad Autónoma", "Capacidad disponible para MPE RdT", "Capacidad solicitada", "Otorgada para MPE [MW]"]))
    new = sheet("new", (4, ["NOMBRE Y TENSIÓN", None, "MPE RdT [MW]", "Solicitada MGES", "Solicitada pendiente resolver MPE", "Cap otorgada MPE", "otra otorgada MPE", "MPE RdT [MW]"]))
    bad = sheet("bad", (4, ["Nombre y tensión"]))
    df = spark.createDataFrame(old + new + bad, BRONZE)
    clean = lambda c: F.replace(F.lower(text.stripped(c)), F.lit("\n"), F.lit(" "))
    got = {(r.sheet, r.field): r.pos for r in headers.resolve_columns(df, headers.TIDY_RULES, clean).collect()}
    assert got == {
        ("old", "name"): 1, ("old", "ccaa"): 2, ("old", "disp"): 3, ("old", "sol"): 4, ("old", "otorg"): 5,
        ("new", "name"): 0, ("new", "disp"): 2, ("new", "sol"): 4, ("new", "otorg"): 6, ("bad", "name"): 0,
    }


def test_tidy_sheets(spark):
    head = ["Nombre y tensión", "Comunidad Autónoma", "disponible para MPE RdT", "solicitada MPE", "otorgada MPE"]
    rows = [(4, head), (5, ["ALFA 66", "Aragón ", "10,5", "2", "N/D"]), (6, ["TOTAL", "", "1", "1", "1"]), (7, ["BETA", None, "3", "-", "4"]), (8, ["GAMMA 132", "x", "", "1", "1"]), (9, ["For Formula ROW", "", "1", "1", "1"])]
    df = spark.createDataFrame([("w", s, 0, i, c) for s in ("1 enero 2024", "1 enero 2023", "otra") for i, c in rows], BRONZE)
    got = [tuple(r) for r in grid.tidy(df).orderBy(*grid.tidy_order()).collect()]
    assert got == [("2024-01-01", "REE", "", "", "ALFA", 66, 10.5, 8.5, None, 2.0, "Aragón"), ("2024-01-01", "REE", "", "", "BETA", None, 3.0, 3.0, 4.0, None, "")]
    assert grid.tidy(df, since=None).count() == 4


def wide(n, **cells):
    row = [None] * n
    for i, v in cells.items():
        row[int(i[1:])] = v
    return row


@pytest.fixture(scope="module")
def monitor(spark):
    rdd = "Capacidad de acceso disponible para MPE RdD"
    rows = [
        ("DSO Actual", 0, 3, [None, "2026-01-15 00:00:00"]), ("REE Actual", 1, 3, [None, "2026-01-15 00:00:00"]),
        ("DSO Actual", 0, 5, wide(36, _30=rdd)),
        ("DSO Actual", 0, 6, wide(36, _1="i-DE", _3="Teruel", _4="M", _5="ALFA", _7="700000", _8="4470000", _9="66", _10=" ALFA 66 ", _11="12.5", _12="10", _15="1", _16="2", _21="7", _22="6", _25="3", _26="4", _30="9", _34="N/A", _35="1")),
        ("DSO Actual", 0, 7, wide(36, _1="x", _10="BETA 132", _21="5")), ("DSO Actual", 0, 8, wide(36, _10="  ")), ("DSO Actual", 0, 9, wide(36, _1="viesgo", _10="BETA 132", _21="6")),
        ("REE Actual", 1, 1, wide(110, _50="MPE  RdD MGES", _51="MPE RdD")),
        ("REE Actual", 1, 9, wide(110, _1="ALFA 66", _3="Aragón", _4="100", _5="90", _7="5", _8="7", _10="3", _33="8", _40="2", _44="50", _51="77", _89="1", _101="2")),
        ("REE Actual", 1, 10, wide(110, _1="GAMMA (DELTA) 220", _4="1", _5="2", _44="5")),
        ("DSO Dic25", 2, 6, wide(27, _10="ALFA 66", _21="4")), ("DSO Dic25", 2, 7, wide(20, _10="SHORT 1")),
    ]
    return spark.createDataFrame([("w", *r) for r in rows], BRONZE)


def test_snapshot(spark, monitor):
    places = spark.createDataFrame([("DELTA 220", 40.1, -3.2)], "name string, lat double, lon double")
    got = {r.key: r for r in grid.snapshot(monitor, places).collect()}
    assert set(got) == {"ALFA 66", "ALFA 66 (REE)", "BETA 132", "GAMMA (DELTA) 220"}
    a, r, b, g = (got[k] for k in ("ALFA 66", "ALFA 66 (REE)", "BETA 132", "GAMMA (DELTA) 220"))
    assert (a.owner, a.kv, a.change, a.demand_change, a.accept, a.lat) == ("iDE", 66.0, 2.5, 1.0, None, 40.356598)
    assert (r.display_name, r.short_name, r.change, r.accept_before, r.municipality) == ("ALFA 66 (REE)", "ALFA", 10.0, 3.0, "Aragón")
    assert (b.owner, b.demand, g.lat, g.lon, g.kv) == ("Viesgo", 6.0, 40.1, -3.2, 220.0)
    with pytest.raises(ValueError, match="REE Actual"):
        grid.snapshot(monitor.filter("sheet <> 'REE Actual'"))


def test_history(spark, monitor):
    maps = spark.createDataFrame(
        [("m", "enero 2026", 0, 2, ["", "Nombre y tensión"]), ("m", "enero 2026", 0, 3, ["MPE RdD", "", "Capacidad de acceso solicitada en curso y pendiente resolver MPE [MW]"]),
         ("m", "enero 2026", 0, 4, ["20", "GAMMA (DELTA) 220", "1"]), ("m", "enero 2026", 0, 5, ["8", "NEW 66", "2"]), ("m", "enero 2026", 0, 6, ["8"])], BRONZE)
    registry = spark.createDataFrame(
        [("2026-01-03", "alfa", "66", "50", "40", None, "7", "Endesa", 0, 0), ("bad", "alfa", "66", "1", "1", None, None, "Endesa", 0, 1), ("2025-11-01", "omega", None, None, "4", "5", "1", "iDE", 2, 0), ("2026-01-01", "nan", "1", "1", "1", None, None, "iDE", 2, 1)],
        "fecha string, subestacion string, tension_kv string, disponible_bruta string, disponible_neta string, cap_gen_ocup string, cap_gen_tram string, owner string, file_idx int, row_idx long",
    )
    got = {(r.key, r.month): r for r in grid.history(monitor, maps, registry).collect()}
    assert set(got) == {("ALFA 66", "2026-01"), ("ALFA 66", "2025-12"), ("BETA 132", "2026-01"), ("GAMMA (DELTA) 220", "2026-01"), ("NEW 66", "2026-01"), ("OMEGA", "2025-11")}
    a, g, o = got["ALFA 66", "2026-01"], got["GAMMA (DELTA) 220", "2026-01"], got["OMEGA", "2025-11"]
    # distribution first; transmission fills only what is null there, and the files what is still null
    assert (a.cap_gen, a.cap_gen_ocup, a.cap_gen_tram, a.acept, a.cap_gen_RdD, a.cap_dem_ocup) == (7.0, 3.0, 4.0, 5.0, 9.0, 1.0)
    assert (g.cap_gen, g.cap_gen_neta, g.cap_gen_tram, g.acept, g.cap_gen_RdD) == (1.0, 5.0, 1.0, 19.0, 20.0)
    assert (o.cap_gen, o.acept, o.cap_gen_RdD, o.cap_dem) == (4.0, 3.0, 4.0, None)
    assert got["NEW 66", "2026-01"].acept == 6.0 and got["ALFA 66", "2025-12"].cap_gen == 4.0
    lists = {r.key: [x.month for x in r.series] for r in grid.history_series(grid.history(monitor, maps, registry)).collect()}
    assert lists["ALFA 66"] == ["2025-12", "2026-01"]


def test_recurrence_ties_and_windows(spark):
    rows = [("a", "2024-02-01", 5.0), ("a", "2025-11-01", 7.0), ("b", "2024-04-01", 5.0), ("b", "2025-05-01", 6.0), ("b", "2025-12-01", 9.0), ("c", "2025-01-01", 1.0)]
    df = spark.createDataFrame(rows, "k string, d string, v double").withColumn("d", F.to_date("d"))
    got = {r.k: r for r in forecast.recurrence(df, ["k"], "d", "v", "2026-05-20").collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].pattern_quarter, got["a"].concentration_pct, str(got["a"].window_start), got["a"].window_state) == (1, 50.0, "2027-01-01", "en 226d")
    assert (got["b"].pattern_quarter, got["b"].window_state, got["b"].confidence, str(got["b"].window_end)) == (2, "EN_CURSO", 0.56, "2026-06-30")
    assert got["b"].event_days == "2024-04-01|2025-05-01|2025-12-01"


def test_cases(spark):
    causes = spark.createDataFrame([("k", 1, 10.0), ("k", 2, None), ("z", 1, 1.0)], "set string, m int, mw double")
    effects = spark.createDataFrame([("k", 1, 8.0), ("k", 3, 8.0), ("k", 19, 8.0), ("k", 20, 8.0), ("k", 5, 30.0), ("k", 6, 1.0)], "set string, em int, delta double")
    got = sorted((r.m, r.em, r.lag, r.ratio) for r in cases.interval_match(causes, effects, "set", "m", "em", 18, 5.0, (0.4, 2.0), "mw", "delta").collect())
    assert got == [(1, 3, 2, 0.8), (1, 19, 18, 0.8), (2, 3, 1, None), (2, 5, 3, None), (2, 19, 17, None), (2, 20, 18, None)]
    lags = spark.createDataFrame([(x,) for x in (30, 60, 90, 120)], "lag int")
    assert tuple(cases.lag_quantiles(lags, "lag").first()) == (4, 30, 60, 90, 30, 120)


def test_series_and_scores(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([10, 12, 11, 30, 5])], "k string, t int, v double")
    assert [r.drop for r in series.queue_drop(df, ["k"], "t", "v").orderBy("t").collect()] == [None, None, None, 0.0, 7.0]
    assert [r.t for r in series.jumps(df, ["k"], "t", "v", 5.0).collect()] == [3]
    z = [r.z for r in series.change_scores(df, ["k"], "t", "v").orderBy("t").collect()]
    assert z[:3] == [None, None, None] and z[3] == pytest.approx((19 - 0.5) / 2.1213203)
    scored = spark.createDataFrame([(100.0, None, 1.0)], "a double, b double, c double").select(radar.capped_score({"a": (0.5, 35), "b": (1, 5), "c": (2, 5)}).alias("s"))
    assert scored.first().s == 37.0
    counted = stats.conditional_counts(spark.range(10), {"small": F.col("id") < 3}).first()
    assert (counted.total, counted.small, counted.small_pct) == (10, 3, 30)
    assert stats.conditional_counts(spark.range(0), {"small": F.col("id") < 3}).first().small_pct is None


def test_predictions(spark):
    schema = "queue_drop double, stalled array<struct<p: string, mw: double, months: int>>, milestones array<struct<p: string, mw: double, milestone: string, confidence: string>>, anomaly struct<mw: double, dir: string, z: double>"
    rows = [(5.0, [("a", 1.0, 30), ("b", 2.0, 25), ("c", 3.0, 24)], [("m", 4.0, "AAP", "ocupada")], (40.0, "down", 3.0)), (0.0, None, None, None)]
    got = [[(p.mechanism, p.chance) for p in r.predictions] for r in radar.predictions(spark.createDataFrame(rows, schema)).collect()]
    assert got == [[("decaimiento_tramite", "media"), ("estancado", "media"), ("estancado", "media"), ("hito", "alta"), ("anomalia", "alta")], []]


def test_text_sources(spark, tmp_path):
    (tmp_path / "endesa_capacidad.csv").write_text("﻿fecha,subestacion,tension_kv,disponible_neta\n2024-01-01,Alfa,66,5\n", encoding="utf-8")
    (tmp_path / "ide_capacidad.csv").write_text("fecha,otra\n1,2\n")
    got = files.read_registry(spark, str(tmp_path)).collect()
    assert [(r.fecha, r.subestacion, r.cap_gen_tram, r.owner, r.file_idx) for r in got] == [("2024-01-01", "Alfa", None, "Endesa", 0)]
    with pytest.raises(ValueError):
        files.read_registry(spark, str(tmp_path), {"ide_capacidad.csv": "iDE"}, strict=True)
    mark = "<Placemark><name> {} </name><Point><coordinates>{}</coordinates></Point></Placemark>"
    kml = '<?xml version="1.0"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document><Folder>' + "".join(mark.format(*x) for x in [("A 220", "-3.12345678,40.5,0"), ("A 220", "-4,41"), ("B", "7"), ("C", "66d,1")]) + "</Folder></Document></kml>"
    (tmp_path / "x.kml").write_text(kml)
    assert [tuple(r) for r in files.read_placemarks(spark, str(tmp_path / "x.kml")).collect()] == [("A 220", 41.0, -4.0, 0), ("C", 1.0, None, 3)]
    (tmp_path / "x.js").write_text('// made\nconst ROWS = [{"a": 1, "b": NaN}, {"a": 2, "b": 2.5}];\nwindow.TOP = {"n": 3};\n')
    assert [tuple(r) for r in files.read_script_json(spark, str(tmp_path / "x.js"), "ROWS", "array<struct<a: int, b: double>>").collect()] == [(1, None), (2, 2.5)]
    assert files.read_script_json(spark, str(tmp_path / "x.js"), "window.TOP", "struct<n: int>").first().n == 3


def test_sinks(spark, tmp_path):
    import json

    df = files.without_nan(spark.createDataFrame([("ñ \"q\"", 1.5), ("b", math.nan)], "key string, v double"))
    entries = files.json_entries(df, "key", F.struct("v"))
    assert json.loads(files.one_object(entries, '"_v":2').first().value) == {"_v": 2, 'ñ "q"': {"v": 1.5}, "b": {"v": None}}
    assert files.as_script(files.one_object(entries), "X").first().value.startswith("window.X = {")
    files.write_entries(entries, str(tmp_path / "e"))
    assert spark.read.text(str(tmp_path / "e")).count() == 2
    days = spark.createDataFrame([("b", "2024-01-02"), ("a", "2024-01-01")], "k string, d string").withColumn("d", F.to_date("d"))
    files.write_csv(days, str(tmp_path / "c"), [F.asc("k")], ["d"])
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "c")).collect()] == [("a", "2024-01-01"), ("b", "2024-01-02")]


def test_workbooks(spark, tmp_path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main}><sheets><sheet name="DSO Actual" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>uno</t></si><si><r><t>d</t></r><r><t>os</t></r></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        cells = '<row r="3"><c r="B3" s="1"><v>46037</v></c></row><row r="5"><c r="A5" t="s"><v>0</v></c><c r="C5" t="s"><v>1</v></c><c r="D5"><v>2.5</v></c><c r="E5" t="inlineStr"><is><t>x</t></is></c></row>'
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{cells}</sheetData></worksheet>")
    (tmp_path / "m.xlsx").write_bytes(data.getvalue())
    got = [tuple(r) for r in xlsx.load(spark, str(tmp_path)).orderBy("row_idx").collect()]
    assert got == [("m.xlsx", "DSO Actual", 0, 3, [None, "2026-01-15 00:00:00", None, None, None]), ("m.xlsx", "DSO Actual", 0, 5, ["uno", None, "dos", "2.5", "x"])]


def test_streaming(spark, tmp_path):
    schema = "k string, t int, v double"
    land, table, mark = (str(tmp_path / x) for x in ("in", "out", "cp"))
    want = {}
    batches = [[("a", 1, 1.0), ("b", 1, 2.0)], [("a", 2, 3.0), ("a", 0, 9.0)], [("c", 5, 1.0)], [("b", 1, 4.0), ("a", 1, 8.0)], [("c", 4, 2.0)]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        watch.watch(spark, land, schema, watch.upsert_into(table, ["k"], "t", every=2), mark, every=None).awaitTermination()
        for k, t, v in rows:
            if k not in want or t >= want[k][1]:
                want[k] = (k, t, v)
        got = sorted(map(tuple, watch.upserted(spark, table, n, ["k"], "t", every=2).select("k", "t", "v").collect()))
        assert got == sorted(want.values())
    # a batch that comes again changes nothing
    watch.upsert_into(table, ["k"], "t", every=2)(spark.createDataFrame(batches[3], schema), 3)
    assert sorted(map(tuple, watch.upserted(spark, table, 4, ["k"], "t", every=2).select("k", "t", "v").collect())) == sorted(want.values())
    assert sorted(p.name for p in (tmp_path / "out" / "merged").iterdir()) == ["batch=1", "batch=3"]


def test_backfill(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "day string, v int")
    df.write.partitionBy("day").parquet(path)
    watch.backfill(df.withColumn("v", F.col("v") * 10), spark.createDataFrame([("20240102",)], "d string"), "day", path)
    assert sorted((str(r.day), r.v) for r in spark.read.parquet(path).collect()) == [("2024-01-01", 1), ("2024-01-02", 20)]
    versions = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 6), ("b", 1, 5)], "k string, t int, v int")
    assert sorted(map(tuple, watch.changes(versions, ["k"], "t").collect())) == [("a", 1, 5), ("a", 3, 6), ("b", 1, 5)]


def test_windowed_counts(spark, tmp_path):
    land, out, mark = (str(tmp_path / x) for x in ("in", "out", "cp"))
    schema = "ts timestamp, kind string"

    def arrive(*rows):
        spark.createDataFrame([(t, k) for t, k in rows], "ts string, kind string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(land)
        counted = watch.windowed_counts(spark.readStream.schema(schema).parquet(land), "ts", "10 minutes", "5 minutes", "kind")
        flat = counted.select(F.date_format("window.start", "HH:mm").alias("start"), "kind", "n")
        flat.writeStream.outputMode("append").option("checkpointLocation", mark).trigger(availableNow=True).start(out, format="parquet").awaitTermination()

    arrive(("2024-01-01 00:01:00", "a"), ("2024-01-01 00:02:00", "a"), ("2024-01-01 00:30:00", "b"))
    arrive(("2024-01-01 00:03:00", "a"), ("2024-01-01 01:00:00", "b"))  # the first is late
    arrive(("2024-01-01 02:00:00", "b"))
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [("00:00", "a", 2), ("00:30", "b", 1), ("01:00", "b", 1)]


def test_last_wins_by_column(spark):
    rng = random.Random(8)
    order = list(range(-100, 100))
    rng.shuffle(order)
    rows = [(rng.choice(["a", "b", None]), n, rng.choice([None, n / 2]), rng.choice([None, n % 2 == 0])) for n in order]
    rows += [("null first", None, 1.0, True), ("null first", -5, None, None), ("only null", None, 2.0, None)]
    df = spark.createDataFrame(rows, "k string, n int, x double, y boolean").repartition(4)
    by_order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0))
    for pick, want in ((keyed.last_wins, {r[0]: r for r in by_order}), (keyed.first_wins, {r[0]: r for r in by_order[::-1]})):
        found = pick(df, ["k"], F.col("n"))
        assert {r.k: tuple(r) for r in found.collect()} == want
        # rows of a fixed width are hashed by key, not sorted whole
        assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_history_aggregates_measures_not_cells(spark):
    cells = [None] * 110
    rows = [("w", "REE Actual", 1, 3, [None, "2026-01-15"]), ("w", "DSO Actual", 0, 3, [None, "2026-01-15"])]
    for i in range(40):
        one = list(cells)
        one[1], one[4], one[10], one[21] = f"N{i % 7}", str(i), f"D{i % 5}", str(i)
        rows += [("w", "REE Actual", 1, 9 + i, one), ("w", "DSO Actual", 0, 6 + i, one)]
    made = grid.monitor_history(spark.createDataFrame(rows, BRONZE).repartition(3))
    want = {f"N{i % 7}": float(i) for i in range(40)} | {f"D{i % 5}": float(i) for i in range(40)}
    assert {r.key: r.cap_gen for r in made.collect()} == want
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert not [x for x in plan.splitlines() if "SortAggregate" in x and "cells" in x]
    assert not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "BuildLeft" in x]
