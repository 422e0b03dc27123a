"""The grid's own pipelines: bronze cells to snapshot, monthly history and tidy table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, numeric, text
from ..operators import headers, keyed, series
from ..sources import bronze as sheets
from ..sources import files

#: The 17 places of a snapshot record, in sink order.
SNAPSHOT = [
    "display_name", "short_name", "province", "municipality", "kv", "cap", "cap_before", "cap_taken", "accept", "accept_before",
    "owner", "grid", "change", "lat", "lon", "demand", "demand_change",
]
#: The 12 measures of a history record, in sink order after the date.
MEASURES = [
    "cap_gen", "cap_gen_ocup", "cap_gen_tram", "cap_dem", "cap_dem_ocup", "cap_dem_tram", "acept",
    "cap_gen_disp", "cap_gen_neta", "cap_dem_disp", "cap_dem_neta", "cap_gen_RdD",
]
MONITOR, MAPS, CSV = 0, 1, 2
#: What a later record of each source may fill.
MASKS = {MONITOR: MEASURES[:-1], MAPS: ["cap_gen_tram", "acept", "cap_gen_RdD"], CSV: MEASURES}


def at(i: int) -> Column:
    return F.get("cells", F.lit(i))


def require_sheets(bronze: DataFrame, *names: str) -> None:
    """Raise unless the workbook has all ``names``."""
    there = {r["sheet"] for r in bronze.select("sheet").filter(F.col("sheet").isin(*names)).distinct().collect()}
    if missing := [n for n in names if n not in there]:
        raise ValueError(f"sheets not found: {', '.join(missing)}")


def _keyed_rows(rows: DataFrame, key: Column, by: list[str], made: list[Column] | None = None) -> DataFrame:
    """Rows with a key; of one key in a sheet the last row wins.  ``made``, if given, stands for the cells, which are wider."""
    named = rows.withColumn("key", text.stripped(key)).filter(F.length("key") > 0)
    if made:
        named = named.select(*by, "key", "row_idx", *made)
    return keyed.last_wins(named, [*by, "key"], F.col("row_idx"))


def distribution_snapshot(bronze: DataFrame) -> DataFrame:
    rows = _keyed_rows(bronze.filter("sheet = 'DSO Actual' and row_idx >= 6"), at(10), ["sheet"])
    value = lambda i: numeric.to_float_keeping_nan(at(i))
    province = text.stripped(at(3))
    rows = rows.withColumn("_place", geo.place(value(7), value(8), province))
    return rows.select(
        "key",
        F.col("key").alias("display_name"),
        text.short_name(at(5), F.col("key")).alias("short_name"),
        province.alias("province"),
        text.stripped(at(4)).alias("municipality"),
        value(9).alias("kv"),
        value(11).alias("cap"),
        value(12).alias("cap_before"),
        value(15).alias("cap_taken"),
        value(34).alias("accept"),
        value(35).alias("accept_before"),
        text.canonical(text.stripped(at(1))).alias("owner"),
        F.lit("Distribución").alias("grid"),
        numeric.delta(value(11), value(12)).alias("change"),
        F.col("_place.lat").alias("lat"),
        F.col("_place.lon").alias("lon"),
        value(21).alias("demand"),
        numeric.delta(value(21), value(22)).alias("demand_change"),
    )


def match_places(keys: DataFrame, places: DataFrame) -> DataFrame:
    """``keys`` with lat and lon of the placemark that fits best: as named, normalised, by alias, without suffix."""
    parts = lambda i: F.regexp_extract("key", r"(?U)^(.+?)\s*\((.+?)\)\s*(\d+)$", i)
    alias = F.when(parts(2) != "", F.concat(F.trim(parts(2)), F.lit(" "), F.trim(parts(3))))
    base = F.when(F.col("key").endswith(" (REE)"), F.regexp_replace("key", r" \(REE\)$", ""))
    tries = [(c, loose) for c in (F.col("key"), alias, base) for loose in (False, True)]
    order = "place_idx" if "place_idx" in places.columns else None
    return keyed.priority_match(keys, places, "key", "name", tries, text.normal_key, order).drop("name", "match_rank", "place_idx")


def transmission_snapshot(bronze: DataFrame, places: DataFrame | None = None) -> DataFrame:
    rows = _keyed_rows(bronze.filter("sheet = 'REE Actual' and row_idx >= 9"), at(1), ["sheet"])
    value = lambda i: numeric.to_float_keeping_nan(at(i))
    made = rows.select(
        "key",
        F.col("key").alias("display_name"),
        text.all_but_last_token(F.col("key")).alias("short_name"),
        F.lit("").alias("province"),
        text.stripped(at(3)).alias("municipality"),
        text.tension_of_last_token(F.col("key")).alias("kv"),
        value(4).alias("cap"),
        value(5).alias("cap_before"),
        F.lit(None).cast("double").alias("cap_taken"),
        value(10).alias("accept"),
        value(10).alias("accept_before"),
        F.lit("REE").alias("owner"),
        F.lit("Transporte").alias("grid"),
        numeric.delta(value(4), value(5)).alias("change"),
        value(7).alias("demand"),
        numeric.delta(value(7), value(8)).alias("demand_change"),
    )
    if places is None:
        none = F.lit(None).cast("double")
        return made.withColumns({"lat": none, "lon": none})
    return match_places(made, places)


def snapshot(bronze: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """One row for each substation: key and the 17 snapshot columns; colliding transmission keys get `` (REE)``."""
    require_sheets(bronze, "DSO Actual", "REE Actual")
    ree = transmission_snapshot(bronze, places)
    return keyed.rename_collisions(distribution_snapshot(bronze), ree, "key", " (REE)", also=["display_name"]).select("key", *SNAPSHOT)


# ---- history


def monitor_sheets(bronze: DataFrame) -> DataFrame:
    """(sheet, kind, month, special, sheet_idx) of the sheets that hold a month.

    Monthly sheets say it in their name; current and previous ones in the
    second cell of row 3, and come after all others of their month.
    """
    names = bronze.select("sheet", "sheet_idx").distinct()
    kind, year, month = sheets.monthly_sheet(F.col("sheet"))
    monthly = names.select("sheet", "sheet_idx", kind.alias("kind"), text.month_label(year, month).alias("month"), F.lit(0).alias("special"))
    when = F.try_to_timestamp(F.substring(at(1), 1, 10), F.lit("yyyy-MM-dd"))
    special = bronze.filter("row_idx = 3").filter(F.col("sheet").rlike("^(REE|DSO) (Actual|Anterior)$"))
    special = special.select("sheet", "sheet_idx", F.substring("sheet", 1, 3).alias("kind"), F.date_format(when, "yyyy-MM").alias("month"), F.lit(1).alias("special"))
    return monthly.filter("kind is not null").unionByName(special.filter("month is not null"))


def _measures(**given: Column) -> list[Column]:
    return [given.get(m, F.lit(None)).cast("double").alias(m) for m in MEASURES]


def monitor_history(bronze: DataFrame) -> DataFrame:
    known = monitor_sheets(bronze)
    # a row for each sheet; by the files' sizes, which tell little of the cells, Catalyst may broadcast the cells instead
    rows = bronze.select("sheet", "row_idx", "cells").join(F.broadcast(known), "sheet")
    value = lambda i: numeric.to_float(at(i))
    order = ["special", "sheet_idx"]

    rdd, acept = headers.DSO_RULES[0].fits, lambda t: t.contains("MPE RdD") & ~t.contains("MGES")
    rules = [headers.Rule("rdd5", rdd, (5,)), headers.Rule("rdd4", rdd, (4,)), headers.Rule("acept5", acept, (5,))]
    raw = lambda t: t
    found = headers.by_sheet(headers.resolve_columns(bronze, rules, raw), ["rdd5", "rdd4", "acept5"])
    # row 4 counts only if row 5 has nothing beyond its first cell; the first cell never counts
    pos = F.when(F.col("rdd5_pos").isNotNull(), F.col("rdd5_pos")).when(F.coalesce("acept5_pos", F.lit(0)) > 0, F.lit(None)).otherwise(F.col("rdd4_pos"))
    found = found.select("sheet", F.nullif(pos, F.lit(0)).alias("rdd_pos"))
    by = ["sheet", "month", *order]
    free = F.when(F.col("rdd_pos").isNotNull(), numeric.to_float(headers.cell("rdd")))
    dso = rows.filter("kind = 'DSO' and row_idx >= 6 and size(cells) >= 27").join(F.broadcast(found), "sheet", "left")
    dso = _keyed_rows(
        dso, at(10), by,
        _measures(
            cap_gen=value(21), cap_gen_disp=value(21), cap_gen_neta=value(21), cap_dem=value(11), cap_dem_disp=value(11), cap_dem_neta=value(11),
            cap_gen_ocup=value(25), cap_gen_tram=value(26), cap_dem_ocup=value(15), cap_dem_tram=value(16),
            acept=numeric.delta(free, value(26)), cap_gen_RdD=free,
        ),
    ).select("key", "month", *order, *MEASURES)

    found = headers.by_sheet(headers.resolve_columns(bronze, headers.REE_RULES, text.collapsed), ["rdd"]).select("sheet", "rdd_pos")
    ree = rows.filter("kind = 'REE' and row_idx >= 9 and size(cells) >= 102").join(F.broadcast(found), "sheet", "left")
    ree = _keyed_rows(
        ree, at(1), by,
        _measures(
            cap_gen=value(4), cap_dem=value(7), cap_dem_neta=value(7), cap_gen_ocup=value(33), cap_gen_tram=value(40), cap_gen_disp=value(44),
            cap_dem_ocup=numeric.add_known(value(89), value(93)), cap_dem_tram=numeric.add_known(value(100), value(101)),
            cap_gen_neta=numeric.less_pending(value(44), value(40)), acept=value(10), cap_gen_RdD=numeric.to_float(headers.cell("rdd")),
        ),
    ).select("key", "month", *order, *MEASURES)
    return dso.unionByName(ree).withColumnsRenamed({"special": "o1", "sheet_idx": "o2"}).withColumn("source", F.lit(MONITOR))


def maps_history(bronze: DataFrame) -> DataFrame:
    found = headers.by_sheet(headers.resolve_columns(bronze, headers.MAP_RULES, text.collapsed), ["name", "rdd", "tram"])
    found = found.filter("name_pos is not null and rdd_pos is not null and tram_pos is not null")
    year, month = sheets.map_sheet(F.col("sheet"))
    rows = bronze.join(F.broadcast(found), "sheet").withColumn("month", text.month_label(year, month)).filter("month is not null")
    rows = rows.filter("row_idx > header_end and size(cells) > greatest(name_pos, rdd_pos, tram_pos)")
    free, pending = numeric.to_float(headers.cell("rdd")), numeric.to_float(headers.cell("tram"))
    rows = _keyed_rows(rows, headers.cell("name"), ["sheet", "month", "sheet_idx"], _measures(cap_gen_tram=pending, acept=numeric.delta(free, pending), cap_gen_RdD=free))
    return rows.select("key", "month", F.lit(0).alias("o1"), F.col("sheet_idx").alias("o2"), *MEASURES, F.lit(MAPS).alias("source"))


def csv_history(registry: DataFrame) -> DataFrame:
    """History records of the operators' files; ``acept`` subtracts pending as the files' readers do, from what is already net."""
    day = F.try_to_timestamp(F.trim("fecha"))
    kv = numeric.to_float(F.col("tension_kv"))
    name = text.stripped(F.col("subestacion"))
    rows = registry.filter(day.isNotNull() & F.col("subestacion").isNotNull() & (name != "") & (F.upper(name) != "NAN"))
    value = lambda c: numeric.to_float(F.col(c))
    net, pending = value("disponible_neta"), value("cap_gen_tram")
    return rows.select(
        text.name_and_tension(F.col("subestacion"), kv).alias("key"),
        F.date_format(day, "yyyy-MM").alias("month"),
        F.col("file_idx").alias("o1"),
        F.col("row_idx").alias("o2"),
        *_measures(cap_gen=net, cap_gen_neta=net, cap_gen_RdD=net, cap_gen_ocup=value("cap_gen_ocup"), cap_gen_tram=pending, cap_gen_disp=value("disponible_bruta"), acept=net - pending),
        F.lit(CSV).alias("source"),
    )


def history(monitor: DataFrame | None = None, maps: DataFrame | None = None, registry: DataFrame | None = None) -> DataFrame:
    """(key, month, 12 measures, source): monitor first, then maps, then the operators' files."""
    parts = [f(x) for f, x in ((monitor_history, monitor), (maps_history, maps), (csv_history, registry)) if x is not None]
    if not parts:
        raise ValueError("no source given")
    rows = reduce(DataFrame.unionByName, (p.withColumns({"o1": F.col("o1").cast("long"), "o2": F.col("o2").cast("long")}) for p in parts))
    return keyed.masked_fill_upsert(rows, ["key", "month"], MEASURES, MASKS, "source", F.col("o1"), F.col("o2"))


def history_series(records: DataFrame) -> DataFrame:
    """One row for each key: its months in order, each as (date, 12 measures)."""
    return series.collected(records, ["key"], "month", MEASURES)


def snapshot_entries(rows: DataFrame) -> DataFrame:
    """The snapshot as members ``"key":[17 values]`` of its published object."""
    return files.list_entries(files.without_nan(rows), "key", files.as_list([F.col(c) for c in SNAPSHOT]))


def history_entries(records: DataFrame) -> DataFrame:
    """The history as members ``"key":[[month, 12 numbers], ...]`` of its published object, months in order."""
    record = lambda x: files.as_list([x["month"], *(x[m] for m in MEASURES)])
    months = F.array_join(F.transform("series", record), ",")
    return files.list_entries(history_series(files.without_nan(records)), "key", F.concat(F.lit("["), months, F.lit("]")))


# ---- tidy table


def tidy(bronze: DataFrame, since: str | None = "2023-12-01") -> DataFrame:
    """The wide sheets as one row for each node and day, in the shape of the operators' files."""
    fields = ["name", "ccaa", "disp", "sol", "otorg"]
    clean = lambda c: F.replace(F.lower(text.stripped(c)), F.lit("\n"), F.lit(" "))
    found = headers.by_sheet(headers.resolve_columns(bronze, headers.TIDY_RULES, clean), fields)
    found = found.filter("name_pos is not null and disp_pos is not null and sol_pos is not null")
    rows = bronze.withColumn("fecha", sheets.dated_sheet(F.col("sheet"))).filter("fecha is not null and row_idx >= 5")
    if since:
        rows = rows.filter(F.col("fecha") >= since)
    rows = rows.join(F.broadcast(found), "sheet").withColumn("name", text.stripped(headers.cell("name")))
    rows = rows.filter((F.col("name") != "") & (F.col("name") != "For Formula ROW") & ~F.upper("name").rlike("^(NOMBRE|TOTAL)"))
    value = lambda f: numeric.to_float_with_comma(headers.cell(f))
    pending = F.coalesce(value("sol"), F.lit(0.0))
    return rows.filter(value("disp").isNotNull()).select(
        "fecha",
        F.lit("REE").alias("distribuidora"),
        F.lit("").alias("provincia"),
        F.lit("").alias("municipio"),
        text.without_tension(F.col("name")).alias("subestacion"),
        text.tension_of_end(F.col("name")).alias("tension_kv"),
        F.round(value("disp"), 4).alias("disponible_bruta"),
        F.round(value("disp") - pending, 4).alias("disponible_neta"),
        value("otorg").alias("cap_gen_ocup"),
        numeric.zero_as_null(pending).alias("cap_gen_tram"),
        F.when(F.col("ccaa_pos").isNotNull(), text.stripped(headers.cell("ccaa"))).otherwise("").alias("ccaa"),
    )


def tidy_order() -> list[Column]:
    return [F.asc("subestacion"), F.asc_nulls_last("tension_kv"), F.asc("fecha")]
