"""Queries of the grid's other sources, written as the files they come in and read back: placemarks, map sheets, the operators' files."""

from __future__ import annotations

import sys
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import scratch
from ..sources import files, xlsx
from . import grid
from .catalog import _coordinate_sql, query, table
from .grid_queries import _DSO, _REE, _row, _sheet

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package


def _placemarks(spark, sf_dir: str) -> DataFrame:
    """Placemarks of half of the suppliers' nodes in KML files of a thousand: by name, in normal form, one alias for many; some twice, some without a place."""
    s = F.col("s_suppkey")
    mark = lambda name, lon, lat: F.concat(
        F.lit("<Placemark><name> "), name, F.lit("</name><Point><coordinates> "), lon, F.lit(","), lat, F.lit(",0 </coordinates></Point></Placemark>")
    )
    number = lambda c: F.format_string("%.3f", c)
    own = F.when(s % 2 == 0, F.concat(F.lit("SUB "), s, F.lit(" 66"))).otherwise(F.concat(F.lit("NODE "), s, F.lit(" 220")))
    one = mark(own, number(s * 0.001 - 3.0), number(s * 0.001 + 40.0))
    again = mark(own, number(s * 0.001 - 3.0), number(s * 0.001 + 41.0))
    bare = F.concat(F.lit("<Placemark><name>"), own, F.lit("</name></Placemark>"))
    rows = table(spark, sf_dir, "supplier").filter(s % 4 <= 1).select(F.when(s % 16 == 4, bare).when(s % 8 == 0, F.concat(one, again)).otherwise(one).alias("value"), F.floor(s / 1000).alias("file"))
    alias = spark.range(1).select(mark(F.lit("X 220"), F.lit("-1.25"), F.lit("43.5")).alias("value"), F.lit(-1).cast("long").alias("file"))
    inside = F.array_join(F.sort_array(F.collect_list("value")), "\n")
    whole = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<kml xmlns="http://www.opengis.net/kml/2.2"><Document>'), inside, F.lit("</Document></kml>"))
    path = scratch.folder(spark, "kml")
    rows.unionByName(alias).groupBy("file").agg(whole.alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(path)
    return files.read_placemarks(spark, path)


@query(f"""
    WITH dso AS ({_DSO}), ree AS ({_REE}), xy AS ({_coordinate_sql()})
    SELECT key, CASE WHEN c % 13 <> 0 THEN lat END AS lat, CASE WHEN c % 13 <> 0 THEN lon END AS lon FROM dso JOIN xy ON c_custkey = c
    UNION ALL
    SELECT key || CASE WHEN key IN (SELECT key FROM dso) THEN ' (REE)' ELSE '' END,
           CASE WHEN s % 4 = 3 THEN 43.5 WHEN s % 8 = 0 THEN round(s * 0.001 + 41.0, 3) WHEN s % 4 = 1 OR s % 16 = 12 THEN round(s * 0.001 + 40.0, 3) END::DOUBLE,
           CASE WHEN s % 4 = 3 THEN -1.25 WHEN s % 4 = 1 OR s % 8 = 0 OR s % 16 = 12 THEN round(s * 0.001 - 3.0, 3) END::DOUBLE
    FROM ree
""")
def grid_coordinates(spark, sf_dir):
    """Where substations are: by inverse projection in distribution, by placemarks in transmission."""
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    easting, northing = (400000.0 + c * 100).cast("string"), (4400000.0 + F.col("c_acctbal") * 10).cast("string")
    dso = _row(
        36, c1=F.lit("local"), c3=F.when(F.col("c_nationkey") % 2 == 0, "Palmas, Las").otherwise("Teruel"), c5=F.col("c_name"), c7=F.when(c % 13 == 0, "N/A").otherwise(easting), c8=northing,
        c9=F.lit("66"), c10=F.concat(F.lit(" SUB "), c % 997, F.lit(" 66 ")), c11=F.lit("1"),
    )
    key = F.when(s % 2 == 0, F.concat(F.lit("SUB "), s, F.lit(" 66"))).otherwise(F.concat(F.lit("NODE  "), s, F.lit(" (X) 220")))
    bronze = _sheet(table(spark, sf_dir, "customer"), "DSO Actual", 0, 6 + c, dso).unionByName(_sheet(table(spark, sf_dir, "supplier"), "REE Actual", 1, 9 + s, _row(36, c1=key, c4=F.lit("2"))))
    return grid.snapshot(bronze, _placemarks(spark, sf_dir)).select("key", "lat", "lon")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _monitor_workbook(spark, sf_dir: str) -> DataFrame:
    """A monthly sheet and the previous month's one of the same month: their order decides, not the order of the listing."""
    p, part, one = F.col("p_partkey"), table(spark, sf_dir, "part"), table(spark, sf_dir, "region").limit(1)
    key = F.concat(F.lit("N"), p, F.lit(" 66"))
    monthly = _row(36, c10=key, c11=p % 50, c16=p % 5, c21=p % 40, c25=F.when(p % 3 != 0, F.lit("3")), c26=p % 4, c30=F.when(p % 3 == 0, F.lit("9.25")))
    previous = _row(36, c10=key, c15=F.lit("6"), c21=F.lit("77"), c25=F.lit("8"))
    return _union([
        _sheet(one, "DSO Anterior", 1, F.lit(3), _row(2, c1=F.lit("2025-12-20 00:00:00"))), _sheet(part.filter(p % 5 == 0), "DSO Anterior", 1, 6 + p, previous),
        _sheet(one, "DSO Dic25", 3, F.lit(5), _row(36, c30=F.lit("Capacidad de acceso disponible para MPE RdD"))), _sheet(part.filter(p % 2 == 0), "DSO Dic25", 3, 6 + p, monthly),
    ])


def _maps_workbook(spark, sf_dir: str) -> DataFrame:
    """Two map sheets, with today's headers and with the early ones."""
    p, part, one = F.col("p_partkey"), table(spark, sf_dir, "part"), table(spark, sf_dir, "region").limit(1)
    row = _row(6, c0=F.concat(F.lit(" N"), p, F.lit(" 66 ")), c2=p % 30 + 0.25, c4=F.when(p % 9 == 0, F.lit("N/A")).otherwise((p % 7).cast("string")))
    name, wanted = F.lit("Nombre  y Tensión"), F.lit("Capacidad de acceso solicitada pendiente de resolver MPE [MW]")
    return _union([
        _sheet(one, "Mapa diciembre 2025", 0, F.lit(2), _row(6, c0=name)),
        _sheet(one, "Mapa diciembre 2025", 0, F.lit(4), _row(6, c1=F.lit("MPE RdD MGES"), c2=F.lit("Disponible MPE RdD"), c3=F.lit("MPE RdD"), c4=wanted)),
        _sheet(part.filter(p % 3 == 0), "Mapa diciembre 2025", 0, 5 + p, row),
        _sheet(one, "Mapa enero 2026", 1, F.lit(3), _row(6, c0=name, c1=F.lit("Capacidad de acceso disponible para MPE RdT"), c2=F.lit("Capacidad de acceso disponible para MPE"), c4=wanted)),
        _sheet(part.filter(p % 7 == 0), "Mapa enero 2026", 1, 5 + p, row),
    ])


def _operator_files(spark, sf_dir: str) -> DataFrame:
    """Two operators' files in the shared folder; the second has no column for what is granted."""
    p, part = F.col("p_partkey"), table(spark, sf_dir, "part")
    text = lambda c: c.cast("string")
    common = [
        F.lit("2025-12-15").alias("fecha"), F.concat(F.lit(" n"), p).alias("subestacion"), F.lit("66.0").alias("tension_kv"),
        text(p % 20 + 0.5).alias("disponible_neta"), F.when(p % 5 == 1, "N/A").otherwise(text(p % 6)).alias("cap_gen_tram"),
    ]
    home = scratch.folder(spark, "registry")
    first = part.filter(p % 4 == 1).select(*common, text(p % 25 + 1.5).alias("disponible_bruta"), F.when(p % 3 == 1, "4").alias("cap_gen_ocup"))
    second = part.filter(p % 8 == 1).select(*(c if i != 3 else F.lit("99").alias("disponible_neta") for i, c in enumerate(common)), F.lit("5").alias("cap_gen_ocup"))
    odd = spark.range(1).select(F.lit("no day").alias("fecha"), F.lit("lost").alias("subestacion"), F.lit("").alias("tension_kv"), F.lit("1").alias("disponible_neta"), F.lit("1").alias("cap_gen_tram"), F.lit("1").alias("cap_gen_ocup"))
    first.write.option("header", True).csv(f"{home}/endesa_capacidad.csv")
    second.unionByName(odd).write.option("header", True).csv(f"{home}/ide_capacidad.csv")
    return files.read_registry(spark, home)


def _records(source: int, o1, o2, month: str, where: str, **measures: str) -> str:
    """SQL of one source's records of parts."""
    given = ", ".join(f"CAST({measures.get(m, 'NULL')} AS DOUBLE) AS {m}" for m in (x.lower() for x in grid.MEASURES))
    return f"SELECT 'N' || p_partkey || ' 66' AS key, '{month}' AS month, {source} AS source, {o1} AS o1, {o2} AS o2, {given} FROM part WHERE {where}"


_NET, _WANTED, _PENDING = "p_partkey % 20 + 0.5", "CASE WHEN p_partkey % 9 <> 0 THEN p_partkey % 7 END", "CASE WHEN p_partkey % 5 <> 1 THEN p_partkey % 6 END"
_FREE = "CASE WHEN p_partkey % 3 = 0 THEN 9.25 END"
_ALL = " UNION ALL ".join([
    _records(
        0, 0, 3, "2025-12", "p_partkey % 2 = 0", cap_gen="p_partkey % 40", cap_gen_disp="p_partkey % 40", cap_gen_neta="p_partkey % 40", cap_dem="p_partkey % 50", cap_dem_disp="p_partkey % 50",
        cap_dem_neta="p_partkey % 50", cap_gen_ocup="CASE WHEN p_partkey % 3 <> 0 THEN 3 END", cap_gen_tram="p_partkey % 4", cap_dem_tram="p_partkey % 5", acept=f"{_FREE} - p_partkey % 4", cap_gen_rdd=_FREE,
    ),
    _records(0, 1, 1, "2025-12", "p_partkey % 5 = 0", cap_gen="77", cap_gen_disp="77", cap_gen_neta="77", cap_gen_ocup="8", cap_dem_ocup="6"),
    _records(1, 0, 0, "2025-12", "p_partkey % 3 = 0", cap_gen_tram=_WANTED, acept=f"p_partkey % 30 + 0.25 - {_WANTED}", cap_gen_rdd="p_partkey % 30 + 0.25"),
    _records(1, 0, 1, "2026-01", "p_partkey % 7 = 0", cap_gen_tram=_WANTED, acept=f"p_partkey % 30 + 0.25 - {_WANTED}", cap_gen_rdd="p_partkey % 30 + 0.25"),
    _records(
        2, 0, 0, "2025-12", "p_partkey % 4 = 1", cap_gen=_NET, cap_gen_neta=_NET, cap_gen_rdd=_NET, cap_gen_ocup="CASE WHEN p_partkey % 3 = 1 THEN 4 END", cap_gen_tram=_PENDING,
        cap_gen_disp="p_partkey % 25 + 1.5", acept=f"{_NET} - {_PENDING}",
    ),
    _records(2, 2, 0, "2025-12", "p_partkey % 8 = 1", cap_gen="99", cap_gen_neta="99", cap_gen_rdd="99", cap_gen_ocup="5", cap_gen_tram=_PENDING, acept=f"99 - {_PENDING}"),
])


def _filled(measure: str) -> str:
    allowed = ", ".join(str(s) for s, names in grid.MASKS.items() if measure in names)
    m = measure.lower()
    return f'coalesce(max({m}) FILTER (WHERE rn = 1), arg_min({m}, rn) FILTER (WHERE {m} IS NOT NULL AND source IN ({allowed}))) AS "{measure}"'


@query(f"""
    WITH r AS ({_ALL}), n AS (SELECT *, row_number() OVER (PARTITION BY key, month ORDER BY source, o1, o2) AS rn FROM r)
    SELECT key, month, {", ".join(map(_filled, grid.MEASURES))}, CAST(arg_min(source, rn) AS INTEGER) AS source FROM n GROUP BY key, month
""")
def grid_history_sources(spark, sf_dir):
    """The monthly history of all three sources: monitor before maps before the operators' files, each filling what it may."""
    return grid.history(_monitor_workbook(spark, sf_dir), _maps_workbook(spark, sf_dir), _operator_files(spark, sf_dir))


@query("""
    WITH e AS (SELECT to_json('K' || c_custkey) || ':' || '[' || c_nationkey || ',' || to_json(c_mktsegment) || ']' AS entry FROM customer)
    SELECT CASE WHEN entry = (SELECT min(entry) FROM e) THEN entry ELSE ',' || entry END AS value FROM e UNION ALL SELECT '{' UNION ALL SELECT '}'
""")
def object_parts(spark, sf_dir):
    """Customers as the lines of one published object, written and read back."""
    path = scratch.folder(spark, "object")
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("K"), "c_custkey").alias("key"), "c_nationkey", "c_mktsegment")
    files.write_object(files.list_entries(rows, "key", files.as_list([F.col("c_nationkey"), F.col("c_mktsegment")])), path)
    return spark.read.text(path)


def _books(batches):
    """A workbook of two sheets from each row of (file, names, balances), the first sheet's texts shared, the second's inline."""
    import io
    import zipfile

    import pandas as pd

    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    for pdf in batches:
        for file, keys, names, days in pdf.itertuples(index=False):
            data = io.BytesIO()
            one = "".join(f'<row r="{k + 6}"><c r="B{k + 6}" t="s"><v>{i}</v></c><c r="D{k + 6}" s="1"><v>{d}</v></c></row>' for i, (k, d) in enumerate(zip(keys, days, strict=True)))
            two = "".join(f'<row r="{k + 1}"><c r="A{k + 1}" t="inlineStr"><is><t>{n}</t></is></c><c><v>{k}</v></c></row>' for k, n in zip(keys, names, strict=True))
            with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="DSO {file}" r:id="r1"/><sheet name="REE {file}" r:id="r2"/></sheets></workbook>')
                z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/a.xml"/><Relationship Id="r2" Target="/xl/worksheets/b.xml"/></Relationships>')
                z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
                z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si><t>{n}</t></si>" for n in names) + "</sst>")
                for name, body in (("a", one), ("b", two)):
                    z.writestr(f"xl/worksheets/{name}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
            yield pd.DataFrame({"book": [data.getvalue()]})


@query("""
    WITH c AS (SELECT c_custkey AS k, c_custkey // 1000 AS file, c_name, 40000 + c_custkey % 5000 AS day FROM customer)
    SELECT 'DSO ' || file AS sheet, 0 AS sheet_idx, CAST(k + 6 AS INTEGER) AS row_idx, '~|' || c_name || '|~|' || strftime(DATE '1899-12-30' + CAST(day AS INTEGER), '%Y-%m-%d 00:00:00') AS cells FROM c
    UNION ALL SELECT 'REE ' || file, 1, CAST(k + 1 AS INTEGER), c_name || '|' || k FROM c
""")
def workbook_cells(spark, sf_dir):
    """Customers as workbooks of a thousand rows and two sheets, written as files and read as bronze cells."""
    c = table(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / 1000).alias("file"), F.struct(F.col("c_custkey").alias("k"), F.col("c_name").alias("n"), (F.col("c_custkey") % 5000 + 40000).alias("d")).alias("r"))
    grouped = c.groupBy("file").agg(F.sort_array(F.collect_list("r")).alias("r")).select("file", "r.k", "r.n", "r.d")
    path = scratch.folder(spark, "workbooks")
    grouped.mapInPandas(_books, "book binary").select(F.col("book").cast("string")).write.option("maxRecordsPerFile", 1).text(path)
    cells = F.array_join("cells", "|", "~")
    return xlsx.load(spark, path, rows=300).select("sheet", "sheet_idx", "row_idx", cells.alias("cells"))


@query("""
    SELECT 'K' || c_custkey AS key, c_nationkey AS nation, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance, c_name AS name FROM customer
""")
def script_round_trip(spark, sf_dir):
    """Customers as script files that assign one object each, of a thousand members, read back as its entries."""
    c = table(spark, sf_dir, "customer")
    rows = c.select(F.concat(F.lit("K"), "c_custkey").alias("key"), F.floor(F.col("c_custkey") / 1000).alias("file"), F.struct(F.col("c_nationkey").alias("nation"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"), F.col("c_name").alias("name")).alias("v"))
    entries = files.json_entries(rows, "key", F.col("v"), "file")
    objects = entries.groupBy("file").agg(F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list("value")), ","), F.lit("}")).alias("value"))
    path = scratch.folder(spark, "scripts")
    files.as_script(objects, "CUSTOMERS").write.option("maxRecordsPerFile", 1).text(path)
    found = files.read_script_json(spark, path, "CUSTOMERS", "map<string, struct<nation: int, balance: double, name: string>>")
    return found.select("key", "value.nation", "value.balance", "value.name")


@query("""
    SELECT s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation, CASE WHEN s_suppkey % 3 = 0 THEN 'a "b", c' END AS note, '2024-0' || (1 + s_suppkey % 9) || '-05' AS day,
           row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name) AS place
    FROM supplier
""")
def csv_round_trip(spark, sf_dir):
    """Suppliers as sorted CSV with quoted text and ISO days, read back in the order of the files."""
    s = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.when(s % 3 == 0, 'a "b", c').alias("note"), F.to_date(F.concat(F.lit("2024-0"), 1 + s % 9, F.lit("-05"))).alias("day")
    )
    path = scratch.folder(spark, "csv")
    files.write_csv(rows, path, [F.asc("nation"), F.asc("name")], dates=["day"])
    # the files' names and places in them are the order, in all as within each nation
    at = files.read_csv(spark, path).withColumns({"_file": F.input_file_name(), "_at": F.monotonically_increasing_id()})
    return at.select("name", "nation", "note", "day", F.row_number().over(Window.partitionBy("nation").orderBy("_file", "_at")).cast("long").alias("place"))
