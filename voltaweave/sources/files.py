"""Text sources: CSV registries, KML placemarks, JSON in script files; and the sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import to_float
from ..operators.keyed import last_wins

#: The operators' files and their owners, in order of precedence.
CSV_SOURCES = {
    "endesa_capacidad.csv": "Endesa",
    "eredes_capacidad.csv": "ERedes",
    "ide_capacidad.csv": "iDE",
    "ree_capacidad.csv": "REE",
    "ufd_capacidad.csv": "UFD",
    "viesgo_capacidad.csv": "Viesgo",
}
#: The columns of the operators' files.
CSV_COLUMNS = [
    "fecha", "distribuidora", "provincia", "municipio", "subestacion", "tension_kv",
    "disponible_bruta", "disponible_neta", "cap_gen_ocup", "cap_gen_tram", "ccaa",
]
REQUIRED = ("subestacion", "disponible_neta")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; a byte-order mark is dropped."""
    return spark.read.option("header", True).option("encoding", "UTF-8").csv(path)


def read_registry(spark: SparkSession, folder: str, sources: Mapping[str, str] = CSV_SOURCES, strict: bool = False) -> DataFrame | None:
    """All files of the registry with owner, file_idx and row order; columns a file lacks are null.

    Files that are missing or lack a required column are left out, or raise if
    ``strict``.  None if nothing is left.
    """
    found = []
    for at, (name, owner) in enumerate(sources.items()):
        try:
            df = read_csv(spark, f"{folder}/{name}")
        except AnalysisException:
            if strict:
                raise
            continue
        if not set(REQUIRED) <= set(df.columns):
            if strict:
                raise ValueError(f"{name} lacks one of {REQUIRED}")
            continue
        here = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in CSV_COLUMNS]
        found.append(df.select(*here, F.lit(owner).alias("owner"), F.lit(at).alias("file_idx"), F.monotonically_increasing_id().alias("row_idx")))
    return reduce(DataFrame.unionByName, found) if found else None


def read_placemarks(spark: SparkSession, path: str) -> DataFrame:
    """(name, lat, lon, place_idx) of KML placemarks with at least two coordinates.

    Of one name the last one's coordinates win; ``place_idx`` is where the name
    comes first in the file.
    """
    schema = "name string, Point struct<coordinates: string>, LineString struct<coordinates: string>"
    marks = spark.read.format("xml").option("rowTag", "Placemark").schema(schema).load(path)
    parts = F.split(F.trim(F.coalesce("Point.coordinates", "LineString.coordinates")), ",")
    named = marks.select(F.regexp_replace("name", r"^\s+|\s+$", "").alias("name"), parts.alias("parts"), F.monotonically_increasing_id().alias("at"))
    places = named.filter("name is not null and size(parts) >= 2").select(
        "name", F.round(to_float(F.get("parts", F.lit(1))), 6).alias("lat"), F.round(to_float(F.get("parts", F.lit(0))), 6).alias("lon"), "at"
    )
    first = places.groupBy("name").agg(F.min("at").alias("place_idx"))
    return last_wins(places, ["name"], F.col("at")).drop("at").join(first, "name")


def read_script_json(spark: SparkSession, path: str, name: str, schema: T.DataType | str) -> DataFrame:
    """The JSON value assigned to ``name`` in a script file, by a declared schema; NaN becomes null.

    An array gives one row for each element, an object one row; an object declared as
    a map gives (key, value) of each member.
    """
    text = spark.read.text(path, wholetext=True).select(F.regexp_extract("value", rf"(?s)\b{name}\s*=\s*([\[{{].*?[\]}}])\s*;", 1).alias("json"))
    clean = F.regexp_replace("json", r"(?<=[:\[,])\s*NaN\b", "null")
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if isinstance(kind, T.MapType):
        return text.select(F.explode(F.from_json(clean, kind)).alias("key", "value"))
    if isinstance(kind, T.ArrayType):
        return text.select(F.explode(F.from_json(clean, kind)).alias("row")).select("row.*")
    return text.select(F.from_json(clean, kind).alias("row")).select("row.*")


# ---- sinks


def without_nan(df: DataFrame) -> DataFrame:
    kinds = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*(F.when(~F.isnan(c), F.col(c)).alias(c) if c in kinds else F.col(c) for c in df.columns))


def json_entries(df: DataFrame, key: str, value: Column, *also: str) -> DataFrame:
    """One line ``"key":value`` for each row, compact: the distributed form of one large object; with the columns ``also``."""
    quoted = F.expr(f"substring(to_json(array({key})), 2, length(to_json(array({key}))) - 2)")
    return df.select(F.concat(quoted, F.lit(":"), F.to_json(value, {"ignoreNullFields": "false"})).alias("value"), *also)


def as_list(values: Sequence[Column]) -> Column:
    """A JSON array of values of several kinds, by place; missing ones as null."""
    parts = [F.regexp_replace(F.to_json(F.array(v)), r"^\[|\]$", "") for v in values]
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def list_entries(df: DataFrame, key: str, json: Column) -> DataFrame:
    """As :func:`json_entries`, for a value that is JSON text already."""
    quoted = F.expr(f"substring(to_json(array({key})), 2, length(to_json(array({key}))) - 2)")
    return df.select(F.concat(quoted, F.lit(":"), json).alias("value"))


def write_entries(entries: DataFrame, path: str) -> None:
    """Entries as text files, one member of the object a line; no task holds them all."""
    entries.write.mode("overwrite").text(path)


def write_object(entries: DataFrame, path: str) -> None:
    """Entries, whose keys are distinct, as one JSON object over files that follow each other: ``cat path/part-*`` is valid.

    A range partitioning by entry puts the opening brace before all members and the
    closing one after them; every member but the first begins with a comma.  Spark's
    commit lets all files appear, or none.  The driver sees the first entry only.
    """
    spark = entries.sparkSession
    first = entries.agg(F.min("value")).first()[0]
    members = entries.select(F.lit(1).alias("_at"), "value", F.when(F.col("value") == first, F.col("value")).otherwise(F.concat(F.lit(","), "value")).alias("_line"))
    braces = spark.createDataFrame([(0, None, "{"), (2, None, "}")], members.schema)
    # few rows may fall into one partition, but never out of order
    members.unionByName(braces).repartitionByRange("_at", "value").sortWithinPartitions("_at", "value").select("_line").write.mode("overwrite").text(path)


def one_object(entries: DataFrame, first: str = "") -> DataFrame:
    """One row with the whole object, in key order: only for results that fit one value."""
    lead = F.lit(f"{first}," if first else "")
    return entries.agg(F.concat(F.lit("{"), lead, F.array_join(F.sort_array(F.collect_list("value")), ","), F.lit("}")).alias("value"))


def as_script(json: DataFrame, name: str) -> DataFrame:
    """``window.NAME = {...};`` for each row."""
    return json.select(F.concat(F.lit(f"window.{name} = "), "value", F.lit(";")).alias("value"))


def write_csv(df: DataFrame, path: str, order: Sequence[Column], dates: Sequence[str] = ()) -> None:
    """Sorted CSV with a header and ISO days; Spark writes no byte-order mark."""
    shown = df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dates})
    shown.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)
