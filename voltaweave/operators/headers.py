"""Finding a sheet's columns by what its header cells say.

Bronze rows have (sheet, row_idx from 1, cells array<string>).  A rule names a
field, the header rows to search in order, a condition on the cell's text, and
whether the first or the last cell that fits wins; fallbacks are further rules
of the same field with a higher priority number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    field: str
    fits: Callable[[Column], Column]
    rows: Sequence[int]
    last: bool = False
    priority: int = 0


def resolve_columns(bronze: DataFrame, rules: Sequence[Rule], clean: Callable[[Column], Column]) -> DataFrame:
    """(sheet, field, row_idx, pos) of each field that a sheet has; pos counts from 0.

    Within a rule, rows go in the order the rule lists them, then cells from
    left to right.
    """
    wanted = sorted({r for rule in rules for r in rule.rows})
    cells = bronze.filter(F.col("row_idx").isin(*wanted)).select("sheet", "row_idx", F.posexplode("cells").alias("pos", "cell"))
    cells = cells.withColumn("text", clean(F.col("cell")))
    found = []
    for rule in rules:
        at = F.array_position(F.array(*map(F.lit, rule.rows)), F.col("row_idx"))
        place = F.struct((F.lit(1_000_000) - at if rule.last else at).alias("a"), (-F.col("pos") if rule.last else F.col("pos")).alias("b"))
        fits = F.col("row_idx").isin(*rule.rows) & F.col("cell").isNotNull() & rule.fits(F.col("text"))
        found.append(F.when(fits, F.struct(F.lit(rule.field).alias("field"), F.lit(rule.priority).alias("priority"), place.alias("place"))))
    hits = cells.select("sheet", "row_idx", "pos", F.explode(F.array(*found)).alias("hit")).filter("hit is not null")
    return (
        hits.groupBy("sheet", F.col("hit.field").alias("field"))
        .agg(F.min_by(F.struct("row_idx", "pos"), F.struct("hit.priority", "hit.place")).alias("best"))
        .select("sheet", "field", "best.row_idx", "best.pos")
    )


def by_sheet(resolved: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row for each sheet: the position of each field, and the header's last row."""
    return resolved.groupBy("sheet").agg(
        *(F.max(F.when(F.col("field") == f, F.col("pos"))).alias(f"{f}_pos") for f in fields),
        F.max("row_idx").alias("header_end"),
    )


def cell(name: str) -> Column:
    """The cell at the resolved position ``<name>_pos``, or null beyond the row's end."""
    return F.get("cells", F.col(f"{name}_pos"))


# The header phrases of the four kinds of sheets, and the rows in which they are looked for.
def _available(text: Column) -> Column:
    return text.contains("mpe rdd") & ~text.contains("mges") & ~text.contains("no conectado")


EIGHT = tuple(range(1, 9))
#: Distribution sheets: row 5 is searched first, row 4 only if row 5 has nothing.
DSO_RULES = [Rule("rdd", lambda t: t.contains("Capacidad de acceso disponible para MPE RdD"), (5, 4))]
REE_RULES = [Rule("rdd", _available, EIGHT)]
MAP_RULES = [
    Rule("name", lambda t: t.contains("nombre y tensi"), EIGHT),
    Rule("rdd", _available, EIGHT),
    Rule("rdd", lambda t: t.contains("capacidad de acceso disponible para mpe") & ~t.contains("rdt"), EIGHT, priority=1),
    Rule("tram", lambda t: t.contains("capacidad de acceso solicitada") & F.rtrim(F.replace(t, F.lit("[mw]"), F.lit(""))).endswith("resolver mpe"), EIGHT),
]
TIDY_RULES = [
    Rule("name", lambda t: t.contains("nombre y tens"), (4,)),
    Rule("ccaa", lambda t: t.contains("comunidad aut"), (4,)),
    Rule("disp", lambda t: t.contains("disponible para mpe rdt") | t.rlike(r"^mpe rdt\s*\[mw\]$"), (4,)),
    Rule("sol", lambda t: t.contains("solicitad") & t.endswith(" mpe"), (4,), last=True),
    Rule("sol", lambda t: t.contains("solicitad"), (4,), last=True, priority=1),
    Rule("otorg", lambda t: t.contains("otorgad") & t.rlike(r"otorgada mpe$"), (4,), last=True),
    Rule("otorg", lambda t: t.contains("otorgad") & t.rlike(r"otorgada para mpe\s*\[mw\]"), (4,), priority=1),
    Rule("otorg", lambda t: t.contains("otorgad"), (4,), last=True, priority=2),
]
