"""Bronze cells of spreadsheets, and what sheet names say.

Bronze has one row for each sheet row: workbook, sheet, sheet_idx (place in the
workbook), row_idx from 1, and cells, all text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import month_inside, month_number, stripped

SCHEMA = "workbook string, sheet string, sheet_idx int, row_idx int, cells array<string>"

# The three patterns of sheet names below, and the columns of the two kinds of sheets that plans name by place.


def monthly_sheet(name: Column) -> list[Column]:
    """kind (DSO or REE), year and month of a sheet named like ``DSO Oct25``, else nulls."""
    part = lambda i: F.regexp_extract(stripped(name), r"(?i)^(DSO|REE)\s+([A-Za-z]+)(\d{2})$", i)
    month = month_number(F.substring(F.lower(part(2)), 1, 3), 3)
    there = (part(1) != "") & month.isNotNull()
    return [
        F.when(there, F.upper(part(1))).alias("kind"),
        F.when(there, 2000 + part(3).try_cast("int")).alias("year"),
        F.when(there, month).alias("month"),
    ]


def dated_sheet(name: Column) -> Column:
    """The day of a sheet whose name starts like ``20 junio 2022``, else null."""
    part = lambda i: F.regexp_extract(stripped(name), r"(?U)^(\d{1,2})\s+(\w+)\s+(\d{4})", i)
    month = month_number(F.lower(part(2)))
    text = F.format_string("%s-%02d-%02d", part(3), month, part(1).try_cast("int"))
    return F.when((part(1) != "") & month.isNotNull(), text)


def map_sheet(name: Column) -> list[Column]:
    """year and month of a sheet whose name holds a full month name and a year from 2010 on, else nulls."""
    year = F.regexp_extract(name, r"(202[0-9]|201[0-9])", 1).try_cast("int")
    month = month_inside(stripped(name))
    there = year.isNotNull() & month.isNotNull()
    return [F.when(there, year).alias("year"), F.when(there, month).alias("month")]
