"""Bronze cells from XLSX workbooks, a run of rows a task, with the standard library only."""

from __future__ import annotations

import io
import itertools
import json
import re
import sys
import zipfile
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from .bronze import SCHEMA

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Built-in number formats that are dates.
DATE_FORMATS = {*range(14, 23), *range(45, 48)}


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{_MAIN}numFmt")}
    made = {i for i, code in own.items() if re.search("[ymdh]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", code.lower()))}
    cells = root.find(f"{_MAIN}cellXfs")
    return {i for i, x in enumerate(cells if cells is not None else []) if int(x.get("numFmtId", 0)) in DATE_FORMATS | made}


def _text(cell, shared: dict[int, str], dates: set[int]) -> str | None:
    kind, value = cell.get("t", "n"), cell.find(f"{_MAIN}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    if value is None or value.text is None:
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "e":
        return None
    if kind == "n" and int(cell.get("s", 0)) in dates:
        return (datetime(1899, 12, 30) + timedelta(days=float(value.text))).isoformat(sep=" ", timespec="seconds")
    return value.text


def _shared(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in s.iter(f"{_MAIN}t")) for s in root.iter(f"{_MAIN}si")]


_ROW = re.compile(rb"<(?:\w+:)?row\b[^>]*?/>|<(?:\w+:)?row\b.*?</(?:\w+:)?row>", re.S)
_CELL = re.compile(rb"<(?:\w+:)?c\b([^>]*)")
_REF = re.compile(rb'\br="([A-Z]+)')
_INDEX = re.compile(rb'<(?:\w+:)?c\b[^>]*?\bt="s"[^>]*>(?:(?!</(?:\w+:)?c>).)*?<(?:\w+:)?v[^>]*>\s*(\d+)', re.S)


def _rows(book: zipfile.ZipFile, path: str) -> Iterator[tuple[bytes, bytes]]:
    """(opening tag of the sheet, text of a row) of each row, a block of the file at a time."""
    held, opening = b"", b""
    with book.open(path) as f:
        while True:
            block = f.read(1 << 20)
            held += block
            if not opening and (m := re.search(rb"<(?:\w+:)?worksheet\b[^>]*>", held)):
                opening = m[0]
            end = held.rfind(b"row>") + 4 if block else len(held)
            if end > 3:
                for row in _ROW.finditer(held, 0, end):
                    yield opening, row[0]
                held = held[end:]
            if not block:
                return


def _width(row: bytes) -> int:
    refs = [(j, _REF.search(attributes)) for j, attributes in enumerate(_CELL.findall(row))]
    return max((_column(m[1].decode()) + 1 if m else j + 1 for j, m in refs), default=0)


def pieces(data: bytes, size: int) -> Iterator[tuple]:
    """(sheet, sheet_idx, first row's number, width, xml, strings, dates) of runs of ``size`` rows of each sheet.

    A sheet is read twice, block by block: for its width, then for its rows.  A run
    carries the shared strings that it names.
    """
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared, dates = _shared(book), sorted(_date_styles(book))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for at, sheet in enumerate(ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")):
            path = targets[sheet.get(f"{_REL}id")]
            path = path.lstrip("/") if path.startswith("/") else f"xl/{path}"
            width = max((_width(row) for _, row in _rows(book, path)), default=0)
            rows = _rows(book, path)
            first = 1
            while run := list(itertools.islice(rows, size)):
                opening = run[0][0]
                closing = b"</" + re.match(rb"<((?:\w+:)?worksheet)", opening)[1] + b">"
                body = b"".join(row for _, row in run)
                named = {int(i): shared[int(i)] for i in set(_INDEX.findall(body))}
                yield sheet.get("name"), at, first, width, zlib.compress(opening + body + closing, 1), zlib.compress(json.dumps(named).encode(), 1), dates
                first += len(run)


def cells_of(first: int, width: int, xml: bytes, strings: bytes, dates: list[int]) -> Iterator[tuple[int, list[str | None]]]:
    """(row_idx, cells) of the rows of a piece, cells padded to the sheet's width."""
    shared = {int(i): s for i, s in json.loads(zlib.decompress(strings)).items()}
    for i, row in enumerate(ElementTree.fromstring(zlib.decompress(xml)).iter(f"{_MAIN}row"), first):
        cells: dict[int, str | None] = {}
        for j, cell in enumerate(row.iter(f"{_MAIN}c")):
            cells[_column(cell.get("r")) if cell.get("r") else j] = _text(cell, shared, set(dates))
        yield int(row.get("r", i)), [cells.get(j) for j in range(width)]


PIECES = "workbook string, sheet string, sheet_idx int, first long, width int, xml binary, strings binary, dates array<int>"


def load(spark: SparkSession, *paths: str, rows: int = 20_000) -> DataFrame:
    """Bronze cells of all workbooks found under ``paths``, by any file system that Spark reads.

    A task opens a workbook and cuts its sheets into runs of ``rows`` rows, still
    text; these are shuffled, so that the sheets of one large workbook are parsed by many tasks.
    """

    def cut(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                for piece in pieces(bytes(content), rows):
                    yield pd.DataFrame([(path.rsplit("/", 1)[-1], *piece)], columns=[x.split()[0] for x in PIECES.split(", ")])

    def parse(batches):
        for pdf in batches:
            for workbook, sheet, sheet_idx, first, *piece in pdf.itertuples(index=False):
                found = [(workbook, sheet, sheet_idx, *row) for row in cells_of(first, *piece)]
                yield pd.DataFrame(found, columns=["workbook", "sheet", "sheet_idx", "row_idx", "cells"])

    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    return files.mapInPandas(cut, PIECES).repartition("workbook", "sheet_idx", "first").mapInPandas(parse, SCHEMA)
