"""Workbooks against a plain reader of whole files."""

import io
import random
import zipfile
from xml.etree import ElementTree

import pytest

from voltaweave.sources import xlsx

MAIN, REL = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def plain(data):
    """(sheet, sheet_idx, row_idx, cells), each sheet parsed as one document."""
    _MAIN, out = f"{{{MAIN}}}", []
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared = dict(enumerate(xlsx._shared(book)))
        dates = xlsx._date_styles(book)
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for at, sheet in enumerate(ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")):
            rows = []
            for i, row in enumerate(ElementTree.fromstring(book.read("xl/" + targets[sheet.get(f"{{{REL}}}id")])).iter(f"{_MAIN}row"), 1):
                cells = {}
                for j, cell in enumerate(row.iter(f"{_MAIN}c")):
                    cells[xlsx._column(cell.get("r")) if cell.get("r") else j] = xlsx._text(cell, shared, dates)
                rows.append((int(row.get("r", i)), cells))
            width = max((max(c) + 1 for _, c in rows if c), default=0)
            out += [(sheet.get("name"), at, n, [c.get(j) for j in range(width)]) for n, c in rows]
    return out


def workbook(seed, prefix="", sheets=3, rows=200):
    rng, p = random.Random(seed), f"{prefix}:" if prefix else ""
    strings = ["", "uno & <dos>", "Tensión\n(kV)", "x" * 300, "</row>", *(f"s{i}" for i in range(50))]
    escaped = lambda s: s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")

    def cell(n, col):
        ref = f' r="{col}{n}"' if rng.random() < 0.9 else ""
        kind = rng.randint(0, 6)
        if kind == 0:
            return f'<{p}c{ref} t="s"><{p}v>{rng.randrange(len(strings))}</{p}v></{p}c>'
        if kind == 1:
            return f'<{p}c{ref} t="s" s="0"><{p}f>A1</{p}f><{p}v> {rng.randrange(len(strings))} </{p}v></{p}c>'
        if kind == 2:
            return f'<{p}c{ref} t="inlineStr"><{p}is><{p}t>{escaped(rng.choice(strings))}</{p}t></{p}is></{p}c>'
        if kind == 3:
            return f'<{p}c{ref} s="1"><{p}v>{rng.randint(40000, 46000)}</{p}v></{p}c>'
        if kind == 4:
            return f"<{p}c{ref}/>"
        if kind == 5:
            return f'<{p}c{ref} t="e"><{p}v>#N/A</{p}v></{p}c>'
        return f"<{p}c{ref}><{p}v>{rng.random()}</{p}v></{p}c>"

    def row(n):
        number = f' r="{n}"' if rng.random() < 0.8 else ""
        if rng.random() < 0.1:
            return f"<{p}row{number}/>"
        return f"<{p}row{number} spans=\"1:5\">" + "".join(cell(n, c) for c in rng.sample(["A", "B", "C", "D", "AA", "BZ"], rng.randint(0, 4))) + f"</{p}row>"

    xmlns = f'xmlns:{prefix}="{MAIN}"' if prefix else f'xmlns="{MAIN}"'
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        names = "".join(f'<sheet name="S{i} é" sheetId="{i}" r:id="r{i}"/>' for i in range(sheets))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(sheets)) + "</Relationships>")
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">' + "".join(f"<si><t>{escaped(x)}</t></si>" for x in strings) + "</sst>")
        for i in range(sheets):
            n = 0 if i == 1 else rows
            body = "".join(row(k + 1) for k in range(n))
            z.writestr(f"xl/worksheets/s{i}.xml", f'<?xml version="1.0"?><{p}worksheet {xmlns}><{p}dimension ref="A1"/><{p}sheetData>{body}</{p}sheetData><{p}rowBreaks count="0"/></{p}worksheet>')
    return data.getvalue()


@pytest.mark.parametrize(("prefix", "size"), [("", 7), ("x", 64), ("", 20_000)])
def test_workbooks(spark, tmp_path, prefix, size):
    books = {f"b{i}.xlsx": workbook(i, prefix, rows=150 + 90 * i) for i in range(3)}
    for name, data in books.items():
        (tmp_path / name).write_bytes(data + (b"\n" if name == "b1.xlsx" else b""))
    got = [tuple(r) for r in xlsx.load(spark, str(tmp_path), rows=size).collect()]
    want = [(name, *row) for name, data in books.items() for row in plain(data)]
    assert sorted(got, key=str) == sorted(want, key=str) and len({r[1] for r in got}) == 2


def test_long_sheets_are_read_in_blocks(spark, tmp_path):
    data = workbook(9, rows=30_000, sheets=1)
    (tmp_path / "long.xlsx").write_bytes(data)
    df = xlsx.load(spark, str(tmp_path), rows=5000)
    got = [tuple(r)[1:] for r in df.collect()]
    assert sorted(got, key=str) == sorted(plain(data), key=str)
