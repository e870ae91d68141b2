"""Small .xlsx files for tests."""

from __future__ import annotations

import os
import zipfile
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATION = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def write_workbook(path: str, rows: list[tuple], target: str = "worksheets/sheet1.xml") -> None:
    """Text goes to the shared strings, numbers stand in their cells, None leaves a gap."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    strings: list[str] = []
    lines = []
    for n, row in enumerate(rows, start=1):
        cells = []
        for place, value in enumerate(row):
            letters = chr(ord("A") + place) if place < 26 else "A" + chr(ord("A") + place - 26)
            if value is None:
                continue
            if isinstance(value, str):
                cells.append(f'<c r="{letters}{n}" t="s"><v>{len(strings)}</v></c>')
                strings.append(value)
            else:
                cells.append(f'<c r="{letters}{n}"><v>{value}</v></c>')
        lines.append(f'<row r="{n}">{"".join(cells)}</row>')
    shared = "".join(f"<si><r><t>{escape(s[:1])}</t></r><r><t>{escape(s[1:])}</t></r></si>" for s in strings)
    with zipfile.ZipFile(path, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{RELATION}"><sheets><sheet name="F" sheetId="1" r:id="r7"/>'
            '<sheet name="G" sheetId="2" r:id="r8"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{PACKAGE}"><Relationship Id="r8" Target="worksheets/sheet2.xml"/>'
            f'<Relationship Id="r7" Target="{target}"/></Relationships>',
        )
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{shared}</sst>')
        book.writestr(
            "xl/worksheets/sheet1.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>'
        )
