"""Minimal .xlsx writer for fixtures (no spreadsheet library is installed)."""

import datetime as dt
import zipfile
from xml.sax.saxutils import escape


def _ref(r, c):
    s = ""
    c += 1
    while c:
        c, rem = divmod(c - 1, 26)
        s = chr(65 + rem) + s
    return f"{s}{r + 1}"


def write_xlsx(path, header, rows, date1904=False):
    epoch = dt.date(1904, 1, 1) if date1904 else dt.date(1899, 12, 30)
    out = []
    for r, row in enumerate([header] + rows):
        cells = []
        for c, v in enumerate(row):
            if v is None:
                continue
            ref = _ref(r, c)
            if isinstance(v, dt.date):
                serial = (v - epoch).days + 0.25          # a time of day that must be dropped
                cells.append(f'<c r="{ref}" s="1"><v>{serial}</v></c>')
            elif isinstance(v, (int, float)):
                cells.append(f'<c r="{ref}"><v>{v}</v></c>')
            else:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>')
        out.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml",
                   f'<workbook {ns} {rns}><workbookPr date1904="{1 if date1904 else 0}"/>'
                   f'<sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="worksheet" Target="worksheets/sheet1.xml"/>'
                   '</Relationships>')
        z.writestr("xl/styles.xml",
                   f'<styleSheet {ns}><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/>'
                   f'</cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml",
                   f'<worksheet {ns}><sheetData>{"".join(out)}</sheetData></worksheet>')
