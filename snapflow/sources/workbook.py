"""Workbook feeds (S4, P10): sheet 0 of each ``.xlsx`` file, row 0 as header.

Workbooks are not splittable, so the unit of parallelism is the file: ``binaryFile`` makes one
row per workbook and ``mapInArrow`` parses each, giving rows away as it reads, with the standard library (``zipfile`` +
``ElementTree``: shared strings, inline strings, numbers, booleans and date-formatted cells).
Date cells are emitted as ISO dates using the workbook's own date system (1900 or 1904 mode,
time of day dropped, P10).  Every value is text, so the result is a staging table; the header
decides which output column a cell feeds (P9), an unknown header is an error.
"""

from __future__ import annotations

from array import array
import datetime as _dt
import re
import zipfile
import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}
# Built-in number-format ids that display dates.
_DATE_FMT_IDS = set(range(14, 23)) | set(range(45, 48))
_EPOCH_1900 = _dt.date(1899, 12, 30)
_EPOCH_1904 = _dt.date(1904, 1, 1)


_ROW, _CELL, _VAL, _INLINE, _T, _ITEM, _DATA = (f"{{{_NS['m']}}}{t}" for t in ("row", "c", "v", "is", "t", "si", "sheetData"))
_WHOLE = re.compile(r"-?\d+\.0")
_COLS: dict[str, int] = {}


def _col_index(ref: str) -> int:
    letters = ref.rstrip("0123456789")
    n = _COLS.get(letters)
    if n is None:
        n = 0
        for ch in letters:
            n = n * 26 + (ord(ch) - 64)
        n = _COLS.setdefault(letters, n - 1)
    return n


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(_T))


class SharedStrings:
    """The table of a workbook's texts as one buffer and its offsets: no object a text, and the XML
    tree is dropped as it is read."""

    def __init__(self):
        self.data, self.ends = bytearray(), array("Q")

    def read(self, stream) -> None:
        root = None
        for event, el in ET.iterparse(stream, events=("start", "end")):
            if root is None:
                root = el
            if event == "end" and el.tag == _ITEM:
                self.data += _text(el).encode("utf-8", "surrogatepass")
                self.ends.append(len(self.data))
                root.clear()

    def text(self, i: int) -> str:
        return self.data[self.ends[i - 1] if i else 0:self.ends[i]].decode("utf-8", "surrogatepass")


def parse_workbook(content):
    """Yield rows (lists of text or None) of sheet 0; date cells as ISO dates."""
    with zipfile.ZipFile(pa.BufferReader(content)) as zf:
        names = set(zf.namelist())
        wb = ET.fromstring(zf.read("xl/workbook.xml"))
        pr = wb.find("m:workbookPr", _NS)
        date1904 = pr is not None and pr.get("date1904") in ("1", "true")
        first = wb.find("m:sheets/m:sheet", _NS)
        rid = first.get(f"{{{_NS['r']}}}id")
        sheet_path = "xl/worksheets/sheet1.xml"
        if "xl/_rels/workbook.xml.rels" in names:
            rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
            for rel in rels.findall("pr:Relationship", _NS):
                if rel.get("Id") == rid:
                    tgt = rel.get("Target").lstrip("/")
                    sheet_path = tgt if tgt.startswith("xl/") else "xl/" + tgt
        shared = SharedStrings()
        if "xl/sharedStrings.xml" in names:
            with zf.open("xl/sharedStrings.xml") as fh:
                shared.read(fh)
        date_styles = set()
        if "xl/styles.xml" in names:
            st = ET.fromstring(zf.read("xl/styles.xml"))
            custom = {}
            for nf in st.findall("m:numFmts/m:numFmt", _NS):
                code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", nf.get("formatCode", "")).lower()
                custom[int(nf.get("numFmtId"))] = bool(re.search(r"[dmy]", code))
            for i, xf in enumerate(st.findall("m:cellXfs/m:xf", _NS)):
                fid = int(xf.get("numFmtId", "0"))
                if fid in _DATE_FMT_IDS or custom.get(fid, False):
                    date_styles.add(i)
        epoch = _EPOCH_1904 if date1904 else _EPOCH_1900
        # stream the sheet: each row element is cleared once read, so memory stays bounded by
        # one row however large the sheet is
        with zf.open(sheet_path) as fh:
            sheet = None
            for event, row in ET.iterparse(fh, events=("start", "end")):
                if event == "start":
                    sheet = row if row.tag == _DATA else sheet
                    continue
                if row.tag != _ROW:
                    continue
                vals = {}
                nxt = 0
                for c in row:
                    if c.tag != _CELL:
                        continue
                    ref = c.get("r")
                    idx = _col_index(ref) if ref else nxt
                    nxt = idx + 1
                    v = inline = None
                    for ch in c:
                        if ch.tag == _VAL:
                            v = ch.text
                        elif ch.tag == _INLINE:
                            inline = _text(ch)
                    t = c.get("t", "n")
                    if t == "s":
                        val = shared.text(int(v)) if v is not None else None
                    elif t == "inlineStr":
                        val = inline
                    elif t == "b":
                        val = None if v is None else ("1" if v == "1" else "0")
                    elif v is None:
                        val = None
                    elif t == "n" and int(c.get("s", "0")) in date_styles:
                        val = (epoch + _dt.timedelta(days=int(float(v)))).isoformat()
                    else:
                        val = v
                        if t == "n" and _WHOLE.fullmatch(val):
                            val = val[:-2]
                    vals[idx] = val
                row.clear()
                if sheet is not None:
                    sheet.clear()                # the emptied row elements too
                width = max(vals) + 1 if vals else 0
                yield [vals.get(i) for i in range(width)]


def _parser(columns, rows: int = 5000):
    names = ["path", "row_no", *columns]
    types = [pa.string(), pa.int64(), *[pa.string()] * len(columns)]

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    def run(batches):
        """At most ``rows`` rows are held, however many workbooks a batch has and however long they are."""
        for batch in batches:
            for i in range(batch.num_rows):
                path = batch.column("path")[i].as_py()
                parsed = parse_workbook(batch.column("content")[i].as_buffer())
                header = next(parsed, None)
                if header is None:
                    continue
                header = [(h or "").strip() for h in header]
                unknown = [h for h in header if h and h not in columns]
                if unknown:
                    raise ValueError(f"{path}: unknown columns {unknown}")
                pos = {h: i for i, h in enumerate(header) if h}
                out = []
                for n, r in enumerate(parsed, start=1):
                    if any(x not in (None, "") for x in r):
                        out.append([path, n] + [r[pos[c]] if c in pos and pos[c] < len(r) else None for c in columns])
                    if len(out) == rows:
                        yield batch_of(out)
                        out = []
                if out:
                    yield batch_of(out)
    return run


def read_workbooks(spark: SparkSession, path: str, columns, as_of: str | None = None,
                   strip: bool = True) -> DataFrame:
    """All workbooks under ``path`` (file, folder or glob) as one all-text staging frame with
    the lineage columns ``date_ingested`` and ``FileName`` (P5)."""
    schema = T.StructType([T.StructField("path", T.StringType()),
                           T.StructField("row_no", T.LongType())]
                          + [T.StructField(c, T.StringType()) for c in columns])
    books = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    rows = books.select("path", "content").mapInArrow(_parser(list(columns)), schema)
    if strip:
        from snapflow.operators.clean import strip_values
        rows = strip_values(rows, columns)
    rows = rows.withColumn("FileName", F.element_at(F.split("path", "/"), -1))
    if as_of is not None:
        rows = rows.withColumn("date_ingested", F.lit(as_of).cast(T.TimestampNTZType()))
    return rows.drop("path", "row_no")
