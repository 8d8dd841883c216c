"""Packing flat sales rows into XLSX workbooks, to check the reader on any table."""

from __future__ import annotations

import datetime as dt
import io
import zipfile
from collections.abc import Iterator
from decimal import Decimal
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

ROWS_PER_BOOK = 20_000
EPOCH_DAYS = (dt.date(1970, 1, 1) - dt.date(1899, 12, 30)).days  # the format counts from there
NAMESPACE = "http://schemas.openxmlformats.org"
SHEET = f"{NAMESPACE}/spreadsheetml/2006/main"
OFFICE = f"{NAMESPACE}/officeDocument/2006/relationships"
ITEM = '<si><t xml:space="preserve">'
PARTS = {
    "xl/workbook.xml": (
        f'<workbook xmlns="{SHEET}" xmlns:r="{OFFICE}"><sheets>'
        '<sheet name="Sales" sheetId="1" r:id="rId7"/></sheets></workbook>'
    ),
    "xl/_rels/workbook.xml.rels": (
        f'<Relationships xmlns="{NAMESPACE}/package/2006/relationships"><Relationship Id="rId7" '
        f'Type="{OFFICE}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>'
    ),
    "xl/styles.xml": (
        f'<styleSheet xmlns="{SHEET}"><cellXfs count="2"><xf numFmtId="0"/>'
        '<xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>'
    ),
}


def pack_workbooks(flat: DataFrame) -> DataFrame:
    """(path, content) rows, one workbook per 20,000 rows of a partition."""
    return flat.mapInArrow(_pack, "path string, content binary")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_PER_BOOK):
            content = _packed(batch.slice(start, ROWS_PER_BOOK))
            yield pa.record_batch({"path": ["memory.xlsx"], "content": pa.array([content], pa.binary())})


def _packed(rows: pa.RecordBatch) -> bytes:
    """The workbook of a batch, a column of cells at a time."""
    texts: dict[str, int] = {}
    header = _line(rows.schema.names, texts)
    shared, columns = [pa.array(texts, pa.string())], []
    for column in rows.columns:
        opening = "<c><v>"
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            column = column.dictionary_encode()
            numbers = pc.add(column.indices.cast(pa.int64()), sum(map(len, shared)))
            shared.append(column.dictionary.cast(pa.string()))
            opening = '<c t="s"><v>'
        elif pa.types.is_date32(column.type):
            numbers = pc.add(column.cast(pa.int32()).cast(pa.int64()), EPOCH_DAYS)
            opening = '<c s="1"><v>'
        else:
            numbers = column if pa.types.is_decimal(column.type) else column.cast(pa.int64())
        cells = pc.binary_join_element_wise(opening, numbers.cast(pa.string()), "</v></c>", "")
        columns.append(cells.fill_null("<c/>"))
    lines = pc.binary_join_element_wise("<row>", *columns, "</row>", "")
    listed = pa.concat_arrays(shared)
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        listed = pc.replace_substring(listed, plain, escaped)
    listed = pc.binary_join_element_wise(ITEM, listed, "</t></si>", "")
    return _book(header + _joined(lines), _joined(listed))


def _joined(texts: pa.Array) -> str:
    return pc.binary_join(pa.ListArray.from_arrays([0, len(texts)], texts), "")[0].as_py()


def workbook(header: list[str], rows) -> bytes:
    texts: dict[str, int] = {}
    lines = [_line(header, texts), *(_line(r, texts) for r in rows)]
    return _book("".join(lines), "".join([f"{ITEM}{escape(t)}</t></si>" for t in texts]))


def _book(lines: str, shared: str) -> bytes:
    parts = {
        **PARTS,
        "xl/sharedStrings.xml": f'<sst xmlns="{SHEET}">{shared}</sst>',
        "xl/worksheets/sheet1.xml": (
            f'<worksheet xmlns="{SHEET}"><sheetData>{lines}</sheetData></worksheet>'
        ),
    }
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return target.getvalue()


def _line(values, texts: dict[str, int]) -> str:
    return f"<row>{''.join(_cell(v, texts) for v in values)}</row>"


def _cell(value, texts: dict[str, int]) -> str:
    if value is None or value != value:
        return "<c/>"
    if isinstance(value, str):
        return f'<c t="s"><v>{texts.setdefault(value, len(texts))}</v></c>'
    if isinstance(value, dt.date):
        return f'<c s="1"><v>{(value - dt.date(1899, 12, 30)).days}</v></c>'
    return f"<c><v>{value if isinstance(value, Decimal) else int(value)}</v></c>"
