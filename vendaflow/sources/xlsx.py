"""XLSX workbooks, one task per workbook."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vendaflow.errors import SourceError
from vendaflow.operators.staging import canonical_headers, require_columns
from vendaflow.schema import CANONICAL

# Fixed values of the file format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"
DATE_FORMAT_IDS = {*range(14, 23), *range(45, 48)}
EPOCH_1900 = dt.datetime(1899, 12, 30)
EPOCH_1904 = dt.datetime(1904, 1, 1)

BATCH = 10_000
BATCH_BYTES = 16 * 1024 * 1024  # of workbooks handed to a worker at once; by default it is all of a task's
READ_BYTES = 1 << 20
LONGEST_HEAD = 1 << 22
KNOWN_CELLS = 100_000  # different cells whose texts are remembered while a sheet is read
ROW_SCHEMA = ", ".join(f"{c} string" for c in CANONICAL)

# Cells and rows as nearly every program writes them; whatever looks otherwise is left to the XML parser.
PLAIN_ROW = re.compile(r"\s*<row(?:\s[^<>]*)?(?<!/)>\s*").fullmatch
PLAIN_CELL = re.compile(
    r'(?: s="(\d+)")?(?: t="([a-zA-Z]+)")?\s*(?:/>|>(?:<v>([^<&\x00-\x1f]*)</v>)?</c>)\s*'
).fullmatch
PLACED = re.compile(r' r="([A-Za-z]+)[0-9]*"').match
PLAIN_TEXT = re.compile(r'\s*<si>\s*<t(?: xml:space="preserve")?>([^<&\x00-\x08\x0b-\x1f]*)</t>\s*').fullmatch
PLAIN_DECLARATION = re.compile(r"(<\?xml((?!encoding)[^<>])*(encoding=[\"']utf-8[\"'][^<>]*)?\?>)?\s*", re.IGNORECASE).fullmatch


class _NotPlain(Exception):
    """A part of a workbook has to be read by the XML parser."""


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """The 21 canonical columns, as texts, from the first sheet of each workbook."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return parse_workbooks(files)


def parse_workbooks(files: DataFrame) -> DataFrame:
    """Rows of workbooks given as (path, content). A sheet holds at most 1,048,576 rows."""
    files.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return files.select("path", "content").mapInArrow(_parse, ROW_SCHEMA)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            yield from _workbook(path.as_py(), content.as_py())


def _batch(rows: list[list[str | None]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, pa.string()) for c in zip(*rows)], names=CANONICAL)


def _workbook(path: str, content: bytes) -> Iterator[pa.RecordBatch]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        sheet, epoch = _first_sheet(book)
        texts, dates = _shared_texts(book), _date_styles(book)
        rows = _rows(lambda: book.open(sheet), texts, dates, epoch)
        header = next(rows, {})
        places = sorted(header)
        names = canonical_headers([header[p] or "" for p in places])
        try:
            require_columns(names)
        except SourceError as missing:
            raise SourceError(f"{path}: {missing}") from None
        at = {n: p for n, p in zip(names, places) if n in CANONICAL}
        whole = [at.get(c) for c in CANONICAL]
        chunk: list[list[str | None]] = []
        for row in rows:
            if any(v is not None for v in row.values()):
                chunk.append(["0" if p is None else row.get(p) for p in whole])
            if len(chunk) == BATCH:
                yield _batch(chunk)
                chunk = []
        if chunk:
            yield _batch(chunk)


def _first_sheet(book: zipfile.ZipFile) -> tuple[str, dt.datetime]:
    workbook = ET.fromstring(book.read("xl/workbook.xml"))
    first = workbook.find(f"{MAIN}sheets/{MAIN}sheet")
    if first is None:
        raise SourceError("workbook without sheets")
    links = ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(
        r.get("Target") for r in links.iter(f"{PKG}Relationship")
        if r.get("Id") == first.get(f"{REL}id")
    )
    settings = workbook.find(f"{MAIN}workbookPr")
    old = settings is not None and settings.get("date1904") in ("1", "true")
    path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return path, EPOCH_1904 if old else EPOCH_1900


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    texts = []
    try:
        with book.open("xl/sharedStrings.xml") as stream:
            for head, piece in _pieces(stream, "si", "</sst>"):
                plain = PLAIN_TEXT(piece)
                if plain:
                    texts.append(plain[1])
                else:
                    texts += map(_text, _reparsed(f"{head}{piece}</si></sst>").iter(f"{MAIN}si"))
        return texts
    except _NotPlain:
        texts = []
    with book.open("xl/sharedStrings.xml") as stream:
        for _, node in ET.iterparse(stream):
            if node.tag == f"{MAIN}si":
                texts.append(_text(node))
                node.clear()
    return texts


def _text(node: ET.Element) -> str:
    """Plain text or joined rich-text runs; phonetic hints are left out."""
    parts = node.findall(f"{MAIN}t") + node.findall(f"{MAIN}r/{MAIN}t")
    return "".join(p.text or "" for p in parts)


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a serial number as a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    styles = ET.fromstring(book.read("xl/styles.xml"))
    date_ids = set(DATE_FORMAT_IDS)
    for custom in styles.iter(f"{MAIN}numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", custom.get("formatCode", ""))
        if re.search(r"[ymdhs]", code, re.IGNORECASE):
            date_ids.add(int(custom.get("numFmtId")))
    cells = styles.findall(f"{MAIN}cellXfs/{MAIN}xf")
    return {i for i, xf in enumerate(cells) if int(xf.get("numFmtId", "0")) in date_ids}


def _rows(opened: Callable, texts, dates, epoch) -> Iterator[dict[int, str | None]]:
    """Rows as {column number: text}, read one at a time. Plain rows are cut at their tags; the
    XML parser reads other rows and, if a sheet cannot be cut, all that is left of it."""
    done = 0
    try:
        with opened() as stream:
            for row in _cut_rows(stream, texts, dates, epoch):
                done += 1
                yield row
        return
    except _NotPlain:
        pass
    with opened() as stream:
        yield from islice(_parsed_rows(stream, texts, dates, epoch), done, None)


def _cut_rows(stream, texts, dates, epoch) -> Iterator[dict[int, str | None]]:
    known, columns, closing = {}, {}, "</sheetData></worksheet>"
    for head, piece in _pieces(stream, "row", closing):
        row = _plain_row(piece, known, columns, texts, dates, epoch)
        if row is not None:
            yield row
            continue
        for node in _reparsed(f"{head}{piece}</row>{closing}").iter(f"{MAIN}row"):
            yield _row(node, texts, dates, epoch)


def _reparsed(text: str) -> ET.Element:
    try:
        return ET.fromstring(text)
    except ET.ParseError:
        raise _NotPlain from None


def _pieces(stream, tag: str, closing: str) -> Iterator[tuple[str, str]]:
    """(what stands before the first, the element without its end tag) of each element `tag` in a
    list that `closing` ends, as texts, read a part at a time."""
    first, last = f"<{tag}".encode(), f"</{tag}>".encode()
    end = closing[: closing.index(">") + 1].encode()
    head, rest = None, b""
    while True:
        data = stream.read(READ_BYTES)
        if not data:
            raise _NotPlain  # no end of the list: the parser tells what is wrong
        rest += data
        if head is None:
            start = rest.find(first)
            if start < 0 and len(rest) > LONGEST_HEAD:
                raise _NotPlain
            if start < 0:
                continue
            head, rest = _plain_head(rest[:start], closing), rest[start:]
        ends = rest.find(end)
        cut = ends if ends >= 0 else rest.rfind(last) + len(last)
        if ends < 0 and cut < len(last):
            continue
        whole, rest = rest[:cut], rest[cut:]
        if any(mark in whole for mark in (b"<!", b"<?", b"xmlns")):
            raise _NotPlain
        try:
            found = whole.decode().split(last.decode())
        except UnicodeDecodeError:
            raise _NotPlain from None
        if found.pop().strip():
            raise _NotPlain
        for piece in found:
            yield head, piece
        if ends >= 0:
            return


def _plain_head(head: bytes, closing: str) -> str:
    """The tags before a list, if they are those of the format without a prefix."""
    try:
        text = head.decode("utf-8-sig")
        root = ET.fromstring(f"{text}{closing}".encode())
    except (UnicodeDecodeError, ET.ParseError, LookupError, ValueError):
        raise _NotPlain from None
    names = [f"{MAIN}{name}" for name in re.findall(r"\w+", closing)]
    tags = [root.tag, root[-1].tag if len(root) else None]
    opening = re.search(r"<[a-zA-Z]", text).start()
    if "<!" in text or not PLAIN_DECLARATION(text[:opening]) or tags[: len(names)] != names[::-1]:
        raise _NotPlain
    return text[opening:]


def _plain_row(piece: str, known: dict, columns: dict, texts, dates, epoch) -> dict[int, str | None] | None:
    """One row, of which `piece` is all but the end tag; None if it is not a plain one. `known`
    holds the texts of the cells seen before, by what stands in the file."""
    opening, *cells = piece.split("<c")
    if not PLAIN_ROW(opening):
        return None
    places: Iterable[int] = range(len(cells))
    if cells and cells[0].startswith(' r="'):
        placed = [PLACED(cell) for cell in cells]
        if None in placed:
            return None
        cells = [cell[found.end() :] for cell, found in zip(cells, placed)]
        letters = [found[1] for found in placed]
        for name in letters:
            if name not in columns:
                columns[name] = _column(name)
        places = [columns[name] for name in letters]
    if len(known) >= KNOWN_CELLS:
        known.clear()
    for cell in [c for c in cells if c not in known]:
        plain = PLAIN_CELL(cell)
        if plain is None or plain[2] == "inlineStr":
            return None
        style, kind, value = plain.groups()
        known[cell] = _shown(kind or "n", style or "0", value, texts, dates, epoch)
    return dict(zip(places, [known[c] for c in cells]))


def _parsed_rows(stream, texts, dates, epoch) -> Iterator[dict[int, str | None]]:
    parents: list[ET.Element] = []
    for event, node in ET.iterparse(stream, events=("start", "end")):
        if event == "start":
            parents.append(node)
            continue
        parents.pop()
        if node.tag != f"{MAIN}row":
            continue
        yield _row(node, texts, dates, epoch)
        parents[-1].remove(node)


def _row(node: ET.Element, texts, dates, epoch) -> dict[int, str | None]:
    row, place = {}, -1
    for cell in node.iter(f"{MAIN}c"):
        place = _column(cell.get("r")) if cell.get("r") else place + 1
        row[place] = _value(cell, texts, dates, epoch)
    return row


def _column(reference: str) -> int:
    """B7 -> 1"""
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - ord("A") + 1
    return number - 1


def _value(cell: ET.Element, texts, dates, epoch) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = cell.find(f"{MAIN}is")
        return None if inline is None else _text(inline)
    return _shown(kind, cell.get("s", "0"), cell.findtext(f"{MAIN}v"), texts, dates, epoch)


def _shown(kind: str, style: str, value: str | None, texts, dates, epoch) -> str | None:
    if value is None or kind == "e":
        return None
    if kind == "s":
        return texts[int(value)]
    if kind != "n":
        return value
    if int(style) in dates:
        moment = epoch + dt.timedelta(seconds=round(float(value) * 86_400))
        return moment.isoformat(sep=" ")
    number = float(value)
    return str(int(number)) if number.is_integer() else repr(number)
