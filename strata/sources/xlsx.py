"""Workbook (.xlsx) scan.

Spark has no workbook reader, so files are read with the built-in
``binaryFile`` source (any Hadoop file system, one row per file) and each
file is parsed inside a ``mapInPandas`` task with the standard library
(``zipfile`` + streaming XML). Files are spread over tasks; a single
workbook is one task because the zip container cannot be split.

Cells come back as text (numbers as written, dates as ``yyyy-MM-dd`` or
``yyyy-MM-dd HH:mm:ss``); apply a schema with ``strata.functions.conform``.
"""

from __future__ import annotations

import datetime as _dt
import functools
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from typing import BinaryIO
from xml.etree import ElementTree as ET
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
# Built-in number formats that display dates.
_DATE_FORMAT_IDS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_EPOCH = _dt.datetime(1899, 12, 30)
# Element names as the streaming parser gives them.
_ROW, _CELL, _VALUE, _TEXT = (_NS[1:] + x for x in ("row", "c", "v", "t"))
_READ_BYTES = 1 << 16
# The form of most sheets: no prefixes, comments, entities or control characters.
_PLAIN_HEAD = re.compile(
    rb'(?:<\?xml version="1\.0"(?: encoding="(?i:utf-8)")?(?: standalone="(?:yes|no)")?\?>\s*)?<worksheet xmlns="' + re.escape(_NS[1:-1].encode()) + rb'"[^<>]*>'
)
_PLAIN_ROW = re.compile(r'<row(?: [A-Za-z:0-9]+="[^"<>&\x00-\x1f]*")*>')
_PLAIN_CELL = re.compile(
    r'(<c(?: r="([A-Z]+)[0-9]+")?(?: s="([0-9]+)")?(?: t="([A-Za-z]+)")?'
    r'(?:/>|>(?:<v>([^<>&\x00-\x1f\ufffe\uffff]*)</v>|<is><t>([^<>&\x00-\x1f\ufffe\uffff]*)</t></is>)?</c>))'
)


@functools.lru_cache(maxsize=1 << 15)
def _col_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + (ord(ch.upper()) - 64)
        else:
            break
    return n - 1


def _sheet_path(z: zipfile.ZipFile, sheet: str | None) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheets = wb.find(f"{_NS}sheets")
    chosen = None
    for s in sheets:
        if sheet is None or s.get("name") == sheet:
            chosen = s.get(f"{_REL}id")
            break
    if chosen is None:
        raise ValueError(f"sheet {sheet!r} not found")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for r in rels.iter(f"{_PKG_REL}Relationship"):
        if r.get("Id") == chosen:
            target = r.get("Target").lstrip("/")
            return target if target.startswith("xl/") else "xl/" + target
    raise ValueError(f"sheet {sheet!r} has no part")


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out = []
    for _, el in ET.iterparse(io.BytesIO(z.read("xl/sharedStrings.xml"))):
        if el.tag == f"{_NS}si":
            out.append("".join(t.text or "" for t in el.iter(f"{_NS}t")))
            el.clear()
    return out


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    st = ET.fromstring(z.read("xl/styles.xml"))
    custom = set()
    fmts = st.find(f"{_NS}numFmts")
    for f in fmts if fmts is not None else []:
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")).lower()
        if "y" in code or "d" in code:
            custom.add(int(f.get("numFmtId")))
    xfs = st.find(f"{_NS}cellXfs")
    out = set()
    for i, xf in enumerate(xfs if xfs is not None else []):
        fid = int(xf.get("numFmtId", 0))
        if fid in _DATE_FORMAT_IDS or fid in custom:
            out.add(i)
    return out


def _serial_to_text(v: str) -> str:
    ts = _EPOCH + _dt.timedelta(days=float(v))
    return ts.strftime("%Y-%m-%d") if ts.time() == _dt.time(0) else ts.strftime("%Y-%m-%d %H:%M:%S")


def _cell_text(kind: str, value: str | None, inline: str, style: str | int, strings: list[str], dates: set[int]) -> str | None:
    """A cell as text, from its type, its value and its inline text."""
    if kind == "inlineStr":
        return inline
    if kind == "e" or value is None:
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "TRUE" if value == "1" else "FALSE"
    if kind == "n" and int(style) in dates:
        return _serial_to_text(value)
    return value


class _Sheet:
    """Handlers of a streaming parse: cells as text, each ended row appended to ``rows``."""

    def __init__(self, strings: list[str], dates: set[int]):
        self.strings, self.dates = strings, dates
        self.rows: list[list[str | None]] = []
        self._cells: dict[int, str | None] = {}
        self._cell: dict[str, str] = {}
        self._pos, self._value, self._inline, self._chars = 0, None, [], []
        self.parser = expat.ParserCreate(namespace_separator="}")
        self.parser.buffer_text = True
        self.parser.StartElementHandler = self._start
        self.parser.EndElementHandler = self._end
        self.parser.CharacterDataHandler = self._chars.append

    def _start(self, name: str, attributes: dict[str, str]) -> None:
        if name == _CELL:
            self._cell, self._value, self._inline = attributes, None, []
        elif name == _ROW:
            self._cells, self._pos = {}, 0
        else:
            self._chars.clear()

    def _end(self, name: str) -> None:
        if name == _TEXT:
            self._inline.append("".join(self._chars))
        elif name == _VALUE:
            if self._value is None:
                self._value = "".join(self._chars) or None
        elif name == _CELL:
            self._cells[self._place()] = self._content()
            self._pos += 1
        elif name == _ROW:
            width = max(self._cells) + 1 if self._cells else 0
            self.rows.append([self._cells.get(i) for i in range(width)])

    def _place(self) -> int:
        ref = self._cell.get("r")
        return _col_index(ref.rstrip("0123456789")) if ref else self._pos

    def _content(self) -> str | None:
        return _cell_text(self._cell.get("t", "n"), self._value, "".join(self._inline), self._cell.get("s", 0), self.strings, self.dates)

    def feed(self, data: bytes, last: bool = False) -> list[list[str | None]]:
        """The rows that end in this part of the sheet."""
        self.rows.clear()
        self.parser.Parse(data, last)
        return self.rows


def _plain_rows(fh: BinaryIO, strings: list[str], dates: set[int]) -> Iterator[list[str | None]]:
    """Rows of a sheet in the plain form that most programs write, without events for each element. Stops, and
    returns False, at the first byte that is not of this form; True when the sheet was read to its end."""
    head, tag, data = fh.read(_READ_BYTES).partition(b"<sheetData>")
    if not tag or not _PLAIN_HEAD.match(head) or head.count(b"xmlns=") > 1 or b"<!" in head:
        return False
    more = True
    while more:
        new = fh.read(_READ_BYTES)
        more = bool(new)
        rows, end, data = (data + new).rpartition(b"</row>")
        if not end:
            continue
        try:
            text = rows.decode()
        except UnicodeDecodeError:
            return False
        for row in text.split("</row>"):
            start = _PLAIN_ROW.match(row)
            found = _PLAIN_CELL.findall(row, start.end()) if start else []
            if not start or start.end() + sum([len(c[0]) for c in found]) != len(row):
                return False
            cells: dict[int, str | None] = {}
            for pos, (_, letters, style, kind, value, inline) in enumerate(found):
                text_of = inline if kind == "inlineStr" else _cell_text(kind or "n", value or None, inline, style or 0, strings, dates)
                cells[_col_index(letters) if letters else pos] = text_of
            width = max(cells) + 1 if cells else 0
            yield [cells.get(i) for i in range(width)]
    try:  # what stands around the rows
        return data.startswith(b"</sheetData>") and not _Sheet(strings, dates).feed(head + tag + data, True)
    except expat.ExpatError:
        return False


def iter_rows(content: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """Rows of one sheet as lists of text cells (streaming parse)."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        strings, dates = _shared_strings(z), _date_styles(z)
        part = _sheet_path(z, sheet)
        done = 0
        with z.open(part) as fh:
            plain = _plain_rows(fh, strings, dates)
            while True:
                try:
                    row = next(plain)
                except StopIteration as end:
                    if end.value:
                        return
                    break
                done += 1
                yield row
        parse = _Sheet(strings, dates)
        with z.open(part) as fh:  # not plain: by the XML parser, without the rows given already
            data = True
            while data:
                data = fh.read(_READ_BYTES)
                try:
                    rows = parse.feed(data, not data)
                except expat.ExpatError as e:
                    raise ET.ParseError(f"{part}: {e}") from e
                yield from rows[done:]
                done = max(done - len(rows), 0)


class WorkbookError(ValueError):
    """A workbook that cannot be read without losing something."""


def _rows_of(path: str, content: bytes, sheet: str | None) -> Iterator[list[str | None]]:
    try:
        yield from iter_rows(content, sheet)
    except (zipfile.BadZipFile, KeyError) as e:
        raise WorkbookError(f"{path} is not a readable workbook") from e


def _named(path: str, rows: Iterator[list[str | None]], cols: Sequence[str], header: bool) -> Iterator[list[str | None]]:
    """Rows of one workbook in the order of ``cols``: cells go by the names in its own
    header. Raises for names that are unknown or stand twice and for cells beyond the header."""
    place = list(range(len(cols)))
    if header:
        names = list(next(rows, []))
        while names and names[-1] is None:
            names.pop()
        if not names:
            return
        unknown = [n for n in names if n not in cols]
        if unknown or len(set(names)) < len(names):
            raise WorkbookError(f"{path}: unknown or repeated columns {unknown or names}")
        at = {n: i for i, n in enumerate(names)}
        place, width = [at.get(c) for c in cols], len(names)
    else:
        width = len(cols)
    for n, r in enumerate(rows, 1 + header):
        if any(x is not None for x in r[width:]):
            raise WorkbookError(f"{path}: row {n} has cells beyond the {width} columns")
        if any(x is not None for x in r):
            yield [r[i] if i is not None and i < len(r) else None for i in place]


def read_xlsx(
    spark: SparkSession,
    paths: str | Sequence[str],
    sheet: str | None = "Sheet1",
    columns: Sequence[str] | None = None,
    header: bool = True,
) -> DataFrame:
    """Read one sheet of every workbook into text columns.

    Column names come from ``columns`` or from the header row of the first file by
    path (only that file is opened for it). Every file's cells go by the names in
    its own header, in any order; a column the file lacks is NULL. Nothing is
    dropped silently: a file that is no workbook, an unknown column or a cell beyond
    the header fails the read. Hidden files (``_``, ``.``) and the lock files that
    office programs leave (``~$``) are not workbooks."""
    load = list(paths) if not isinstance(paths, str) else paths
    files = spark.read.format("binaryFile").load(load)
    files = files.filter(~F.element_at(F.split("path", "/"), -1).startswith("~$"))

    if columns is None:
        if not header:
            raise ValueError("columns are required without a header row")
        first = files.select("path").orderBy("path").first()  # the path column alone opens no file

        def head(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in it:
                for p, content in zip(pdf["path"], pdf["content"]):
                    names = [x for x in next(_rows_of(p, content, sheet), []) if x is not None]
                    yield pd.DataFrame({"header": [names]})

        one = files.filter(F.col("path") == first[0]).select("path", "content") if first is not None else None
        row = one.mapInPandas(head, "header array<string>").first() if one is not None else None
        columns = list(row[0]) if row is not None else []
    cols = list(columns)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])

    def rows(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for path, content in zip(pdf["path"], pdf["content"]):
                batch = []
                for r in _named(path, _rows_of(path, content, sheet), cols, header):
                    batch.append(r)
                    if len(batch) >= 10_000:
                        yield pd.DataFrame(batch, columns=cols, dtype=object)
                        batch = []
                if batch:
                    yield pd.DataFrame(batch, columns=cols, dtype=object)

    return files.select("path", "content").mapInPandas(rows, schema)
