"""Workbooks as input of the registered queries and tests (the library only reads them)."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame


def _xml_text(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _values(column: pd.Series) -> list:
    """A column's cells as Python values, missing ones as None."""
    return [None if gone else v for v, gone in zip(column.tolist(), column.isna().tolist())]


def workbook_bytes(header: Sequence[str], rows: Sequence[Sequence[object]], sheet: str = "Sheet1") -> bytes:
    """A minimal workbook: inline strings, numbers as numbers."""

    def letters(i: int) -> str:
        out = ""
        i += 1
        while i:
            i, r = divmod(i - 1, 26)
            out = chr(65 + r) + out
        return out

    names = [letters(j) for j in range(max(map(len, [header, *rows])))]

    def cell(v: object, ref: str) -> str:
        if v is None:
            return ""
        if isinstance(v, str):
            return f'<c r="{ref}" t="inlineStr"><is><t>{_xml_text(v)}</t></is></c>'
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{v!r}</v></c>' if isinstance(v, float) else f'<c r="{ref}"><v>{v}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{_xml_text(str(v))}</t></is></c>'

    body = "".join(
        f'<row r="{i}">' + "".join([cell(v, f"{c}{i}") for c, v in zip(names, r)]) + "</row>"
        for i, r in enumerate([list(header), *rows], 1)
    )
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts = {
        "[Content_Types].xml": (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            '<Override PartName="/xl/workbook.xml" '
            'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            '<Override PartName="/xl/worksheets/sheet1.xml" '
            'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            "</Types>"
        ),
        "_rels/.rels": (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f'<Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/>'
            "</Relationships>"
        ),
        "xl/workbook.xml": (
            f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{main}" xmlns:r="{rel}">'
            f'<sheets><sheet name="{_xml_text(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>'
        ),
        "xl/_rels/workbook.xml.rels": (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f'<Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/>'
            "</Relationships>"
        ),
        "xl/worksheets/sheet1.xml": (
            f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>'
        ),
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return buf.getvalue()


def write_xlsx(df: DataFrame, directory: str, sheet: str = "Sheet1", rows_per_file: int = 100_000) -> None:
    """Write workbooks of at most ``rows_per_file`` rows into a folder of any shared file system.

    Files are named after partition and number and written beside their name first, then
    moved: a task that is retried after a lost executor replaces its files."""
    cols = df.columns

    def write(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        fs, base = pafs.FileSystem.from_uri(directory)
        ctx, n, waiting = TaskContext.get(), 0, []

        def flush() -> None:
            nonlocal n
            path = f"{base}/part-{ctx.partitionId() if ctx is not None else 0:05d}-{n:04d}.xlsx"
            fs.create_dir(base, recursive=True)
            temp = f"{base}/_{uuid.uuid4().hex}"
            with fs.open_output_stream(temp) as out:
                out.write(workbook_bytes(cols, waiting, sheet))
            fs.move(temp, path)
            waiting.clear()
            n += 1

        for pdf in it:
            for r in zip(*(_values(pdf[c]) for c in pdf.columns)):
                waiting.append(r)
                if len(waiting) >= rows_per_file:
                    flush()
        if waiting:
            flush()
        yield pd.DataFrame({"files": [n]})

    # positional names inside the task: header names may hold dots or spaces
    positional = df.toDF(*[f"c{i}" for i in range(len(cols))])
    positional.mapInPandas(write, "files long").agg({"files": "sum"}).collect()
