"""Sheets of workbooks (.xlsx) as tables, and tables as workbooks.

A workbook is a task: its rows are streamed from the sheet's XML, and the table of texts that its cells share is all that is held.  A
table is written in workbooks of at most `rows` rows, each staged under a name of its own by the attempt that writes it; only what the
finished attempts name is moved into place, so a lost executor or a task that ran twice leaves no rows behind.

Defined cases: the first row of a sheet names its columns, of equal names the first counts; declared columns that a sheet lacks are null, others
are not read.  Empty cells, error values and values that don't parse are null; an empty text is an empty text.  Rows without any
cell count as rows of nulls if they stand between others.  Numbers of more than 15 digits, which spreadsheets would round, are written as
text.  Characters that XML can't hold have their escape of the format.  A text longer than a cell may be is an error that names its
column.  An empty table is one workbook with a header.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal
from typing import IO, Any
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Fixed values of the format: rows of a sheet, characters of a cell, first days of the two calendars.
MAX_ROWS, MAX_TEXT = 1_048_576, 32_767
EPOCHS = {False: "1899-12-30", True: "1904-01-01"}
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"

_ESCAPED = re.compile("_x([0-9A-Fa-f]{4})_")
_UNSAFE = re.compile("[\x00-\x08\x0b-\x1f\ufffe\uffff]|_(?=x[0-9A-Fa-f]{4}_)")


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))


def _tag(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _text(element: ElementTree.Element) -> str:
    """The text of a cell or shared entry: its runs, without the hints for reading them aloud."""
    parts = [t.text or "" for child in element for t in (child.iter() if _tag(child) == "r" else [child]) if _tag(t) == "t"]
    return _ESCAPED.sub(lambda m: chr(int(m[1], 16)), "".join(parts))


def _elements(file: IO[bytes], name: str) -> Iterator[ElementTree.Element]:
    """The elements of a name, each forgotten after its turn."""
    root = None
    for event, element in ElementTree.iterparse(file, ("start", "end")):
        root = element if root is None else root
        if event == "end" and _tag(element) == name:
            yield element
            element.clear()
            for parent in (root, *root):
                if _tag(parent) == "sheetData" or parent is root and name == "si":
                    parent.clear()


def _column(reference: str) -> int:
    """The number, from 0, of the column in a reference such as AB12."""
    number = 0
    for letter in reference.rstrip("0123456789"):
        number = number * 26 + ord(letter) - 64
    return number - 1


def column_letters(number: int) -> str:
    letters = ""
    number += 1
    while number:
        number, digit = divmod(number - 1, 26)
        letters = chr(65 + digit) + letters
    return letters


def _part(book: zipfile.ZipFile, sheet: str | None, path: str) -> tuple[str, bool]:
    """The part of the archive that holds a sheet, the first without a name, and whether days count from 1904."""
    top = ElementTree.fromstring(book.read("xl/workbook.xml"))
    listed = {x.get("name"): x.get(f"{{{OFFICE}}}id") for x in top.iter() if _tag(x) == "sheet"}
    wanted = sheet if sheet is not None else next(iter(listed), None)
    if wanted not in listed:
        raise ValueError(f"{path} has no sheet {sheet!r}, but {list(listed)}")
    targets = {x.get("Id"): x.get("Target") or "" for x in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    target = targets[listed[wanted]]
    later = any(_tag(x) == "workbookPr" and x.get("date1904") in ("1", "true") for x in top.iter())
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}", later


def sheet_rows(book: zipfile.ZipFile, sheet: str | None = None, path: str = "") -> Iterator[dict[int, str | None]]:
    """The rows of a sheet: text of the cells by the number of their column, and the first day of its calendar at -1."""
    part, later = _part(book, sheet, path)
    shared: list[str] = []
    if "xl/sharedStrings.xml" in book.namelist():
        with book.open("xl/sharedStrings.xml") as file:
            shared = [_text(x) for x in _elements(file, "si")]
    last = 0
    with book.open(part) as file:
        for row in _elements(file, "row"):
            number = int(row.get("r") or last + 1)
            for _ in range(last + 1, number):
                yield {-1: EPOCHS[later]}
            last, at = number, -1
            cells: dict[int, str | None] = {-1: EPOCHS[later]}
            for cell in row:
                at = _column(cell.get("r") or "") if cell.get("r") else at + 1
                kind, value = cell.get("t", "n"), next((x.text for x in cell if _tag(x) == "v"), None)
                if kind == "inlineStr":
                    cells[at] = next((_text(x) for x in cell if _tag(x) == "is"), None)
                elif kind == "e" or value is None and kind != "str":
                    cells[at] = None
                elif kind == "s":
                    cells[at] = shared[int(value or 0)]
                elif kind == "b":
                    cells[at] = "true" if value == "1" else "false"
                else:
                    cells[at] = _ESCAPED.sub(lambda m: chr(int(m[1], 16)), value or "") if kind == "str" else value
            yield cells


@dataclass
class Workbook(InputPartition):
    path: str


class SheetReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.path, self.sheet, self.names = options["path"], options.get("sheet"), schema.names

    def partitions(self) -> Sequence[InputPartition]:
        store, path = _store(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(path, recursive=True))
        hidden = lambda p: any(x.startswith(("_", ".", "~")) for x in p[len(path):].split("/"))
        return [Workbook(x.path) for x in found if x.is_file and x.path.endswith(".xlsx") and not hidden(x.path)]

    def read(self, partition: Workbook) -> Iterator[tuple[str | None, ...]]:  # type: ignore[override]
        store, _ = _store(self.path)
        with store.open_input_file(partition.path) as file, zipfile.ZipFile(file) as book:
            rows = sheet_rows(book, self.sheet, partition.path)
            header: dict[str | None, int] = {}
            for at, name in next(rows, {}).items():
                header.setdefault(name if at >= 0 else None, at)
            places = [header.get(name, -2) for name in self.names[:-1]]
            for cells in rows:
                yield (*(cells.get(at) for at in places), cells[-1])


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


def _cell(place: str, value: Any, column: str) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{place}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime) and value >= dt.date(1900, 3, 1):
        return f'<c r="{place}" s="1"><v>{(value - dt.date(1899, 12, 30)).days}</v></c>'
    if isinstance(value, float) and value - value == 0 or isinstance(value, int | Decimal) and len(re.sub(r"\D", "", str(value)).lstrip("0")) <= 15:
        return f'<c r="{place}"><v>{value!r}</v></c>' if not isinstance(value, Decimal) else f'<c r="{place}"><v>{value:f}</v></c>'
    text = value.isoformat(*([" "] if isinstance(value, dt.datetime) else [])) if isinstance(value, dt.date) else str(value)
    if len(text) > MAX_TEXT:
        raise ValueError(f"a value of {column} has {len(text)} characters, a cell has {MAX_TEXT} at most")
    safe = _UNSAFE.sub(lambda m: f"_x{ord(m[0]):04X}_", text)
    return f'<c r="{place}" t="inlineStr"><is><t xml:space="preserve">{escape(safe)}</t></is></c>'


def _fixed_parts(sheet: str) -> dict[str, str]:
    """The parts of an archive besides its sheet."""
    head, kind = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n', "application/vnd.openxmlformats-officedocument.spreadsheetml"
    part = lambda name, of: f'<Override PartName="/xl/{name}.xml" ContentType="{kind}.{of}+xml"/>'
    link = lambda k, of, target: f'<Relationship Id="rId{k}" Type="{OFFICE}/{of}" Target="{target}"/>'
    one = lambda name, inner: f'<{name} count="1">{inner}</{name}>'
    return {
        "[Content_Types].xml": f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>{part("workbook", "sheet.main")}{part("worksheets/sheet1", "worksheet")}{part("styles", "styles")}</Types>',
        "_rels/.rels": f'{head}<Relationships xmlns="{PACKAGE}">{link(1, "officeDocument", "xl/workbook.xml")}</Relationships>',
        "xl/workbook.xml": f'{head}<workbook xmlns="{MAIN}" xmlns:r="{OFFICE}"><sheets><sheet name={quoteattr(sheet)} sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{head}<Relationships xmlns="{PACKAGE}">{link(1, "worksheet", "worksheets/sheet1.xml")}{link(2, "styles", "styles.xml")}</Relationships>',
        "xl/styles.xml": f'{head}<styleSheet xmlns="{MAIN}">{one("fonts", "<font/>")}<fills count="2"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill></fills>{one("borders", "<border/>")}{one("cellStyleXfs", "<xf/>")}<cellXfs count="2"><xf/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>',
    }


class SheetWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str], schema: T.StructType, overwrite: bool):
        self.path, self.sheet, self.rows = options["path"], options.get("sheet", "Sheet1"), int(options.get("rows", MAX_ROWS - 1))
        self.names, self.overwrite, self.staged = schema.names, overwrite, f"_staged-{uuid.uuid4().hex}"
        if not 0 < self.rows < MAX_ROWS:
            raise ValueError(f"a workbook has 1 to {MAX_ROWS - 1} rows below its header, not {self.rows}")

    def write(self, iterator: Iterator[Row]) -> Written:  # type: ignore[override]
        store, root = _store(self.path)
        store.create_dir(f"{root}/{self.staged}", recursive=True)
        paths: list[str] = []
        row = next(iterator, None)
        while row is not None:
            paths.append(f"{root}/{self.staged}/part-{uuid.uuid4().hex}.xlsx")
            with store.open_output_stream(paths[-1]) as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as book:
                for name, text in _fixed_parts(self.sheet).items():
                    book.writestr(name, text)
                with book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as sheet:
                    sheet.write(self._head())
                    number = 1
                    while row is not None and number <= self.rows:
                        number += 1
                        sheet.write(self._row(number, row))
                        row = next(iterator, None)
                    sheet.write(b"</sheetData></worksheet>")
        return Written(paths)

    def _head(self) -> bytes:
        return f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<worksheet xmlns="{MAIN}"><sheetData>'.encode() + self._row(1, self.names)

    def _row(self, number: int, values: Sequence[Any]) -> bytes:
        cells = "".join(_cell(f"{column_letters(k)}{number}", v, self.names[k]) for k, v in enumerate(values))
        return f'<row r="{number}">{cells}</row>'.encode()

    def commit(self, messages: list[Written | None]) -> None:  # type: ignore[override]
        store, root = _store(self.path)
        store.create_dir(f"{root}/{self.staged}", recursive=True)
        paths = [p for m in messages if m for p in m.paths]
        old = [x.path for x in store.get_file_info(fs.FileSelector(root)) if x.is_file and x.path.endswith(".xlsx")] if self.overwrite else []
        if not paths:
            paths = [f"{root}/{self.staged}/part-{uuid.uuid4().hex}.xlsx"]
            with store.open_output_stream(paths[0]) as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as book:
                for name, text in (_fixed_parts(self.sheet) | {"xl/worksheets/sheet1.xml": f"{self._head().decode()}</sheetData></worksheet>"}).items():
                    book.writestr(name, text)
        for path in paths:
            store.move(path, f"{root}/{path.rpartition('/')[2]}")
        for path in old:
            store.delete_file(path)
        store.delete_dir(f"{root}/{self.staged}")

    def abort(self, messages: list[Written | None]) -> None:  # type: ignore[override]
        store, root = _store(self.path)
        if store.get_file_info(f"{root}/{self.staged}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.staged}")


class Sheets(DataSource):
    """The source `workbooks`, with the options path, sheet and, to write, rows."""

    @classmethod
    def name(cls) -> str:
        return "workbooks"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return SheetReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return SheetWriter(self.options, schema, overwrite)


def _typed(value: Column, kind: T.DataType) -> Column:
    """A cell's text as a declared type: whole numbers may be written as 3.0 or 3E2, dates as days of the sheet's calendar."""
    if isinstance(kind, T.IntegralType):
        return F.coalesce(value.try_cast(kind), value.try_cast("decimal(38,6)").try_cast(kind))
    if isinstance(kind, T.BooleanType):
        return value.try_cast(kind)
    if isinstance(kind, T.DateType):
        return F.coalesce(F.when(value.rlike(r"^[0-9.]+$"), F.date_add(F.col("__epoch").cast("date"), value.try_cast("double").cast("int"))), value.try_cast(kind))
    return value.try_cast(kind)


def read_sheets(spark: SparkSession, path: str, schema: T.StructType, sheet: str | None = None) -> DataFrame:
    """The rows of a sheet, the first if it has no name here, of one workbook or of all below a folder."""
    spark.dataSource.register(Sheets)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField("__epoch", T.StringType())])
    read = spark.read.format("workbooks").schema(texts)
    read = read.option("sheet", sheet) if sheet is not None else read
    return read.load(path).select(*(_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema))


def write_sheets(df: DataFrame, path: str, sheet: str = "Sheet1", rows: int = MAX_ROWS - 1) -> None:
    """A table as workbooks of one sheet, in place of those that the folder holds."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType | T.BinaryType)]
    if nested:
        raise ValueError(f"a cell holds no nested or binary value: {nested}")
    df.sparkSession.dataSource.register(Sheets)
    df.write.format("workbooks").mode("overwrite").option("sheet", sheet).option("rows", rows).save(path)
