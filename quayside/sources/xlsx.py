"""Workbooks: a header row, then one row per record, on the first sheet.

Read with Spark's ``binaryFile`` source, many workbooks in one job; their bytes
reach Python in slices and wait in a temporary file of the task, so that its
memory does not grow with a workbook. Written as one workbook per task and row cap.
Cells: numbers, booleans, dates and texts; an empty cell is NULL. Whole
numbers keep all their digits in the file although spreadsheet programs show
15 of them.
"""

from __future__ import annotations

import datetime as dt
import re
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import IO
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.sources.part_files import write_part_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_COLUMN = "__file"
ROWS_PER_BATCH = 10_000
STRETCH = 1 << 17
SLICE = 1 << 20
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"

# Fixed values of the workbook format.
SHEET_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
TEXT_TAG, VALUE_TAG = f"{SHEET_NS}t", f"{SHEET_NS}v"
LONGEST_TEXT = 32_767
EPOCH = dt.datetime(1899, 12, 30)
EPOCH_DAYS = 25_569  # from the format's epoch to 1970
DAY = 86_400_000_000  # microseconds
DATE_FORMAT_IDS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
DATETIME_STYLE, DATE_STYLE = 1, 2
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
SHEET_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
PARTS = {
    "[Content_Types].xml": f'<Types xmlns="{PACKAGE}/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    f'<Override PartName="/xl/workbook.xml" ContentType="{SHEET_TYPE}.sheet.main+xml"/>'
    f'<Override PartName="/xl/styles.xml" ContentType="{SHEET_TYPE}.styles+xml"/>'
    f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{SHEET_TYPE}.worksheet+xml"/></Types>',
    "_rels/.rels": f'<Relationships xmlns="{PACKAGE}/relationships">'
    f'<Relationship Id="rId1" Type="{RELS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": f'<workbook {MAIN} xmlns:r="{RELS}"><sheets>'
    '<sheet name="%s" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}/relationships">'
    f'<Relationship Id="rId1" Type="{RELS}/worksheet" Target="worksheets/sheet1.xml"/>'
    f'<Relationship Id="rId2" Type="{RELS}/styles" Target="styles.xml"/></Relationships>',
    "xl/styles.xml": f'<styleSheet {MAIN}><numFmts count="2">'
    '<numFmt numFmtId="164" formatCode="yyyy-mm-dd hh:mm:ss.000"/><numFmt numFmtId="165" formatCode="yyyy-mm-dd"/>'
    '</numFmts><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>'
    '<cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf/>'
    '<xf numFmtId="164" applyNumberFormat="1"/><xf numFmtId="165" applyNumberFormat="1"/></cellXfs></styleSheet>',
}


# --- writing ---------------------------------------------------------------


def _column_name(index: int) -> str:
    name = ""
    while index >= 0:
        name = chr(65 + index % 26) + name
        index = index // 26 - 1
    return name


# Characters that XML cannot hold, and texts that look like their replacement.
ODD_TEXT = r"[\x00-\x08\x0b-\x1f\x{FFFE}\x{FFFF}]|_x[0-9A-Fa-f]{4}_"


def _xml_text(text: str) -> str:
    """Text with the characters that XML cannot hold written as ``_xHHHH_``."""
    text = re.sub(r"_(?=x[0-9A-Fa-f]{4}_)", "_x005F_", text)
    text = re.sub(r"[\x00-\x08\x0b-\x1f\ufffe\uffff]", lambda m: f"_x{ord(m[0]):04X}_", text)
    return escape(text)


def _escaped(values: pa.Array) -> pa.Array:
    if pc.any(pc.match_substring_regex(values, ODD_TEXT)).as_py():
        return pa.array([None if v is None else _xml_text(v) for v in values.to_pylist()], pa.string())
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        values = pc.replace_substring(values, char, entity)
    return values


def _serials(micros: pa.Array) -> pa.Array:
    """Days since the epoch of the format, exact to the microsecond, as texts."""
    if (pc.min(micros).as_py() or 0) < 0:
        texts = [None if m is None else f"{Decimal(m) / DAY:.18f}" for m in micros.to_pylist()]
        return pa.array(texts, pa.string())
    days = pc.divide(micros, DAY)
    rest = pc.subtract(micros, pc.multiply(days, DAY))
    # Twelve digits of a day: rest * 10**12 / DAY, rounded.
    digits = pc.divide(pc.add(pc.multiply(rest, 625), 27), 54)
    return pc.binary_join_element_wise(days.cast("string"), pc.utf8_lpad(digits.cast("string"), 12, "0"), ".")


def _cells(values: pa.Array, column: str, rows: pa.Array) -> pa.Array:
    """The cells of one column as XML texts, empty where the value is NULL."""
    kind, mark, text = values.type, "><v>", None
    if pa.types.is_boolean(kind):
        mark, text = ' t="b"><v>', pc.if_else(values, "1", "0")
    elif pa.types.is_integer(kind) or pa.types.is_decimal(kind):
        text = values.cast("string")
    elif pa.types.is_floating(kind):
        text = values.cast("string")
        if not pc.all(pc.is_finite(values)).as_py() and pc.any(pc.invert(pc.is_finite(values))).as_py():
            finite = _joined(column, rows, mark, text, "</v></c>")
            other = _joined(column, rows, ' t="inlineStr"><is><t>', text, "</t></is></c>")
            return pc.fill_null(pc.if_else(pc.is_finite(values), finite, other), "")
    elif pa.types.is_timestamp(kind):
        micros = values.cast(pa.timestamp("us", kind.tz)).cast("int64")
        mark, text = f' s="{DATETIME_STYLE}"><v>', _serials(pc.add(micros, EPOCH_DAYS * DAY))
    elif pa.types.is_date(kind):
        days = pc.add(values.cast(pa.date32()).cast("int32"), EPOCH_DAYS)
        mark, text = f' s="{DATE_STYLE}"><v>', days.cast("string")
    elif pa.types.is_string(kind) or pa.types.is_large_string(kind):
        longest = pc.max(pc.utf8_length(values)).as_py() or 0
        if longest > LONGEST_TEXT:
            raise ValueError(f"a cell holds at most {LONGEST_TEXT} characters, got {longest}")
        mark = ' t="inlineStr"><is><t xml:space="preserve">'
        return pc.fill_null(_joined(column, rows, mark, _escaped(values.cast("string")), "</t></is></c>"), "")
    else:
        raise TypeError(f"a workbook cannot hold values of type {kind}")
    return pc.fill_null(_joined(column, rows, mark, text, "</v></c>"), "")


def _joined(column: str, rows: pa.Array, mark: str, text: pa.Array, end: str) -> pa.Array:
    return pc.binary_join_element_wise(f'<c r="{column}', rows, f'"{mark}', text, end, "")


class _Workbook:
    """One workbook, its rows streamed into the zip entry of the sheet."""

    def __init__(self, stream, sheet: str, names: list[str]):
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED, allowZip64=True, compresslevel=3)
        for part, text in PARTS.items():
            text = text % escape(sheet, {'"': "&quot;"}) if part == "xl/workbook.xml" else text
            self.zip.writestr(part, HEAD + text)
        self.rows = self.zip.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
        self.letters = [_column_name(i) for i in range(len(names))]
        self.rows.write(f"{HEAD}<worksheet {MAIN}><sheetData>".encode())
        self.row = 1
        self.write(pa.record_batch([pa.array([name], pa.string()) for name in names], names=names))

    def write(self, batch: pa.RecordBatch) -> None:
        rows = pa.array(range(self.row, self.row + batch.num_rows)).cast("string")
        cells = [_cells(values, column, rows) for values, column in zip(batch.columns, self.letters)]
        lines = pc.binary_join_element_wise('<row r="', rows, '">', *cells, "</row>", "")
        self.rows.write("".join(lines.to_pylist()).encode())
        self.row += batch.num_rows

    def close(self) -> None:
        self.rows.write(b"</sheetData></worksheet>")
        self.rows.close()
        self.zip.close()


def write_workbooks(
    frame: DataFrame, path: str, overwrite: bool, sheet: str, rows_per_workbook: int, by: str | None = None
) -> None:
    """One workbook per task and row cap, in one sub-folder per value of ``by``."""
    names = [name for name in frame.columns if name != by]
    write_part_files(
        frame, path, overwrite, ".xlsx", rows_per_workbook, by, lambda stream: _Workbook(stream, sheet, names)
    )


# --- reading ---------------------------------------------------------------


def _joined_text(element) -> str:
    """Text of an inline or shared string, a single run or several."""
    if len(element) == 1 and element[0].tag == TEXT_TAG:
        text = element[0].text or ""
    else:
        text = "".join(t.text or "" for t in element.iter(TEXT_TAG))
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), text) if "_x" in text else text


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell styles whose number format shows a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    ids = set(DATE_FORMAT_IDS)
    for fmt in root.iter(f"{SHEET_NS}numFmt"):
        if re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", fmt.get("formatCode", "").lower())):
            ids.add(int(fmt.get("numFmtId")))
    formats = root.find(f"{SHEET_NS}cellXfs")
    found = formats if formats is not None else []
    return {i for i, xf in enumerate(found) if int(xf.get("numFmtId", 0)) in ids}


def _first_sheet(book: zipfile.ZipFile) -> str:
    first = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{SHEET_NS}sheets")[0]
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in links if r.get("Id") == first.get(f"{{{RELS}}}id"))
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _column_index(letters: str) -> int:
    index = 0
    for char in letters:
        index = index * 26 + ord(char) - 64
    return index - 1


def _row_elements(sheet) -> Iterator[ElementTree.Element]:
    """The row elements of a sheet, parsed a stretch of whole rows at a time."""
    data = b""
    while not (start := re.search(rb"<(?:(\w+):)?sheetData\s*(/?)>", data)):
        more = sheet.read(STRETCH)
        if not more:
            raise ValueError("the workbook's first sheet holds no sheet data")
        data += more
    if start[2]:
        return
    prefix = start[1] + b":" if start[1] else b""
    head, data = data[: start.end()], data[start.end() :]
    end = b"</" + prefix + b"row>"
    tail = b"</" + prefix + b"sheetData></" + prefix + b"worksheet>"
    while True:
        cut = data.rfind(end) + len(end)
        if cut >= len(end):
            yield from ElementTree.fromstring(head + data[:cut] + tail).find(f"{SHEET_NS}sheetData")
            data = data[cut:]
        more = sheet.read(STRETCH)
        if not more:
            return
        data += more


def _sliced(files: DataFrame) -> DataFrame:
    """The workbooks of a ``binaryFile`` frame in slices (path, part, last), those of one next to each other and in order."""
    last = F.floor(F.greatest(F.length("content") - 1, F.lit(0)) / SLICE).cast("int")
    part = lambda i: F.struct(F.substring("content", i * SLICE + 1, F.lit(SLICE)).alias("part"), (i == last).alias("last"))
    return files.select("path", F.explode(F.transform(F.sequence(F.lit(0), last), part)).alias("_s")).select("path", "_s.part", "_s.last")


def _workbooks(batches) -> Iterator[tuple[str, IO[bytes]]]:
    """Paths and files of the workbooks of batches of slices, one at a time."""
    book = None
    for batch in batches:
        for path, part, last in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            book = book or tempfile.TemporaryFile()
            book.write(part.as_buffer())
            if last:
                book.seek(0)
                with book:
                    yield path, book
                book = None


def _rows(file: IO[bytes]) -> Iterator[dict[int, tuple[str, str]]]:
    """Rows of the first sheet as {column: (kind, text)}; kinds: number, date, bool, text."""
    with zipfile.ZipFile(file) as book:
        dates = {str(style) for style in _date_styles(book)}
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_joined_text(si) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        columns: dict[str, int] = {}
        with book.open(_first_sheet(book)) as sheet:
            for row in _row_elements(sheet):
                cells = {}
                for position, cell in enumerate(row):
                    ref, kind = cell.get("r"), cell.get("t", "n")
                    letters = ref.rstrip("0123456789") if ref else _column_name(position)
                    if letters not in columns:
                        columns[letters] = _column_index(letters)
                    column = columns[letters]
                    if kind == "inlineStr":
                        cells[column] = ("text", _joined_text(cell[0]))
                        continue
                    text = cell.findtext(VALUE_TAG)
                    if text is None or kind == "e":
                        continue
                    if kind == "n":
                        cells[column] = ("date" if cell.get("s") in dates else "number", text)
                    elif kind == "s":
                        cells[column] = ("text", shared[int(text)])
                    elif kind == "b":
                        cells[column] = ("bool", "true" if text == "1" else "false")
                    else:
                        cells[column] = ("text", text)
                yield cells


def _to_datetime(cell: tuple[str, str]) -> dt.datetime:
    if cell[0] == "text":
        return dt.datetime.fromisoformat(cell[1])
    return EPOCH + dt.timedelta(microseconds=int((Decimal(cell[1]) * DAY).to_integral_value()))


def _whole_number(text: str) -> int:
    number = Decimal(text)
    if number != number.to_integral_value():
        raise ValueError(f"{text!r} is not a whole number")
    return int(number)


def _typed(cells: list[tuple[str, str] | None], kind: pa.DataType) -> pa.Array:
    """The cells of one column as values of a type; a cell that does not fit raises."""
    texts = pa.array([None if c is None else c[1] for c in cells], pa.string())
    if pa.types.is_string(kind):
        return texts
    if pa.types.is_boolean(kind):
        return pa.array([None if c is None else c[1].lower() in ("true", "1") for c in cells], kind)
    if pa.types.is_timestamp(kind):
        if all(c is None or c[0] != "text" for c in cells):
            days = texts.cast(pa.decimal128(25, 15))
            micros = pc.round(pc.multiply(days, pa.scalar(Decimal(DAY), pa.decimal128(11, 0)))).cast("int64")
            return pc.subtract(micros, EPOCH_DAYS * DAY).cast(pa.timestamp("us")).cast(kind)
        return pa.array([None if c is None else _to_datetime(c) for c in cells], kind)
    if pa.types.is_date(kind):
        return pa.array([None if c is None else _to_datetime(c).date() for c in cells], kind)
    if pa.types.is_integer(kind):
        try:
            return texts.cast(kind)
        except pa.ArrowInvalid:  # such as 1.0 or 2E5
            return pa.array([None if c is None else _whole_number(c[1]) for c in cells], kind)
    return texts.cast(kind)


def _header(rows: Iterator) -> dict[str, int]:
    return {text: column for column, (_, text) in next(rows, {}).items()}


def _decoder(schema: pa.Schema) -> Callable:
    """Function from batches of slices to batches of typed rows."""

    def to_batch(cells: list, header: dict, path: str) -> pa.RecordBatch:
        arrays = []
        for field in schema:
            if field.name == FILE_COLUMN:
                arrays.append(pa.array([path] * len(cells), field.type))
                continue
            column = header.get(field.name)
            arrays.append(_typed([row.get(column) for row in cells], field.type))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def decode(batches):
        for path, book in _workbooks(batches):
            rows = _rows(book)
            header, cells = _header(rows), []
            for row in rows:
                cells.append(row)
                if len(cells) == ROWS_PER_BATCH:
                    yield to_batch(cells, header, path)
                    cells = []
            if cells:
                yield to_batch(cells, header, path)

    return decode


def _found_kinds(batches):
    """Which kinds of cells each column of each workbook holds."""
    for _, book in _workbooks(batches):
        rows = _rows(book)
        header = _header(rows)
        found = {(name, column, "empty") for name, column in header.items()}
        names = {column: name for name, column in header.items()}
        found |= {(names[c], c, kind) for row in rows for c, (kind, _) in row.items() if c in names}
        if found:
            names, columns, kinds = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(columns, pa.int32()), pa.array(kinds)], names=["name", "position", "kind"]
            )


def infer_schema(files: DataFrame) -> T.StructType:
    """Numbers are double, dates timestamps; a column of mixed kinds is a string.

    One pass over the workbooks; only column names and kinds reach the driver.
    """
    kinds = _sliced(files).mapInArrow(_found_kinds, "name string, position int, kind string")
    columns = (
        kinds.groupBy("name").agg(F.min("position").alias("position"), F.collect_set("kind").alias("kinds")).collect()
    )
    single = {"number": T.DoubleType(), "date": T.TimestampNTZType(), "bool": T.BooleanType()}
    schema = T.StructType()
    for column in sorted(columns, key=lambda c: (c["position"], c["name"])):
        held = set(column["kinds"]) - {"empty"}
        schema.add(column["name"], single.get(next(iter(held)), T.StringType()) if len(held) == 1 else T.StringType())
    return schema


def read_workbooks(files: DataFrame, schema: T.StructType | None) -> DataFrame:
    """Rows of all workbooks of a ``binaryFile`` frame, with the file of each row."""
    schema = infer_schema(files) if schema is None else schema
    full = T.StructType([*schema.fields, T.StructField(FILE_COLUMN, T.StringType())])
    return _sliced(files).mapInArrow(_decoder(to_arrow_schema(full)), full)
