"""Workbooks as cells: XLSX files are zip archives of XML, read from a column of bytes, one row a cell.

Values are those that the file has cached; nothing is computed. What can't be read makes one row with an error, so no file
is lost and none fails the job. From cells on everything is DataFrame operations: labelled values, numbered fields, and the
turning of a sheet with a column per record into a row per record.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.extraction import cell
from ..operators.select import first_row

CELLS = "sheet string, row int, column int, ref string, kind string, value string, error string"
_REF = re.compile(r"([A-Z]+)(\d+)$")
#: The most bytes that a part of a workbook may unpack to.
PART_BYTES = 256 << 20


class BadWorkbook(ValueError):
    pass


def column_number(letters: str) -> int:
    """A is 1, Z is 26, AA is 27."""
    n = 0
    for c in letters:
        n = 26 * n + ord(c) - 64
    return n


def _name(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _part(book: zipfile.ZipFile, name: str) -> ElementTree.Element:
    if book.getinfo(name).file_size > PART_BYTES:
        raise BadWorkbook(f"{name} unpacks to over {PART_BYTES} bytes")
    raw = book.read(name)
    if b"<!DOCTYPE" in raw[:4096] or b"<!ENTITY" in raw:
        raise BadWorkbook(f"{name} declares entities")
    return ElementTree.fromstring(raw)


def _said(element: ElementTree.Element) -> str:
    """The text of a shared or inline string: all its runs but the phonetic ones."""
    return "".join(t.text or "" for part in element if _name(part) in ("t", "r") for t in ([part] if _name(part) == "t" else (x for x in part if _name(x) == "t")))


def read_cells(content: bytes) -> Iterator[tuple[str, int, int, str, str, str]]:
    """(sheet, row, column, ref, kind, value) of each filled cell; kind is text, number, boolean or error."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        links = {r.get("Id"): r.get("Target", "") for r in _part(book, "xl/_rels/workbook.xml.rels")}
        texts = [_said(x) for x in _part(book, "xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in names else []
        sheets = [s for group in _part(book, "xl/workbook.xml") if _name(group) == "sheets" for s in group]
        for sheet in sheets:
            target = next((links.get(v, "") for k, v in sheet.attrib.items() if k.rpartition("}")[2] == "id"), "")
            path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            if path not in names:
                raise BadWorkbook(f"sheet {sheet.get('name')!r} has no part {path!r}")
            for data in _part(book, path):
                if _name(data) != "sheetData":
                    continue
                for n, line in enumerate(data, 1):
                    row, column = int(line.get("r", n)), 0
                    for c in line:
                        found = _REF.match(c.get("r", ""))
                        column = column_number(found[1]) if found else column + 1
                        kind, value = c.get("t", "n"), next((x.text for x in c if _name(x) == "v"), None)
                        if kind == "inlineStr":
                            value = next((_said(x) for x in c if _name(x) == "is"), None)
                        elif kind == "s" and value is not None:
                            value = texts[int(value)]
                        if value is None or value == "":
                            continue
                        shown = {"s": "text", "inlineStr": "text", "str": "text", "b": "boolean", "e": "error"}.get(kind, "number")
                        yield sheet.get("name", ""), row, column, c.get("r") or f"R{row}C{column}", shown, value


def scan(documents: DataFrame, keys: Sequence[str], content: str = "content", sheets: Sequence[str] = ()) -> DataFrame:
    """keys and the cells of each workbook. A file that is no workbook, or lacks one of the sheets asked for, gives one row with
    its error and no cell. Null contents give none."""
    wanted, columns = list(sheets), [f.split()[0] for f in CELLS.split(", ")]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for n in range(len(frame)):
                raw = frame[content].iloc[n]
                if raw is None:
                    continue
                try:
                    rows = [(*x, None) for x in read_cells(bytes(raw))]
                    lost = sorted(set(wanted) - {r[0] for r in rows})
                    if lost:
                        raise BadWorkbook(f"no cells on sheet {', '.join(lost)}")
                except Exception as e:  # noqa: BLE001 - whatever is wrong with a file belongs to its row
                    rows = [(None, None, None, None, None, None, f"{type(e).__name__}: {e}")]
                out = pd.DataFrame(rows, columns=columns).astype({"row": "Int32", "column": "Int32"})
                for i, k in enumerate(keys):
                    out.insert(i, k, [frame[k].iloc[n]] * len(out))
                yield out

    fields = "".join(f"`{k}` {documents.schema[k].dataType.simpleString()}, " for k in keys)
    return documents.select(*keys, content).mapInPandas(work, fields + CELLS)


def numbered_fields(cells: DataFrame, keys: Sequence[str], sheet: str, column: int = 2) -> DataFrame:
    """keys, field (such as 1.4) and its row: the first row whose cell in the given column is a field's number."""
    marked = cells.where((F.col("sheet") == sheet) & (F.col("column") == column)).select(*keys, F.trim("value").alias("field"), "row")
    return marked.where(F.col("field").rlike(r"^\d+\.\d+$")).groupBy(*keys, "field").agg(F.min("row").alias("row"))


def records(cells: DataFrame, keys: Sequence[str], sheet: str, fields: Mapping[str, str], key_field: str, first_column: int = 5) -> DataFrame:
    """A row for each column of a sheet that fills key_field: keys, column, and for each field its text under the given name, its
    number (name_number), whether it is a spreadsheet error (name_is_cell_error) and where it stands (name_ref).

    One join of cells with the field numbers, which are few a file, and one aggregate by file and column."""
    places = numbered_fields(cells, keys, sheet).where(F.col("field").isin(*fields))
    held = cells.where((F.col("sheet") == sheet) & (F.col("column") >= first_column)).join(places, [*keys, "row"])
    text, number, error = cell(F.col("value"))
    held = held.withColumns({"__text": F.when(F.col("kind") != "error", text), "__number": F.when(F.col("kind") != "error", number), "__error": (F.col("kind") == "error") | error})
    of = lambda f, c: F.max(F.when(F.col("field") == f, F.col(c)))
    picks = [p for f, name in fields.items() for p in (of(f, "__text").alias(name), of(f, "__number").alias(f"{name}_number"), F.coalesce(of(f, "__error"), F.lit(False)).alias(f"{name}_is_cell_error"), F.max(F.when(F.col("field") == f, F.concat(F.col("sheet"), F.lit("!"), F.col("ref")))).alias(f"{name}_ref"))]
    return held.groupBy(*keys, "column").agg(*picks).where(F.col(fields[key_field]).isNotNull())


def missing_fields(cells: DataFrame, keys: Sequence[str], sheet: str, fields: Mapping[str, str]) -> DataFrame:
    """keys and each field that a file's sheet doesn't number."""
    named = cells.sparkSession.createDataFrame([(f, n) for f, n in fields.items()], "field string, name string")
    files = cells.where(F.col("sheet") == sheet).select(*keys).distinct()
    return files.crossJoin(F.broadcast(named)).join(numbered_fields(cells, keys, sheet).drop("row"), [*keys, "field"], "left_anti")


def labelled_values(cells: DataFrame, keys: Sequence[str], sheet: str, labels: Mapping[str, str], rows: int = 12, columns: int = 8) -> DataFrame:
    """keys and, for each label, the cell to the right of the first cell that says it (case, space and a final colon aside), looked
    for in the top left block: labels stand in other columns on other sheets."""
    block = cells.where((F.col("sheet") == sheet) & (F.col("row") <= rows) & (F.col("column") <= columns + 1))
    said = F.lower(F.trim(F.regexp_replace(F.trim("value"), r"\s*:\s*$", "")))
    names = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    marks = block.where(said.isin(*labels)).select(*keys, names[said].alias("__name"), "row", (F.col("column") + 1).alias("column"))
    text, _, error = cell(F.col("value"))
    beside = block.where(~error & (F.col("kind") != "error")).select(*keys, "row", "column", text.alias("__value"))
    found = first_row(marks.join(beside, [*keys, "row", "column"]).where("__value is not null"), [*keys, "__name"], [F.asc("row"), F.asc("column")])
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("__name") == n, F.col("__value"))).alias(n) for n in dict.fromkeys(labels.values())])


def serial_or_date(value: Column) -> Column:
    """A date from a cell: a day number of the sheet's calendar, or text."""
    from ..functions.text import date_from_serial, date_in

    number = value.try_cast("double")
    return F.when(number.isNotNull(), date_from_serial(number.cast("int"))).otherwise(date_in(value))
