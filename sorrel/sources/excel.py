"""A folder of workbooks with a header row as one DataFrame."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StructType, TimestampType

_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def _column(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _text(node: ElementTree.Element | None) -> str:
    return "" if node is None else "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))


def _first_sheet(book: zipfile.ZipFile) -> tuple[str, bool]:
    """The part of the first sheet by the order of the workbook, and whether its days count from 1904.

    A package that lacks the list of its sheets has its lowest numbered one first.
    """
    if "xl/workbook.xml" not in book.namelist():
        sheets = [n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)]
        return min(sheets, key=lambda n: int(re.search(r"(\d+)\.xml", n).group(1))), False
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    settings, sheet = root.find("m:workbookPr", _NS), root.find("m:sheets/m:sheet", _NS)
    late = settings is not None and settings.get("date1904") in ("1", "true")
    for relation in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if relation.get("Id") == sheet.get(_RELATION):
            target = relation.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}", late
    raise ValueError("the workbook names no first sheet")


def _value(cell: ElementTree.Element, shared: list[str]) -> str | None:
    value, kind = cell.find("m:v", _NS), cell.get("t")
    if kind == "inlineStr":
        return _text(cell.find("m:is", _NS))
    if value is None or kind == "e":  # an error has no value
        return None
    if kind == "s":
        return shared[int(value.text)]
    return {"1": "true", "0": "false"}.get(value.text) if kind == "b" else value.text


def sheet_rows(content: bytes) -> Iterator[dict[str, str | None]]:
    """Rows of the first sheet keyed by its header, and ``_late`` for days that count from 1904."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in root.findall("m:si", _NS)]
        first, late = _first_sheet(book)
        root = ElementTree.fromstring(book.read(first))
    header: dict[int, str] | None = None
    for row in root.iter(f"{{{_NS['m']}}}row"):
        cells: dict[int, str | None] = {}
        for place, cell in enumerate(row.findall("m:c", _NS)):
            at = _column(cell.get("r")) if cell.get("r") else place
            cells[at] = _value(cell, shared)
        if header is None:
            header = {at: (text or "").strip() for at, text in cells.items()}
        elif cells:
            yield {**{name: cells.get(at) for at, name in header.items()}, "_late": "true" if late else None}


def workbooks(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Header-named columns of every ``.xlsx`` in ``folder``; values that do not fit, and errors, become null.

    A date or time may be a text or, as workbooks keep them, a number of days.
    """
    names = schema.fieldNames()

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = [{**{n: r.get(n) for n in names}, "_late": r["_late"]} for r in sheet_rows(content)]
                yield pd.DataFrame(rows, columns=[*names, "_late"], dtype=object)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(folder).select("content")
    text = files.mapInPandas(parse, ", ".join(f"`{n}` string" for n in [*names, "_late"]))
    return text.select(*[_cast(f.name, f.dataType).alias(f.name) for f in schema.fields])


def _cast(name: str, kind: DataType) -> Column:
    plain = F.col(f"`{name}`").try_cast(kind)
    if not isinstance(kind, (DateType, TimestampType)):
        return plain
    days = F.col(f"`{name}`").try_cast("double") + F.when(F.col("_late").isNotNull(), 1462).otherwise(0)
    # Days since the end of 1899 less one, rounded to milliseconds.
    moment = F.timestamp_millis(F.round((days - 25569) * 86_400_000).cast("bigint"))
    if isinstance(kind, TimestampType):
        # A workbook has no time zone: its clock is that of the session.
        read = F.to_utc_timestamp(moment, F.current_timezone())
    else:
        read = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(days - 25569).cast("int"))
    return F.when(days.isNotNull(), read).otherwise(plain)
