"""Master workbooks: CSV files, and .xlsx files, whose sheets are read from their XML on executors."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltweave.operators.master import MASTER, master_timeaware
from voltweave.sources.csv import files_under, read_csv_by_name

#: What a header may be called; blanks and underscores don't count, nor does case.
_ALIASES = {"MTRNO": "MTR_NO", "DTMETERNO": "MTR_NO", "METERNO": "MTR_NO"} | {c.replace("_", ""): c for c in MASTER}


def normalized_header(name: str) -> str:
    short = re.sub(r"[\s_]", "", name).upper()
    return _ALIASES.get(short, name)


def is_workbook(path: str) -> bool:
    """Not a lock file, and named for a year."""
    name = path.rsplit("/", 1)[-1]
    return not name.startswith("~$") and re.search(r"20\d\d", name) is not None


def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    """The time-aware master of all workbooks under path; files without a MONTH column are left out."""
    files = [f for f in files_under(spark, path) if is_workbook(f)]
    out = None
    for f in files:
        part = read_csv_by_name(spark, [f]).drop("SOURCE_FILE")
        part = part.toDF(*[normalized_header(c) for c in part.columns])
        if "MONTH" in part.columns:
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in MASTER.items()))
    return master_timeaware(out)


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(cell: str) -> int:
    """0 for A1, 27 for AB3."""
    n = 0
    for c in cell:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def sheet_rows(book: bytes) -> Iterator[tuple[str, int, dict[int, str]]]:
    """(sheet, row number, column: text) of every row of an .xlsx file that holds something; sheets are read as streams."""
    with zipfile.ZipFile(io.BytesIO(book)) as z:
        names = set(z.namelist())
        shared = ["".join(t.text or "" for t in si.iter(f"{_NS}t")) for si in ElementTree.parse(z.open("xl/sharedStrings.xml")).getroot()] if "xl/sharedStrings.xml" in names else []
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.parse(z.open("xl/_rels/workbook.xml.rels")).getroot()}
        for sheet in ElementTree.parse(z.open("xl/workbook.xml")).getroot().iter(f"{_NS}sheet"):
            target = targets[sheet.get(_REL)]
            with z.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as f:
                for _, row in ElementTree.iterparse(f):
                    if row.tag != f"{_NS}row":
                        continue
                    cells = {}
                    for i, c in enumerate(row.iter(f"{_NS}c")):
                        value, kind = c.find(f"{_NS}v"), c.get("t")
                        text = "".join(t.text or "" for t in c.iter(f"{_NS}t")) if kind == "inlineStr" else None if value is None else shared[int(value.text)] if kind == "s" else value.text
                        if text:
                            cells[_column(c.get("r")) if c.get("r") else i] = text
                    if cells:
                        yield sheet.get("name"), int(row.get("r") or 0), cells
                    row.clear()


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of the sheets with a MONTH, by normalised header; the first row of a sheet is its header."""
    for b in batches:
        for path, book in zip(b["path"], b["content"], strict=True):
            rows, now, header = [], None, {}
            for sheet, _, cells in sheet_rows(bytes(book)):
                if sheet != now:
                    now, header = sheet, {i: normalized_header(text) for i, text in cells.items()}
                elif "MONTH" in header.values():
                    rows.append((path, sheet, [(header[i], text) for i, text in cells.items() if i in header]))
            yield pd.DataFrame(rows, columns=["file", "sheet", "cells"])


def workbook_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, sheet, cells: map of column to text) of all .xlsx workbooks under path, each opened on an executor from the bytes that Spark reads.

    Lock files and files that no year is named in are left out before they are read, sheets without a MONTH after. Of columns of one
    name the last counts.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true").load(path)
    named = files.where(F.col("path").rlike(r"/[^/]*20\d\d[^/]*$") & ~F.col("path").rlike(r"/~\$[^/]*$"))
    found = named.select("path", "content").mapInPandas(_records, "file string, sheet string, cells array<struct<k: string, v: string>>")
    last = F.aggregate("cells", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), lambda m, c: F.map_concat(F.map_filter(m, lambda k, _: k != c["k"]), F.create_map(c["k"], c["v"])))
    return found.select("file", "sheet", last.alias("cells"))


def read_master_excel(spark: SparkSession, path: str) -> DataFrame:
    """The time-aware master of all sheets with a MONTH of the .xlsx workbooks under path; columns that a sheet lacks are null. Older binary formats aren't read."""
    cells = workbook_records(spark, path)
    return master_timeaware(cells.select(*[F.col("cells").getItem(c).alias(c) for c in MASTER]))
