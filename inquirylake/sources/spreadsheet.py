"""Sheets of workbooks (Office Open XML) as DataFrames, read in the executors."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of the format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINKS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _text(node: ElementTree.Element) -> str:
    """All runs of text below a node, without phonetic hints."""
    return "".join(t.text or "" for child in node for t in ([child] if child.tag == f"{MAIN}t" else child.iter(f"{MAIN}t") if child.tag == f"{MAIN}r" else []))


def _column(reference: str) -> int:
    out = 0
    for letter in re.match(r"[A-Z]*", reference)[0]:
        out = out * 26 + ord(letter) - 64
    return out - 1


def cells(workbook: bytes, name: str | None = None) -> Iterator[tuple[int, int, str]]:
    """line, column (both from 0) and text of each filled cell of a sheet, the first if none is named."""
    with zipfile.ZipFile(io.BytesIO(workbook)) as book:
        files = book.namelist()
        shared = [_text(item) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in files else []
        sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet")
        wanted = next((s.get(f"{LINKS}id") for s in sheets if name in (None, s.get("name"))), None)
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        if wanted is None:
            return
        target = targets[wanted]
        with book.open(target[1:] if target.startswith("/") else f"xl/{target}") as stream:
            line = -1
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{MAIN}row":
                    continue
                line = int(row.get("r", line + 2)) - 1
                for at, cell in enumerate(row):
                    value, kind = cell.find(f"{MAIN}v"), cell.get("t")
                    inline = cell.find(f"{MAIN}is")
                    text = _text(inline) if inline is not None else None if value is None else shared[int(value.text)] if kind == "s" else value.text
                    if text not in (None, ""):
                        yield line, _column(cell.get("r", "")) if cell.get("r") else at, text
                row.clear()


def sheet(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """A sheet whose first line names its columns, as texts, with _line (SRC-1 to SRC-3).

    A whole number reads without its '.0'; empty cells are null, lines without any cell are left out.
    """

    def read(batches):
        import pandas as pd

        for batch in batches:
            for content in batch["content"]:
                rows = pd.DataFrame(cells(content, name), columns=["line", "at", "text"])
                for start in range(0, len(rows), 50_000):
                    yield rows.iloc[start : start + 50_000]

    whole = spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, "line long, at int, text string")
    header = whole.where("line = 0").orderBy("at").collect()  # as many as the sheet has columns
    text = F.regexp_replace("text", r"^(-?\d+)\.0$", "$1")
    lines = whole.where("line > 0").groupBy("line").agg(F.map_from_entries(F.collect_list(F.struct("at", text))).alias("cells"))
    return lines.select(F.col("line").alias("_line"), *(F.try_element_at("cells", F.lit(h["at"])).alias(h["text"]) for h in header))
