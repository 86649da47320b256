"""S3 — spreadsheet files (XLSX) as a Spark data source.

``spark.read.format("workbook")`` reads one sheet of a workbook: a zip of XML
parts.  The header row names the columns (stray blanks stripped, P20), the wanted ones
come out as doubles under the names asked for, and cells that are no number are listed in
``bad_cells`` as ``C5=text`` while their value is NULL.  A sheet is read in ranges of rows, one
partition each.  The file's bytes are fetched through Spark's own reader, so any file
system it knows will do; ``MAX_BYTES`` bounds them (a sheet format holds a million rows at most).
"""

from __future__ import annotations

import base64
import json

from pyspark.sql import DataFrame, SparkSession

MAX_BYTES = 64 << 20


def workbook_source():
    """The data source class, made here so that workers get its code with the plan and need no package."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Sheet:
        """Rows of one sheet: (row number, {column letters: text})."""

        MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
        REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

        def __init__(self, content: bytes, sheet: int):
            import io
            import xml.etree.ElementTree as ET
            import zipfile
            self.et, self.zip = ET, zipfile.ZipFile(io.BytesIO(content))
            sheets = self.part("xl/workbook.xml").find(f"{self.MAIN}sheets")
            wanted = sheets[sheet].get(self.REL)
            target = next(r.get("Target") for r in self.part("xl/_rels/workbook.xml.rels") if r.get("Id") == wanted)
            self.name = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            self.shared = []
            if "xl/sharedStrings.xml" in self.zip.namelist():
                self.shared = ["".join(t.text or "" for t in s.iter(f"{self.MAIN}t")) for s in self.part("xl/sharedStrings.xml")]

        def part(self, name: str):
            return self.et.fromstring(self.zip.read(name))

        def rows(self, first: int, last: int):
            number = 0
            for _, row in self.et.iterparse(self.zip.open(self.name)):
                if row.tag != f"{self.MAIN}row":
                    continue
                number = int(row.get("r") or number + 1)
                if first <= number <= last:
                    yield number, dict(self.cell(c, i) for i, c in enumerate(row))
                row.clear()
                if number >= last:
                    return

        def cell(self, c, i: int):
            at = (c.get("r") or "").rstrip("0123456789") or self.letters(i)
            kind, value = c.get("t"), c.find(f"{self.MAIN}v")
            if kind == "inlineStr":
                return at, "".join(t.text or "" for t in c.iter(f"{self.MAIN}t"))
            text = value.text if value is not None else None
            return at, self.shared[int(text)] if kind == "s" and text is not None else text

        @staticmethod
        def letters(i: int) -> str:
            out = ""
            while i >= 0:
                out, i = chr(ord("A") + i % 26) + out, i // 26 - 1
            return out

        def header(self) -> dict[str, str]:
            return {at: (text or "").strip() for _, cells in self.rows(1, 1) for at, text in cells.items()}

        def last_row(self) -> int:
            return max((int(r) for r in self.numbers()), default=1)

        def numbers(self):
            n = 0
            for _, row in self.et.iterparse(self.zip.open(self.name)):
                if row.tag == f"{self.MAIN}row":
                    n = int(row.get("r") or n + 1)
                    row.clear()
                    yield n

    class SheetReader(DataSourceReader):
        def __init__(self, options):
            import base64
            import json
            self.content = base64.b64decode(options["content"])
            self.columns, self.sheet = json.loads(options["columns"]), int(options.get("sheet", 0))
            self.range = int(options.get("rows", 10000))

        def partitions(self):
            sheet = Sheet(self.content, self.sheet)
            missing = [c for c in self.columns if c not in sheet.header().values()]
            if missing:
                raise ValueError(f"the sheet lacks columns {missing}")
            return [InputPartition((k, k + self.range - 1)) for k in range(2, max(sheet.last_row(), 2) + 1, self.range)]

        def read(self, partition):
            sheet = Sheet(self.content, self.sheet)
            place = {name: at for at, name in sheet.header().items()}
            for number, cells in sheet.rows(*partition.value):
                values, bad = [], []
                for name in self.columns:
                    text = (cells.get(place[name]) or "").strip()
                    try:
                        values.append(float(text.replace(",", ".")) if text else None)
                    except ValueError:
                        values.append(None)
                        bad.append(f"{place[name]}{number}={text}")
                if any(v is not None for v in values) or bad:
                    yield (*values, "; ".join(bad) or None)

    class Workbook(DataSource):
        @classmethod
        def name(cls):
            return "workbook"

        def schema(self):
            import json
            return ", ".join(f"`{n}` double" for n in json.loads(self.options["columns"]).values()) + ", bad_cells string"

        def reader(self, schema):
            return SheetReader(self.options)

    return Workbook


def read_workbook(spark: SparkSession, path: str, columns: dict[str, str], sheet: int = 0, rows: int = 10000) -> DataFrame:
    """The columns (header -> name) of a sheet as doubles, and ``bad_cells``."""
    spark.dataSource.register(workbook_source())
    files = spark.read.format("binaryFile").load(path).select("length", "content").limit(2)
    found = files.select("length").collect()
    if len(found) != 1 or found[0]["length"] > MAX_BYTES:
        raise ValueError(f"{path}: one workbook of at most {MAX_BYTES} bytes is read")
    content = base64.b64encode(files.first()["content"]).decode()
    return (spark.read.format("workbook").option("content", content).option("columns", json.dumps(columns))
            .option("sheet", str(sheet)).option("rows", str(rows)).load())
