"""The growth reference sheet as a small typed table (S3, P20).

The sheet is read as the spreadsheet it is (:mod:`workbook`), or from an
export to CSV or parquet, with its headers stripped of stray blanks, renamed to
plain column names and cast to double.  It holds one row per age in months, so
joins against it are broadcast by AQE from its measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import literals as L
from .tables import tidy_columns
from .workbook import read_workbook


def read_growth_sheet(spark: SparkSession, path: str, fmt: str = "csv", bad_cells: bool = False) -> DataFrame:
    """The growth sheet; ``fmt`` xlsx, csv or parquet.  ``bad_cells`` (xlsx) keeps the column that lists
    cells which are no numbers."""
    if fmt == "xlsx":
        names = {h.strip(): n for h, n in L.GROWTH_SHEET_COLUMNS.items()}
        sheet = read_workbook(spark, path, names)
        return sheet if bad_cells else sheet.drop("bad_cells")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    df = tidy_columns(reader.load(path))
    missing = [c for c in L.GROWTH_SHEET_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"growth sheet lacks columns {missing}")
    return df.select(*[F.col(f"`{src}`").cast("double").alias(dst)
                       for src, dst in L.GROWTH_SHEET_COLUMNS.items()])
