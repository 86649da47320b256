"""O1 — a table in global order: range-partitioned sorted files with a key-range manifest.

The original sorts its whole result.  Here the rows are range-partitioned by the
full order and sorted inside each partition, so files do not overlap and, read
by their key ranges, follow one another; a customer with very many rows spreads
over several files, as the order goes on after the customer.  The manifest
(``_key_ranges`` inside the folder, written last: a table without it is not whole)
has a row per file: its name, first and last key, rows, and the number of rows before
it.  A reader takes only files whose range meets the asked one, and gives each row
its number in the whole order from the manifest and the row's place in its file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST = "_key_ranges"


def write_sorted(df: DataFrame, path: str, order: Sequence[str], n_files: int | None = None) -> DataFrame:
    """Overwrite ``path`` with ``df`` in global order (NULL first); returns the manifest."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    ranged = df.repartitionByRange(n_files, *keys) if n_files else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    rows = spark.read.schema(df.schema).parquet(path).select(F.col("_metadata.file_name").alias("file"), F.struct(*order).alias("key"))
    files = rows.groupBy("file").agg(F.min("key").alias("first_key"), F.max("key").alias("last_key"), F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("first_key", "last_key")) - F.col("rows")  # a row per file
    files.withColumn("rows_before", before).coalesce(1).write.parquet(f"{path}/{MANIFEST}")
    return key_ranges(spark, path)


def key_ranges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{MANIFEST}")


def read_sorted(spark: SparkSession, path: str, low=None, high=None) -> DataFrame:
    """The rows with ``row_no``, their number from 0 in the order; only those whose first key column
    lies in ``low``..``high`` where given, from the files that can hold them."""
    ranges = key_ranges(spark, path)
    first = ranges.schema["first_key"].dataType.fieldNames()[0]
    wanted = ranges.filter("rows > 0")
    if low is not None:
        wanted = wanted.filter(F.col(f"last_key.{first}") >= low)
    if high is not None:
        wanted = wanted.filter(F.coalesce(F.col(f"first_key.{first}") <= high, F.lit(True)))
    names = [r["file"] for r in wanted.select("file").collect()]  # a list of files, as any scan has
    schema = spark.read.parquet(path).schema
    if not names:
        return spark.createDataFrame([], schema).withColumn("row_no", F.lit(0).cast("long"))
    rows = spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in names])
    rows = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    if low is not None:
        rows = rows.filter(F.col(first) >= low)
    if high is not None:
        rows = rows.filter(F.col(first) <= high)
    out = rows.join(wanted.select(F.col("file").alias("_file"), "rows_before"), "_file")
    return out.withColumn("row_no", F.col("rows_before") + F.col("_at")).select(*schema.names, "row_no")
