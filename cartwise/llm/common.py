"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def read_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def full_text(docs: DataFrame) -> Column:
    """The whole text, a NULL one as the empty string."""
    return F.coalesce(docs["text"], F.lit(""))


def quoted(name: str) -> Column:
    """The column of this very name, whatever signs it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_hash(docs: DataFrame) -> Column:
    """Hash of all columns of a row, NULLs and values told apart."""
    cols = [quoted(f.name) if f.dataType.typeName() not in ("map", "variant") else F.to_json(quoted(f.name)) for f in docs.schema]
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def id_text(df: DataFrame) -> DataFrame:
    """doc_id as text: pandas would hold a batch's ids as floats where one is NULL."""
    return df.withColumn("doc_id", F.col("doc_id").cast("string"))


def id_long(df: DataFrame) -> DataFrame:
    """doc_id as a number again."""
    return df.withColumn("doc_id", F.col("doc_id").cast("long"))


def id_remainder(col: Column, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m`` (a NULL id counts as empty text)."""
    return (F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % m).cast("int")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as a table under ``spark.checkpoint.dir`` and read it back.

    The folder is shared by driver and executors; the table goes away when
    the application ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def connected(edges: DataFrame, a: str = "a", b: str = "b", rows_per_file: int = 100_000) -> DataFrame:
    """Smallest id reachable over undirected ``edges``: rows (id, component_id).

    Alternating large-star / small-star rounds over edges (u, v), u > v: v gives
    way to its smallest neighbour, then the smaller neighbours of u (and u) hook
    to the smallest of them, until nothing moves.  Rounds grow with the logarithm
    of the longest chain; edges never get more.  A centre's many edges meet in a left
    join (skew splits) and a combined minimum; a window only takes a node's distinct
    smaller neighbours.  One row per round reaches the driver: whether an
    edge moved, and the count, by which the next round's files are dealt.  Nodes
    without an edge are not in the result.
    """
    cur = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .filter("u <> v").distinct(), "edges")
    moved, n = True, cur.count()
    while moved and n:
        parent = cur.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("p"))
        large = cur.join(parent, "v", "left").select(
            "u", F.coalesce("p", "v").alias("v"), F.col("p").isNotNull().alias("moved"))
        low = large.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        hook = F.struct(F.col("u"), F.col("m").alias("v"), (F.col("moved") | (F.col("v") != F.col("m"))).alias("moved"))
        step = F.struct(F.col("v").alias("u"), F.col("m").alias("v"), F.lit(True).alias("moved"))
        small = low.select(F.explode(F.when(F.col("v") != F.col("m"), F.array(hook, step)).otherwise(F.array(hook)))
                           .alias("e")).select("e.*")
        files = max(-(-n // rows_per_file), edges.sparkSession.sparkContext.defaultParallelism)
        cur = written(small.groupBy("u", "v").agg(F.max("moved").alias("moved")).coalesce(files), "edges")
        moved, n = cur.agg(F.max("moved"), F.count(F.lit(1))).first()
        cur = cur.select("u", "v")
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(
        cur.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())
