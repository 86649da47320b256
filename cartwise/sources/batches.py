"""S7 — batches that survive a restart: a commit manifest over numbered batches.

The original writes one folder per batch of customers and starts again from the
first after a failure.  Here a batch counts once its commit is published: its rows
are written aside, its folder is renamed into place, and a small commit file (batch,
keys, rows, content digest) is renamed into ``_commits``, each rename being all or nothing.
A restarted job reads the commits and writes the missing batches only.  Readers
take committed batches alone.

Batch numbers follow the order of the keys, so they are the same in every run over
the same keys; the manifest holds the size and a digest of the keys, and a run over others
is refused instead of mixing two inputs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import batch_numbers
from .sinks import cut_lineage

COMMITS = "_commits"
SCHEMA = "batch long, keys long, rows long, digest string"


def digest_of(cols: Sequence[str]) -> Column:
    """Digest of a group's rows, whatever their order: xor and sum of parts of each row's md5."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    part = lambda a, n: F.conv(F.substring(F.md5(text), a, n), 16, 10).cast("bigint")
    return F.concat_ws("-", F.bit_xor(part(1, 15)).cast("string"), F.sum(part(16, 8)).cast("string"))


class Folder:
    """Renames and small files in the table's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self.jvm = path, spark.sparkContext._jvm
        self.fs = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def move(self, source: str, target: str) -> None:
        """Rename; what an unfinished run left at the target goes first."""
        self.fs.mkdirs(self.at(target).getParent())
        if self.fs.exists(self.at(target)):
            self.fs.delete(self.at(target), True)
        if not self.fs.rename(self.at(source), self.at(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def put(self, name: str, text: str) -> None:
        """A small file, published by a rename."""
        aside = f"_aside-{uuid.uuid4().hex}"
        out = self.fs.create(self.at(aside))
        out.write(bytearray(text.encode()))
        out.close()
        self.move(aside, name)

    def drop(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The manifest: batch, keys, rows, digest of every committed batch."""
    folder = Folder(spark, path)
    if not folder.fs.globStatus(folder.at(f"{COMMITS}/batch-*.json")):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(f"{path}/{COMMITS}/batch-*.json")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the committed batches, with ``batch``."""
    done = [r["batch"] for r in commits(spark, path).select("batch").collect()]
    if not done:
        raise FileNotFoundError(f"no committed batch in {path}")
    return spark.read.option("basePath", path).parquet(*[f"{path}/batch={b}" for b in sorted(done)])


def write_batches(df: DataFrame, path: str, order: Sequence[str], size: int, wave: int = 64,
                  on_commit: Callable[[int], None] | None = None) -> DataFrame:
    """Write the batches of ``size`` keys that ``path`` lacks; returns the manifest.

    All rows of a key are in one batch.  ``wave`` batches are written by one Spark job
    and committed one by one; ``on_commit`` is called with each batch's number.
    """
    spark, keys, folder = df.sparkSession, list(order), Folder(df.sparkSession, path)
    numbers = cut_lineage(batch_numbers(df.select(*keys).distinct(), keys, size).drop("row_no"), "batch_keys")
    total, digest = numbers.agg(F.max("batch") + 1, digest_of([*keys, "batch"])).first()
    plan = json.dumps({"size": size, "keys": keys, "digest": digest})
    kept = folder.at(f"{COMMITS}/plan.txt")
    if folder.fs.exists(kept):
        if spark.read.text(f"{path}/{COMMITS}/plan.txt", wholetext=True).first()["value"] != plan:
            raise ValueError(f"{path} holds batches of other keys or another size")
    else:
        folder.put(f"{COMMITS}/plan.txt", plan)
    done = {r["batch"] for r in commits(spark, path).select("batch").collect()}
    missing = [b for b in range(total or 0) if b not in done]
    # joined on all keys, a NULL in one included
    named = numbers.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], "batch")
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    rows = df.join(named, same).drop(*[f"_k{i}" for i in range(len(keys))])
    if missing:
        rows = cut_lineage(rows, "batch_rows")
    for k in range(0, len(missing), wave):
        now, aside = missing[k:k + wave], f"_aside-{uuid.uuid4().hex}"
        rows.filter(F.col("batch").isin(now)).repartition("batch").write.partitionBy("batch").parquet(f"{path}/{aside}")
        wrote = spark.read.parquet(f"{path}/{aside}").groupBy("batch").agg(
            F.count_distinct(F.struct(*keys)).alias("keys"), F.count(F.lit(1)).alias("rows"), digest_of(df.columns).alias("digest"))
        for r in sorted(wrote.collect()):  # a row per batch of the wave
            folder.move(f"{aside}/batch={r['batch']}", f"batch={r['batch']}")
            folder.put(f"{COMMITS}/batch-{r['batch']}.json", json.dumps(r.asDict()))
            if on_commit:
                on_commit(r["batch"])
        folder.drop(aside)
    return commits(spark, path)
