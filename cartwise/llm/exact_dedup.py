"""Exact dedup (operator 5): tree-merge of sorted digest runs.

Each input partition sorts its digests and folds equal ones: a *run* with one
entry per distinct digest, ascending, with the identifier that stays and counts.
Runs are exchanged in rounds of a binomial tree: in a round, the runs whose
number agrees above the next ``levels`` bits meet (2**levels of them), are merged
multiway in digest order, equal entries folding into one, and leave one run.  The
digest space is cut into ``ranges``, and a run is exchanged range by range,
so no task ever holds more than one range of 2**levels runs; a text with
any number of copies is one entry per run, whatever its count.  The last
round leaves one run per range: every digest once.

Verification: an entry's key is the SHA-256 of the text with its byte length
and a second, independent 64-bit hash; entries fold at every level only where
all three agree.

Results for odd input: a NULL text is the empty text; rows of equal text keep
the largest id (a NULL id sorts below all others); repeated rows (equal id
and text) all carry the same decision, and ``drop_copies`` leaves one of them;
an empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import full_text, lower_ascii, quoted, written

KEY = ["digest", "n_bytes", "check"]
ENTRY = "part long, run long, digest binary, n_bytes long, check long, keep_id long, n long, top long"
FIELDS = [f.split()[0] for f in ENTRY.split(", ")]


def key_columns(docs: DataFrame) -> list[Column]:
    """KEY of a row's text, lower-cased in A-Z only."""
    text = lower_ascii(full_text(docs)).cast("binary")
    return [F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"),
            F.xxhash64(text).alias("check")]


def digests(docs: DataFrame, ranges: int = 4096) -> DataFrame:
    """(doc_id, digest, n_bytes, check, run, part) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *key_columns(docs), F.spark_partition_id().cast("long").alias("run"))
    return rows.withColumn("part", F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long") % ranges)


def keys_of(batch: pa.RecordBatch) -> np.ndarray:
    """Digest, length and check of every row as 48 bytes that sort by digest."""
    digest = np.frombuffer(b"".join(batch["digest"].to_pylist()), np.uint8).reshape(-1, 32)
    rest = np.stack([batch["n_bytes"].to_numpy(), batch["check"].to_numpy()], 1).astype(">i8")
    return np.ascontiguousarray(np.hstack([digest, rest.view(np.uint8).reshape(-1, 16)])).view("S48").ravel()


def merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One run from the sorted runs of a range, one after the other in ``batch``."""
    keys = keys_of(batch)
    order = np.argsort(keys, kind="stable")  # finds the sorted runs and merges them
    raw = keys.view(np.uint8).reshape(-1, 48)[order]
    first = np.flatnonzero(np.append(True, (raw[1:] != raw[:-1]).any(1)))
    ids = batch["keep_id"].take(pa.array(order))
    known, top = ids.is_valid().to_numpy(zero_copy_only=False), batch["top"].to_numpy()[order]
    low = np.iinfo(np.int64).min
    value = ids.fill_null(low).to_numpy()
    best, some = np.maximum.reduceat(value, first), np.logical_or.reduceat(known, first)
    sizes = np.diff(np.append(first, len(keys)))
    stays = (value == np.repeat(best, sizes)) & (known == np.repeat(some, sizes))
    out = batch.take(pa.array(order[first]))
    columns = dict(zip(FIELDS, out.columns))
    columns |= {"keep_id": pa.array(best, mask=~some), "n": pa.array(np.add.reduceat(batch["n"].to_numpy()[order], first)),
                "top": pa.array(np.add.reduceat(np.where(stays, top, 0), first))}
    return pa.RecordBatch.from_arrays([columns[c] for c in FIELDS], names=FIELDS)


def merge_sorted(rows: DataFrame) -> DataFrame:
    """One run from the runs of each (part, run), whose rows follow one another in a task."""
    def merge(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            if not len(t):
                continue
            part, run = t["part"].to_numpy(), t["run"].to_numpy()
            edge = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (run[1:] != run[:-1])))
            for x, y in zip(edge[:-1].tolist(), edge[1:].tolist()):
                yield merged(t.slice(x, y - x).combine_chunks().to_batches()[0])
            held = t.slice(edge[-1])
        if held is not None and len(held):
            yield merged(held.combine_chunks().to_batches()[0])

    return rows.mapInArrow(merge, ENTRY)


def merge_round(runs: DataFrame, levels: int) -> DataFrame:
    """One round: the runs agreeing above ``levels`` bits meet range by range, one after the other, and are merged."""
    met = runs.withColumn("of", F.col("run")).withColumn("run", F.shiftright("run", levels))
    return merge_sorted(met.repartition("part", "run").sortWithinPartitions("part", "run", "of", "digest").select(*FIELDS))


def merge_runs(keyed: DataFrame, levels: int = 4) -> DataFrame:
    """One entry per text: KEY, keep_id, group_size, keep_rows (rows with this id)."""
    one = F.lit(1).cast("long")
    runs = keyed.select("part", "run", *KEY, F.col("doc_id").alias("keep_id"), one.alias("n"), one.alias("top"))
    runs = merge_sorted(runs.sortWithinPartitions("part", "run", "digest"))  # sorted where they are
    left = max(1, (keyed.agg(F.max("run")).first()[0] or 0).bit_length())
    while left > 0:
        runs, left = merge_round(runs, levels), left - levels
    return runs.select(*KEY, "keep_id", F.col("n").alias("group_size"), F.col("top").alias("keep_rows"))


def exact_dedup(docs: DataFrame, ranges: int = 4096, levels: int = 4, hot_share: float = 0.001) -> DataFrame:
    """Decision per row: doc_id, keep_id, group_size, kept, text_sha256.

    Decisions reach the rows by a join on the digest.  Texts holding more
    than ``hot_share`` of all rows (at most 1 / hot_share of them, which
    bounds the broadcast) are joined by broadcast, all others by shuffle, so
    no task receives a large group.
    """
    keyed = written(digests(docs, ranges), "digests")
    texts = written(merge_runs(keyed, levels), "merged").drop("keep_rows")
    limit = keyed.count() * hot_share
    hot = texts.filter(F.col("group_size") > limit)
    rest = texts.filter(F.col("group_size") <= limit)
    seen = keyed.join(F.broadcast(hot), KEY, "left")
    cold = seen.filter(F.col("group_size").isNull()).drop("keep_id", "group_size").join(rest, KEY)
    rows = seen.filter(F.col("group_size").isNotNull()).unionByName(cold)
    return rows.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, ranges: int = 4096, levels: int = 4) -> DataFrame:
    """One row per text, with all its columns: of the largest id; of repeated rows one."""
    texts = written(merge_runs(written(digests(docs, ranges), "digests"), levels), "merged")
    names = ["_digest", "_bytes", "_check"]
    stay = texts.select(*[F.col(k).alias(n) for k, n in zip(KEY, names)], "keep_id", "keep_rows")
    keyed = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), "doc_id", *key_columns(docs))
    same = keyed["doc_id"].eqNullSafe(stay["keep_id"])
    for k, n in zip(KEY, names):
        same = same & (keyed[k] == stay[n])
    kept = keyed.join(stay, same)
    once = kept.filter("keep_rows = 1").select("row.*")
    more = kept.filter("keep_rows > 1").select("row", *names)
    again = more.groupBy(*names).agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row.*")
    return once.union(again)
