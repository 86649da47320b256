"""MinHash near-dedup (operator 12): fast similarity sketches, banding, exact verification.

A document's set holds its distinct 5-word shingles (64-bit hashes of the words,
A-Z lower-cased).  Two documents link at Jaccard >= 85 / 100; the result is each
document's connected component, of which the smallest id stays.

1. Sketches.  Documents with equal sets are one class.  A sketch has ``BANDS`` x
   ``ROWS`` coordinates.  In round r every shingle is hashed anew into one
   coordinate with a value that all later rounds exceed; a coordinate keeps its
   least value, and rounds end as soon as every coordinate is filled.  After as
   many rounds as there are coordinates, round by round all shingles fall into one
   given coordinate, so none stays empty.  Each coordinate of two sets agrees with
   the probability of their similarity, nearly independently.
2. Banding.  Classes that agree in a whole band share a bucket: two linked ones
   miss all bands with probability below 1e-8.  Buckets with the same members are one.
3. Clusters.  In a bucket the sketches are compared: agreement below the binomial
   bound (missed with probability 1e-9) rules a pair out, every other one ties its
   classes together.  Chains, not pairs, leave a bucket; all chains together give
   clusters, which hold every link.  The members of a bucket of more than ``chunk``
   classes are tied together as they are.
4. Verification.  Whole sets meet once per cluster; a pair that the sketches do not rule
   out and that no links connect yet is compared exactly.  A cluster that exceeds
   ``chunk`` classes (or ``SHINGLES`` shingles) is split: its chunks are joined inside,
   then over the best connected members of their parts, and only what is still apart
   is compared chunk by chunk.

A comparison counts the common shingles of the two whole sets.  Nothing is capped:
each pair of a bucket is compared, bounded out, or connected already.
64-bit hashes stand for shingles and classes.

Results for odd input: NULL texts and texts without words have an empty set,
are their own component and link with nothing; fewer than five words make one
shingle of the whole sequence; repeated rows (equal ids) share a component and
are kept or dropped together; a NULL id is in the result, in the component of its
class if that has another id, else in component NULL and kept; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import top_k_per_key
from .common import connected, written
from .jaccard_join import BATCH, Parts, component_rows, groups_of, large_frames, moved, shingle_set, text_key
from .wordhash import WordHasher, mix

PERCENT, BANDS, ROWS = 85, 32, 5
SIZE = BANDS * ROWS
SHINGLES = 1 << 21  # shingles of a chunk, about
AT_ONCE = 2048  # shingle hashes taken together, over several rounds of a small set
SALTS = mix(np.arange(1, 2 * SIZE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketch(s: np.ndarray) -> np.ndarray:
    """The coordinates of a set of 64-bit hashes: round in the upper 16 bits, least value below."""
    out = np.full(SIZE, np.iinfo(np.uint64).max)
    step = max(1, AT_ONCE // len(s))
    for first in range(0, 2 * SIZE, step):
        rounds = np.arange(first, min(first + step, 2 * SIZE), dtype=np.uint64)[:, None]
        h = mix(s[None, :] ^ SALTS[first:first + step, None])
        drawn = ((h & np.uint64(0xFFFF)) * np.uint64(SIZE)) >> np.uint64(16)
        at = np.where(rounds < SIZE, drawn, rounds - np.uint64(SIZE))
        np.minimum.at(out, at.ravel().astype(np.int64), ((rounds << np.uint64(48)) | (h >> np.uint64(16))).ravel())
        if out.max() != np.iinfo(np.uint64).max:
            break
    return out


def agreement_bound(miss: float = 1e-9) -> int:
    """Most coordinates such that a pair at the threshold agrees in fewer with probability below ``miss``."""
    p, tail = PERCENT / 100, 0.0
    for k in range(SIZE + 1):
        tail += math.comb(SIZE, k) * p ** k * (1 - p) ** (SIZE - k)
        if tail >= miss:
            return k
    return SIZE


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, cls, marks) of every row; a task gives a class's marks once.

    ``marks``: 16 bits of every coordinate; ``key`` tells apart the texts of one id.
    """
    def rows(batches):
        hasher, seen = WordHasher(), set()
        for batch in batches:
            sizes, classes, marks = [], [], []
            for text in batch.column(2):
                s = shingle_set(hasher, text.as_py())
                n = len(s)
                cls = int(mix(mix(s + np.uint64(n)).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])
                sizes.append(n)
                classes.append(cls)
                fresh = n > 0 and cls not in seen
                if fresh:
                    seen.add(cls)
                marks.append(mix(sketch(s)).astype("<u2").tobytes() if fresh else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()),
                 pa.array(marks, pa.binary())], names=["doc_id", "key", "n", "cls", "marks"])

    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(docs).alias("key"), "text")
    return held.mapInArrow(rows, "doc_id long, key long, n long, cls long, marks binary")


def band_keys() -> Column:
    return F.array(*[F.xxhash64(F.lit(b), F.substring("marks", 2 * ROWS * b + 1, 2 * ROWS)) for b in range(BANDS)])


def buckets_of(classes: DataFrame) -> DataFrame:
    """(band, cls, m, root): members of buckets of m > 1 classes and the least of them, one bucket for each set of members."""
    keyed = classes.select("cls", F.explode(band_keys()).alias("band"))
    lists = keyed.groupBy("band").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("cls")).alias("x"),
                                      F.bit_xor(F.xxhash64("cls", F.lit(9))).alias("y"), F.min("cls").alias("root")).filter("m > 1")
    return keyed.join(lists.groupBy("m", "x", "y", "root").agg(F.min("band").alias("band")).select("band", "m", "root"), "band")


def may_link(i: int, at: np.ndarray, n: np.ndarray, marks: np.ndarray, least: int) -> np.ndarray:
    """Those places of ``at`` that sizes and sketches let link with place ``i``."""
    at = at[np.minimum(n[at], n[i]) * 100 >= np.maximum(n[at], n[i]) * PERCENT]
    return at[(marks[at] == marks[i]).sum(1) >= least]


def marks_of(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(len(column), SIZE)


def bucket_chains(members: DataFrame) -> DataFrame:
    """(a, b): classes tied together in buckets (band, cls, n, marks); b is the least class a task has tied a to."""
    least = agreement_bound()

    def rows(batches):
        up: dict[int, int] = {}  # what this task has tied in earlier buckets

        def find(c: int) -> int:
            while up.get(c, c) != c:
                up[c] = c = up.get(up[c], up[c])
            return c

        for g in groups_of(batches, "band"):
            cls, n = g["cls"].tolist(), g["n"]
            comp = [find(c) for c in cls]
            if len(set(comp)) == 1:
                continue
            parts, places, marks = Parts(len(cls)), {}, marks_of(g["marks"])
            for i, c in enumerate(comp):
                parts.join(places.setdefault(c, i), i)
            for i in range(len(cls) - 1):
                later = np.arange(i + 1, len(cls))
                for j in may_link(i, later[parts.label[later] != parts.label[i]], n, marks, least).tolist():
                    if parts.join(i, j):
                        x, y = find(cls[i]), find(cls[j])
                        up[max(x, y)] = min(x, y)
        at = list(up)
        for k in range(0, len(at), BATCH):
            yield pd.DataFrame({"a": at[k:k + BATCH], "b": [find(c) for c in at[k:k + BATCH]]})

    return (members.select("band", "cls", "n", "marks").repartition("band").sortWithinPartitions("band", "cls")
            .mapInPandas(rows, "a long, b long"))


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, n, marks, cluster, chunks, grams): whole shingle sets of classes (.., rep, key), from a row of each."""
    def rows(batches):
        hasher = WordHasher()
        for pdf in batches:
            yield pd.DataFrame({**{c: pdf[c] for c in ("cls", "n", "marks", "cluster", "chunks")},
                                "grams": [shingle_set(hasher, t).tobytes() for t in pdf["text"]]})

    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(docs).alias("_key"), "text")
    met = held.join(wanted, held["doc_id"].eqNullSafe(wanted["rep"]) & (held["_key"] == wanted["key"]))
    met = met.dropDuplicates(["doc_id", "_key"])  # repeated rows
    return met.select("cls", "n", "marks", "cluster", "chunks", "text").mapInPandas(
        rows, "cls long, n long, marks binary, cluster long, chunks int, grams binary")


def verified(keyed: DataFrame) -> DataFrame:
    """(cls, comp, root, degree) of the rows (key, cls, comp, side, n, marks, grams) of whole groups.

    ``comp`` is the part a class is known to be in; ``root`` the smallest of those
    that links join in its group; ``degree`` its links found here.  Where a group has
    two sides, only pairs across them are compared.
    """
    least = agreement_bound()

    def groups(batches):
        for g in groups_of(batches, "key"):
            comp, n, side, marks = g["comp"], g["n"], g["side"], marks_of(g["marks"])
            sets = [np.frombuffer(x, np.uint64) for x in g["grams"]]
            parts, places, degree = Parts(len(sets)), {}, np.zeros(len(sets), np.int64)
            for i, c in enumerate(comp.tolist()):  # what is joined already
                parts.join(places.setdefault(c, i), i)
            cross = side.min() != side.max()
            for i in range(len(sets) - 1):
                later = np.arange(i + 1, len(sets))
                later = later[(parts.label[later] != parts.label[i]) & ((side[later] != side[i]) if cross else True)]
                near = may_link(i, later, n, marks, least)
                for j in near[np.argsort(-degree[near], kind="stable")].tolist():  # likely centres first
                    if parts.label[i] != parts.label[j]:
                        both = np.concatenate([sets[i], sets[j]])
                        both.sort()
                        common = int((both[1:] == both[:-1]).sum())
                        if 100 * common >= PERCENT * (n[i] + n[j] - common):
                            parts.join(i, j)
                            degree[i] += 1
                            degree[j] += 1
            root = np.full(len(sets), np.iinfo(np.int64).max)
            np.minimum.at(root, parts.label, comp)
            yield {"cls": g["cls"], "comp": comp, "root": root[parts.label], "degree": degree}

    def rows(batches):
        yield from large_frames(groups(batches), BATCH)

    return (keyed.select("key", "cls", "comp", "side", "n", "marks", "grams").repartition("key").sortWithinPartitions("key", "cls")
            .mapInPandas(rows, "cls long, comp long, root long, degree long"))


def linked_parts(sets: DataFrame, chunk: int, hubs: int) -> DataFrame:
    """(cls, comp): the parts that links join in each cluster."""
    mine = F.pmod(F.xxhash64("cls", F.lit(5)), "chunks").cast("int")
    inside = written(verified(sets.withColumn("key", F.concat_ws("/", "cluster", mine)).withColumn("side", F.lit(0))
                              .withColumn("comp", F.col("cls"))), "links")
    parts = inside.select("cls", F.col("root").alias("comp"))
    large = sets.filter("chunks > 1")
    if not large.limit(1).count():
        return parts
    # over the best connected members of the chunks' parts; a part is in one group
    ranked = large.select("cls", "cluster").join(parts.join(inside.select("cls", "degree"), "cls"), "cls")
    best = top_k_per_key(ranked, ["cluster", "comp"], [F.col("degree").desc(), F.col("cls").asc()], hubs)
    n_best = best.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_best"))
    group = F.pmod(F.xxhash64("comp", F.lit(5)), F.ceil(F.col("n_best") / chunk))
    keyed = (best.join(n_best, "cluster").withColumn("key", F.concat_ws("/", "cluster", group)).withColumn("side", F.lit(0))
             .select("key", "side", "comp", "cls").join(large.select("cls", "n", "marks", "grams"), "cls"))
    over = written(verified(keyed), "links").filter("comp <> root").select("comp", "root").distinct()
    parts = written(moved(parts, over), "parts")
    # what is still apart: chunk by chunk
    still = large.join(parts, "cls")
    apart = still.groupBy("cluster").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    still = still.join(apart.select("cluster"), "cluster").withColumn("side", mine)
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.struct(
        F.least(o, F.col("side")).alias("x"), F.greatest(o, F.col("side")).alias("y")))
    rest = still.withColumn("pair", F.explode(F.filter(pairs, lambda p: p["x"] != p["y"])))
    links = written(verified(rest.withColumn("key", F.concat_ws("/", "cluster", "pair.x", "pair.y"))), "links")
    return moved(parts, connected(links, "comp", "root").withColumnsRenamed({"id": "comp", "component_id": "root"}))


def near_components(docs: DataFrame, chunk: int = 1024, hubs: int = 4) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    table = written(sketched(docs), "sketched")
    classes = written(table.filter("n > 0").groupBy("cls", "n").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"), F.max("marks").alias("marks"))
        .select("cls", "n", F.col("first.doc_id").alias("rep"), F.col("first.key").alias("key"), "marks"), "classes")
    members = written(buckets_of(classes), "members")
    small = members.filter(F.col("m") <= chunk).select("band", "cls").join(classes.select("cls", "n", "marks"), "cls")
    tied = members.filter((F.col("m") > chunk) & (F.col("cls") != F.col("root"))).select(F.col("cls").alias("a"), F.col("root").alias("b"))
    chains = written(bucket_chains(small).union(tied.distinct()), "chains")
    cluster = connected(chains).withColumnsRenamed({"id": "cls", "component_id": "cluster"})
    wanted = written(cluster.join(classes, "cls"), "clusters")
    sizes = wanted.groupBy(F.col("cluster").alias("c")).agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / chunk), F.ceil(F.sum("n") / SHINGLES)).cast("int").alias("chunks"))
    sets = written(sets_of(docs, wanted.join(sizes, F.col("cluster") == F.col("c"))), "sets")
    out = component_rows(table, classes, linked_parts(sets, chunk, hubs))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
