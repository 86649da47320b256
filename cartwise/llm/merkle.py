"""Merkle dataset manifest (operator 13): nested-struct rollup.

Every row is a leaf.  Leaves of a source ascend by id; every 16 consecutive
nodes have one parent.  A leaf's rank is written in base 16, and its digits
are grouped away one after the other: 16 structs (digit, digest, child) become
one row that holds them sorted and the digest of their digests.  Three digits
make a *block* of 4,096 leaves, the most a row ever nests; one shuffle by
(group, block) serves its three groupings.  Block digests are the nodes of the
next, 4,096 times smaller round, and the subroots of the sources are the nodes
of the tree above them.  On the way back the path of a block meets its nested
row in one more grouping, and three transforms and explodes take the nested
structs apart again, each adding one level of siblings to the path: no join
takes part in a proof.

Ranks come from range partitions: position inside the partition, plus the
rows of the same source in earlier partitions (one small row for each
partition and source that meet), so a source of any size spreads over tasks.

Results for odd input: NULL values hash as ``-``, an empty text as ``0:``; a
NULL id comes before all others, a NULL source before all sources; rows with
the same id in one source ascend by digest, so repeated rows are neighbours
with equal leaves; a NULL id counts as empty text where a crc is taken; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_remainder, lower_ascii, quoted, written

LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
BITS, FAN, DEPTH = 4, 16, 3  # children of a node as bits and number, levels of a block
PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """Digest of a document's row; ``text`` stands in for its text."""
    return F.sha2(F.concat(*[field(text if c == "text" and text is not None else quoted(c)) for c in LEAF_COLUMNS]), 256)


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0 by ``order`` in their group, NULL first) and ``n`` (rows of the group)."""
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    placed = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                     .withColumn("_at", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*group)  # a group has at most one run in a partition
    runs = runs.select(
        F.col("_part").alias("_p"), *[F.col(c).alias(f"_g_{c}") for c in group], "_first",
        (F.sum("_rows").over(whole.orderBy("_part")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(whole).alias("n"))
    same = F.col("_part") == F.col("_p")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    out = placed.join(runs, same).withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before"))
    return out.select(*rows.columns, "rank", "n")


def levels_of(n: Column) -> Column:
    """How often ``n`` nodes are grouped by 16 until one remains."""
    return F.when(n <= 1, 0).otherwise(F.length(F.hex(n - 1)))


def nested_blocks(nodes: DataFrame, item: Sequence[str]) -> DataFrame:
    """(g, block, levels, h, kids) from nodes (g, rank, levels, h, *item).

    ``kids`` nests three times: (digit, h, kids), at last (digit, h, item).
    A group with fewer levels left hands its one digest on unchanged.
    """
    digits = [f"d{k}" for k in range(DEPTH)]
    rows = nodes.select(
        "g", F.shiftright("rank", BITS * DEPTH).alias("block"), F.col("levels").cast("int").alias("levels"), "h",
        *[F.shiftright("rank", BITS * k).bitwiseAND(FAN - 1).cast("int").alias(d) for k, d in enumerate(digits)],
        F.struct(*item).alias("kids") if item else F.lit(0).alias("kids")).repartition("g", "block")
    for k, digit in enumerate(digits):
        rows = rows.groupBy("g", "block", "levels", *digits[k + 1:]).agg(
            F.array_sort(F.collect_list(F.struct(F.col(digit).alias("digit"), "h", "kids"))).alias("kids"))
        rows = rows.withColumn("h", F.when(F.col("levels") > k, F.sha2(F.array_join("kids.h", ""), 256))
                               .otherwise(F.col("kids")[0]["h"]))
    return rows.select("g", "block", "levels", "h", "kids")


def taken_apart(blocks: DataFrame) -> DataFrame:
    """(g, rank, h, item, above) from nested blocks whose ``above`` holds the path from the block on."""
    rows = blocks.select("g", "block", "levels", "kids", "above", F.col("block").alias("rank"), F.lit(None).cast("string").alias("h"))
    for k in reversed(range(DEPTH)):
        hs = F.col("kids.h")
        placed = F.transform("kids", lambda kid, i: F.struct(
            kid.alias("kid"), F.array_join(F.slice(hs, F.lit(1), i), "").alias("left"),
            F.array_join(F.slice(hs, i + 2, F.lit(FAN)), "").alias("right")))
        rows = rows.select("g", "levels", "rank", "above", F.explode(placed).alias("e"))
        step = F.concat(F.array(F.struct("e.left", "e.right")), F.col("above.path"))
        path = F.when(F.col("levels") > k, step).otherwise(F.col("above.path"))
        rows = rows.select(
            "g", "levels", (F.col("rank") * FAN + F.col("e.kid.digit")).alias("rank"), F.col("e.kid.h").alias("h"),
            F.col("e.kid.kids").alias("kids"), F.col("above").withField("path", path).alias("above"))
    return rows.select("g", "rank", "h", F.col("kids").alias("item"), "above")


def proved(nodes: DataFrame, item: Sequence[str], top: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(g, rank, h, item, above) of every node; ``top`` gives (g, above) for the groups' last digests (g, h)."""
    blocks = written(nested_blocks(nodes, item), "blocks")
    upper = blocks.select("g", F.col("block").alias("rank"), F.greatest(F.col("levels") - DEPTH, F.lit(0)).alias("levels"), "h")
    if (blocks.agg(F.max("levels")).first()[0] or 0) > DEPTH:
        ups = proved(upper, [], top).select("g", F.col("rank").alias("block"), "above")
    else:
        ups = top(upper.select("g", "h")).select("g", F.lit(0).cast("long").alias("block"), "above")
    empty = {c: F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in ("levels", "kids")}
    both = blocks.select("g", "block", "levels", "kids", F.lit(None).cast(ups.schema["above"].dataType).alias("above")).union(
        ups.select("g", "block", empty["levels"], empty["kids"], "above"))
    return taken_apart(both.groupBy("g", "block").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("levels", "kids", "above")]))


def manifest(docs: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """Every row's proof: doc_id, source, rank, leaf, subroot, root, path and the carried columns.

    ``path`` lists, from the leaf to the root, the digests left and right of
    the node in its run, concatenated.  ``carry``: further columns of ``docs``
    (or computed from them) by the name they get.
    """
    carry = carry or {}
    names = [f"c{i}" for i in range(len(carry))]
    leaves = written(docs.select(
        "source", "doc_id", leaf_digest().alias("h"), *[c.alias(n) for n, c in zip(names, carry.values())],
        F.monotonically_increasing_id().alias("tie")), "leaves")
    nodes = ranked(leaves, ["source"], ["doc_id", "h", "tie"]).select(
        F.col("source").alias("g"), "rank", levels_of(F.col("n")).alias("levels"), "h", "doc_id", *names)

    def root_of(rows: DataFrame) -> DataFrame:
        return rows.select("g", F.struct(F.array().cast(PATH).alias("path"), F.col("h").alias("root")).alias("above"))

    def over_sources(rows: DataFrame) -> DataFrame:
        subroots = ranked(written(rows, "subroots"), [], ["g"])
        upper = subroots.select(F.lit(0).alias("g"), "rank", levels_of(F.col("n")).alias("levels"), "h", F.col("g").alias("source"))
        out = proved(upper, ["source"], root_of)
        return out.select(F.col("item.source").alias("g"), F.struct(
            "above.path", "above.root", F.col("h").alias("subroot")).alias("above"))

    rows = proved(nodes, ["doc_id", *names], over_sources)
    return rows.select("item.doc_id", F.col("g").alias("source"), "rank", F.col("h").alias("leaf"), "above.subroot",
                       "above.root", "above.path", *[F.col(f"item.{n}").alias(c) for n, c in zip(names, carry)])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path of siblings lead to."""
    return F.aggregate(path, leaf, lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def tampered_leaf() -> Column:
    """The leaf a row has when, where 5 divides its id's crc32, its text's A-Z are lower-cased; else its own."""
    return F.when(id_remainder(F.col("doc_id"), 5) == 0, leaf_digest(lower_ascii(F.col("text")))).otherwise(leaf_digest())


def verified_manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (from the tampered leaf), verified."""
    rows = manifest(docs, {"seen": tampered_leaf()}).withColumn("folded_root", folded(F.col("seen"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
