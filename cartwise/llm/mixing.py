"""Mixing sources to target weights (operator 9): weighted fair queueing.

Every source is a queue of shuffled documents, long enough for two passes.
A document's virtual finish time is the cumulative size of its source, itself
included, divided by the source's target; reading all queues in the order of
finish time serves every source in proportion to its target.  The mix is that
order, cut where the total budget is reached.

Scale: the shuffle order is a hash of the id, and cumulative sizes are taken in
two levels, inside (source, hash slice) cells and over the cells' totals, so a
source with any share of the rows is spread over ``sqrt(rows)`` cells.  The
final order is a range sort on finish time: totals per range of finish time,
then only the range in which the budget runs out is sorted.  Everything is
DataFrame functions.

Results for odd input: a NULL text has size 0; a NULL source is a source of its
own, ordered last; documents of size 0 are never taken; a source of size 0 has
target 0; rows with equal ids in a source are ordered by their content hash and
size; repeated rows are independent entries; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, full_text, quoted, row_hash, written

WEIGHTS = (3, 1, 2)
BUDGET_SHARE = 1.5
MAX_EPOCHS = 2


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = BUDGET_SHARE,
                   epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, w, target) from (source, size).

    Weights repeat over the sources in code point order.  A target is
    min(epochs * size, level * weight) with the one level at which targets add
    up to the budget: sources in the order in which a rising level meets their
    limit, the level behind each prefix of limited sources, and the first one
    that fits the next source.  One row per source flows through these windows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = s.withColumn("w", pick).withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
    s = s.withColumn("r", F.col("cap") / F.col("w"))
    up = Window.orderBy("r", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.orderBy("r", F.col("source").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    s = s.withColumn("level", (total * share - F.coalesce(F.sum("cap").over(up), F.lit(0.0))) / F.sum("w").over(down))
    # the level holds from the first source on, in order of r, that can bear it
    level = -F.min(F.when(F.col("level") <= F.col("r"), F.struct("r", (-F.col("level")).alias("l")))).over(
        Window.partitionBy())["l"]
    return s.select("source", "source_size", "w",
                    F.when(level.isNull(), F.col("cap"))
                    .otherwise(F.least("cap", level * F.col("w"))).alias("target"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = BUDGET_SHARE, epochs: int = MAX_EPOCHS,
                seed: int = 17) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken (words), times (passes taken)."""
    sized = written(docs.select("doc_id", "source", n_words(full_text(docs)).alias("size"),
                                F.xxhash64(F.col("doc_id"), row_hash(docs), F.lit(seed)).alias("h"),
                                row_hash(docs).alias("th")), "sizes")
    rows = sized.count()
    cells = max(1, math.isqrt(rows))
    targets = written(source_targets(sized, weights, share, epochs), "targets")
    queue = sized.withColumn("cell", F.floor(F.pmod("h", F.lit(1 << 40)) / F.lit((1 << 40) / cells)).cast("long"))
    totals = queue.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("source").alias("s"), F.col("cell").alias("c"),
                            F.coalesce(F.sum("cell_size").over(before), F.lit(0)).alias("offset"))
    offsets = offsets.join(targets, offsets["s"].eqNullSafe(targets["source"])).drop("source")
    inside = (Window.partitionBy("source", "cell").orderBy("h", "doc_id", "th", "size")
              .rowsBetween(Window.unboundedPreceding, 0))
    q = queue.withColumn("run", F.sum("size").over(inside))
    q = q.join(offsets, q["source"].eqNullSafe(offsets["s"]) & (q["cell"] == offsets["c"]))
    q = q.select("doc_id", "source", "size", "source_size", "target", "th", (F.col("run") + F.col("offset")).alias("cum"))
    passes = [(F.col("source_size") * k + F.col("cum")) / F.when(F.col("target") > 0, F.col("target"))
              for k in range(epochs)]
    q = written(q.select("doc_id", "source", "size", "source_size", "target", "th",
                         F.when(F.col("size") > 0, F.array(*passes)).alias("finish")), "finish")
    # range sort: totals per range of finish time, then the one range that holds the cut
    slot = F.least(F.floor(F.col("v") * cells), F.lit(4 * cells)).cast("long")
    entry = (q.filter("size > 0").select(F.explode("finish").alias("v"), "source", "doc_id", "size")
             .filter("v IS NOT NULL").withColumn("slot", slot))
    limit = targets.agg(F.sum("target")).first()[0] or 0.0
    run = entry.groupBy("slot").agg(F.sum("size").alias("n")).select(
        "slot", "n", F.sum("n").over(Window.orderBy("slot")).alias("end"))
    cut = run.filter(F.col("end") > limit).agg(F.min(F.struct("slot", (F.col("end") - F.col("n")).alias("served")))
                                               .alias("cut")).first()["cut"]
    key = F.struct(F.col("v"), F.col("source").isNull().alias("o"), F.coalesce("source", F.lit("")).alias("s"),
                   F.coalesce("doc_id", F.lit(-1 << 63)).alias("d"), F.col("size").alias("n"))
    if cut is None:  # the budget outlasts every queue
        taken = F.size("finish")
    else:
        edge = entry.filter(F.col("slot") == cut["slot"]).withColumn("key", key)
        edge = edge.withColumn("run", F.sum("size").over(Window.orderBy("key")
                                                         .rowsBetween(Window.unboundedPreceding, 0)))
        end = edge.filter(F.col("run") + cut["served"] <= limit).agg(F.max("key").alias("k")).first()["k"]
        start = F.lit(cut["slot"] / cells)
        if end is None:
            inside = lambda v: v < start
        else:
            at = F.struct(F.lit(end["o"]).alias("o"), F.lit(end["s"]).alias("s"),
                          F.lit(end["d"]).cast("long").alias("d"), F.lit(end["n"]).cast("long").alias("n"))
            me = F.struct(F.col("source").isNull().alias("o"), F.coalesce("source", F.lit("")).alias("s"),
                          F.coalesce("doc_id", F.lit(-1 << 63)).alias("d"), F.col("size").alias("n"))
            inside = lambda v: (v < F.lit(end["v"])) | ((v == F.lit(end["v"])) & (me <= at))
        taken = F.size(F.filter("finish", inside))
    times = F.when(F.col("finish").isNull(), F.lit(0)).otherwise(F.greatest(taken, F.lit(0)))
    return q.select("doc_id", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"),
                    times.alias("times"), "source", "th")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns unchanged."""
    plan = (mix_sources(docs, **options).filter("times > 0").groupBy("doc_id", "source", "th")
            .agg(F.sum("times").alias("times")).withColumnsRenamed({"doc_id": "p_id", "source": "p_source", "th": "p_th"}))
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), "doc_id", "source", row_hash(docs).alias("th"))
    on = (rows["doc_id"].eqNullSafe(plan["p_id"]) & rows["source"].eqNullSafe(plan["p_source"]) & (rows["th"] == plan["p_th"]))
    # rows equal in all columns are one in the plan, which counts them
    met = rows.dropDuplicates(["doc_id", "source", "th"]).join(plan, on)
    return met.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
