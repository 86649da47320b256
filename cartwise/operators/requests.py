"""S10 J17 — similarity requests from a table of candidate blocks.

A request offers up to 1000 other products of its category, whether or not
they share a value.  Pairing products one by one would make a row for each
(product, candidate); here each category's profiles are put in order and
packed into blocks of fixed size, with positions as offsets.  A request takes
a run of positions from a repeatable start, wraps around at the end, and leaves
out its own position (or its own brand's, which the order keeps together).
That is at most four stretches of positions, nearly always within a window of a
few blocks: windows are built once (each text is in as many as a window has blocks),
and a request is cut out of its window after one equi join on (category, window), so
its lines, a thousand times the input, are never shuffled.  Only a run that skips more of its own
brand than a window holds is put together from single blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import literals as L
from .keys import first_per_key, group_positions, pick_index

BLOCK = 250


def one_profile(profiles: DataFrame) -> DataFrame:
    """One profile per product: the first by category, brand and name."""
    return first_per_key(profiles, "product_code", [F.col(c).asc_nulls_first() for c in (
        "category_id", "brand_id", "product_name")])


def placed_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles with ``pos`` in their category by (brand, code), ``n``, and their brand's range ``low``..``high``."""
    ensure_checkpoint_dir(profiles.sparkSession)
    rows = one_profile(profiles).filter(F.col("category_id").isNotNull())
    rows = group_positions(rows.select("product_code", "category_id", "brand_id", "text_for_llm"), ["category_id"],
                           ["brand_id", "product_code"])
    ends = rows.groupBy(F.col("category_id").alias("_c"), F.col("brand_id").alias("_b")).agg(
        F.min("pos").alias("low"), (F.max("pos") + 1).alias("high"))
    return rows.join(ends, (F.col("category_id") == F.col("_c")) & F.col("brand_id").eqNullSafe(F.col("_b"))).drop("_c", "_b")


def candidate_blocks(placed: DataFrame, size: int = BLOCK) -> DataFrame:
    """(category_id, block, lines): the profile texts of ``size`` consecutive positions."""
    return placed.groupBy("category_id", F.floor(F.col("pos") / size).cast("long").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "text_for_llm"))).alias("_l")).select(
        "category_id", "block", F.col("_l.text_for_llm").alias("lines"))


def block_windows(blocks: DataFrame, placed: DataFrame, reach: int, size: int = BLOCK) -> DataFrame:
    """(category_id, window, lines): the lines of ``reach`` blocks from block ``window`` on, around the category's end.

    A category of no more blocks has one window, the whole of it from position 0 on.
    """
    many = F.ceil(F.col("n") / size)
    counts = placed.groupBy("category_id").agg(F.max("n").alias("n")).select("category_id", many.cast("long").alias("_many"))
    steps = F.when(F.col("_many") <= reach, F.array(F.col("block"))).otherwise(F.sequence(F.lit(0).cast("long"), F.lit(reach - 1).cast("long")))
    rows = blocks.join(counts, "category_id").select("category_id", "_many", "block", "lines", F.explode(steps).alias("_step"))
    window = F.pmod(F.col("block") - F.col("_step"), F.col("_many"))
    return rows.groupBy("category_id", window.alias("window")).agg(
        F.array_sort(F.collect_list(F.struct("_step", "lines"))).alias("_l")).select(
        "category_id", "window", F.flatten("_l.lines").alias("lines"))


def stretches(n: Column, low: Column, high: Column, start: Column, count: Column) -> Column:
    """Position ranges (from, to) of ``count`` places from ``start`` on around the ``n`` positions outside low..high."""
    others = n - (high - low)

    def places(a: Column, b: Column) -> Column:  # of the others, a..b, as positions before and after the gap
        return F.array(F.struct(a.alias("a"), F.least(b, low).alias("b")),
                       F.struct((F.greatest(a, low) + high - low).alias("a"), (b + high - low).alias("b")))

    end = start + count
    both = F.concat(places(start, F.least(end, others)), places(F.lit(0).cast("long"), F.greatest(end - others, F.lit(0))))
    return F.filter(both, lambda x: x["a"] < x["b"])


def similarity_requests(profiles: DataFrame, limit: int = L.MAX_SIMILAR_CANDIDATES, other_brand: bool = False,
                        block: int = BLOCK, seed: str = "similar") -> DataFrame:
    """One request per product: product_code, target_text, n_candidates, candidates.

    ``candidates``: the texts of the first ``limit`` other products of the category
    (of another brand if asked, NULL against a value counting as another), from a
    start that the product's code picks, one per line.  A product without a
    category, or alone in it, gets none.
    """
    placed = placed_profiles(profiles).checkpoint(eager=True)
    low, high = (F.col("low"), F.col("high")) if other_brand else (F.col("pos"), F.col("pos") + 1)
    others = F.col("n") - (high - low)
    reach = -(-(limit + 1 + 2 * (block - 1)) // block)
    want = placed.select("product_code", F.col("text_for_llm").alias("target_text"), "category_id", "n", low.alias("low"), high.alias("high"),
                         F.least(others, F.lit(limit)).alias("count"),
                         F.when(others > 0, pick_index(others, F.col("product_code"), seed=seed)).alias("start"))
    served = (F.col("count") > 0) & F.col("product_code").isNotNull()
    alone = want.filter(~served).select("product_code", "target_text").unionByName(
        one_profile(profiles).filter(F.col("category_id").isNull()).select("product_code", F.col("text_for_llm").alias("target_text")))
    want = want.filter(served).withColumn("s", stretches(*[F.col(c) for c in ("n", "low", "high", "start", "count")]))
    short = F.ceil(F.col("n") / block) <= reach
    want = want.withColumn("window", F.when(short, F.lit(0).cast("long")).otherwise(F.floor(F.element_at("s", 1)["a"] / block)))
    first = F.col("window") * block
    held = F.when(short, F.col("n")).otherwise(F.lit(reach * block - block + 1))
    inside = F.forall("s", lambda x: F.pmod(x["a"] - first, F.col("n")) + x["b"] - x["a"] <= held)
    want = want.withColumn("inside", inside)
    # nearly all: cut out of one window, in one row; nothing of the texts is shuffled after
    blocks = candidate_blocks(placed, block)
    one = want.filter("inside").join(block_windows(blocks, placed, reach, block).hint("merge"), ["category_id", "window"])
    one = one.select("product_code", "target_text", F.flatten(F.transform("s", lambda x: F.slice(
        "lines", (F.pmod(x["a"] - first, F.col("n")) + 1).cast("int"), (x["b"] - x["a"]).cast("int")))).alias("_l"))
    # a run that skips more of its own brand than a window holds: block by block
    want = want.filter(~F.col("inside"))
    want = want.select("product_code", "target_text", "category_id", F.posexplode("s").alias("part", "s"))
    first, last = F.floor(F.col("s.a") / block), F.floor((F.col("s.b") - 1) / block)
    want = want.select("product_code", "target_text", "category_id", "part", "s", F.explode(F.sequence(first, last)).alias("block"))
    met = want.join(blocks.hint("merge"), ["category_id", "block"])
    begin = F.greatest(F.col("s.a") - F.col("block") * block, F.lit(0))
    upto = F.least(F.col("s.b") - F.col("block") * block, F.lit(block))
    met = met.select("product_code", "target_text", "part", "block", F.slice("lines", (begin + 1).cast("int"), (upto - begin).cast("int")).alias("l"))
    far = met.groupBy("product_code", "target_text").agg(F.array_sort(F.collect_list(F.struct("part", "block", "l"))).alias("_l"))
    lines = one.unionByName(far.select("product_code", "target_text", F.flatten("_l.l").alias("_l")))
    out = lines.select("product_code", "target_text", F.size("_l").cast("long").alias("n_candidates"), F.array_join("_l", "\n").alias("candidates"))
    return out.unionByName(alone.select("product_code", "target_text", F.lit(0).cast("long").alias("n_candidates"), F.lit("").alias("candidates")))
