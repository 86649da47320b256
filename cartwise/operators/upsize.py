"""R12-R15 — next-size-up suggestions for repurchased diapers and milk.

* R12 ``size_ladder``: diaper sizes on a fixed ordinal scale, milk age
  labels ranked among the labels present; lowest rung per (product, brand).
* R13 ``upsize``: each repurchased product (cycle score >= 0.5) that sits on
  the ladder, plus one product on the next rung of the same ladder keys.
  The next rung comes from ``lead`` over the distinct rungs (no inequality
  join); the pick among that rung's products is an md5-indexed equi join,
  so no customer x candidates expansion happens.
* R14 ``link_origin``: cycle rank carried from the origin to its suggestion,
  running numbers, per-customer rank, origin + adjacent step.
* R15 ``latest_purchase``: last purchase date attached, rows of the latest
  date per (customer, category) kept.

Per-customer windows run on (customer, product) rows that are unique after
the dedupe, so a customer's partition is bounded by the two categories'
catalog size, not by order volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import strict_milk_label
from ..session import ensure_checkpoint_dir
from ..sources import literals as L
from .keys import (first_per_key, group_positions, islands, pick_index, renumber, running_count,
                   top_k_per_key)

def type_order():
    """'ori' rows before 'rcm' rows."""
    return F.when(F.col("type") == "ori", 0).otherwise(1)


def diaper_rungs(sizes: DataFrame, label_col: str = "size_label",
                 order: Sequence[str] = L.DIAPER_SIZE_ORDER) -> DataFrame:
    """Diaper size -> rung 1..8 (W16); off-ladder sizes get a NULL rung."""
    rung = F.array_position(F.array(*[F.lit(s) for s in order]), F.col(label_col)).cast("int")
    return sizes.withColumn("ranking", F.when(rung > 0, rung))


def milk_label_ranks(labels: DataFrame, label_col: str = "label", strict: bool = False) -> DataFrame:
    """Distinct milk labels -> (min, width) and their rank by min, then width
    (open-ended last), then label (F9 W15).  Unknown labels: error in strict
    mode, else a NULL rank (quarantined by the caller)."""
    d = labels.select(label_col).distinct()
    p = strict_milk_label(F.col(label_col), strict=strict)
    d = d.select(label_col, p["min_age_months"].alias("min_age_months"),
                 p["range_months"].alias("range_months"))
    ok = d.filter(F.col("min_age_months").isNotNull())
    w = Window.partitionBy().orderBy(F.col("min_age_months").asc(),
                                     F.col("range_months").asc_nulls_last(), F.col(label_col).asc())
    ranked = ok.withColumn("ranking", F.row_number().over(w))
    bad = d.filter(F.col("min_age_months").isNull()).withColumn("ranking", F.lit(None).cast("int"))
    return ranked.unionByName(bad)


def size_ladder(diapers: DataFrame, milk: DataFrame, strict: bool = False) -> DataFrame:
    """One ladder of (product_id, brand_id, category_code, ranking).

    Unknown brand is 0 on the ladder and must be coalesced the same way on
    the other side (T7).  Off-ladder rows are left out; see ``off_ladder``.
    """
    d = diaper_rungs(diapers).select(
        "product_id", F.coalesce("brand_id", F.lit(0)).cast("bigint").alias("brand_id"),
        F.lit(L.DIAPER_CATEGORY).alias("category_code"), "ranking")
    ranks = milk_label_ranks(milk, strict=strict).select("label", "ranking")
    m = milk.join(ranks, "label", "left").select(
        "product_id", F.coalesce("brand_id", F.lit(0)).cast("bigint").alias("brand_id"),
        F.lit(L.MILK_CATEGORY).alias("category_code"), "ranking")
    both = d.unionByName(m).filter(F.col("ranking").isNotNull())
    return first_per_key(both, ["product_id", "brand_id"], [F.col("ranking").asc(), F.col("category_code")])


def off_ladder(diapers: DataFrame, milk: DataFrame) -> DataFrame:
    """Quarantine: products whose label is not on the ladder."""
    d = diaper_rungs(diapers).filter(F.col("ranking").isNull()).select(
        "product_id", F.col("size_label").alias("label"), F.lit(L.DIAPER_CATEGORY).alias("category_code"))
    ranks = milk_label_ranks(milk).filter(F.col("ranking").isNull()).select("label")
    m = milk.join(ranks, "label").select("product_id", "label", F.lit(L.MILK_CATEGORY).alias("category_code"))
    return d.unionByName(m)


def _rung_steps(ladder: DataFrame, ks: list) -> DataFrame:
    """Each rung of each key with its size, and the next higher rung with its size.

    Sizes are aggregated first, so the window runs on one row per rung (a
    few per key), however many products a key or the NULL brand holds.
    """
    w = Window.partitionBy(*ks).orderBy("ranking")
    sized = ladder.groupBy(*ks, "ranking").agg(F.count(F.lit(1)).alias("_n"))
    return sized.withColumn("next_ranking", F.lead("ranking").over(w)).withColumn("_next_n", F.lead("_n").over(w))


def ladder_next(ladder: DataFrame, keys: Sequence[str] = ("category_code", "brand_id")) -> DataFrame:
    """Each ladder row with the next higher rung of its keys."""
    steps = _rung_steps(ladder, list(keys)).drop("_n", "_next_n")
    return ladder.join(steps, [*keys, "ranking"]).select(*ladder.columns, "next_ranking")


def _rung_table(ladder: DataFrame, ks: list) -> DataFrame:
    """Each row with its position in its rung (``_idx``), the rung's size, and
    the next rung with its size; positions are numbered over range
    partitions, so a large rung is no single task.  Written once: the
    origins and the picks read it."""
    ensure_checkpoint_dir(ladder.sparkSession)
    rows = group_positions(ladder.select(*ks, "ranking", "product_id"), [*ks, "ranking"], ["product_id"], "_idx", "_size")
    return rows.drop("_size").join(_rung_steps(ladder, ks), [*ks, "ranking"]).checkpoint(eager=True)


def upsize(cycle: DataFrame, catalog: DataFrame, ladder: DataFrame,
           min_score: float = L.CYCLE_MIN_SCORE,
           categories: Sequence[str] = (L.DIAPER_CATEGORY, L.MILK_CATEGORY),
           keys: Sequence[str] = ("category_code", "brand_id"), seed: str = "0") -> DataFrame:
    """Origin rows ('ori') and one next-rung suggestion each ('rcm').

    ``keys`` are the ladder keys a suggestion must share with its origin;
    ``("brand_id",)`` reproduces the brand-only lookup (T6).  The pick among
    the next rung's products is repeatable: md5 of (seed, customer, origin)
    indexes the rung's products in id order (W21).
    """
    ks = list(keys)
    brands = catalog.select("product_id", F.coalesce("brand_id", F.lit(0)).cast("bigint").alias("brand_id"))
    origin = (cycle.filter((F.col("score") >= min_score) & F.col("category_code").isin(list(categories)))
              .select("customer_id", "product_id").distinct()
              .join(brands, "product_id", "left")
              .withColumn("brand_id", F.coalesce("brand_id", F.lit(0).cast("bigint"))))
    rungs = _rung_table(ladder, ks)
    ori = origin.join(rungs.drop("_idx", "_n"), ["product_id", "brand_id"])
    if "category_code" not in ks:
        ori = ori.join(ladder.select("product_id", "brand_id", "category_code"), ["product_id", "brand_id"])
    want = ori.filter(F.col("next_ranking").isNotNull()).withColumn(
        "_idx", pick_index(F.col("_next_n"), F.col("customer_id"), F.col("product_id"), seed=seed))
    picked = rungs.select(*ks, F.col("ranking").alias("next_ranking"), "_idx", F.col("product_id").alias("_pick"))
    rcm = want.join(picked, [*ks, "next_ranking", "_idx"])
    cols = ["customer_id", "product_id", "ranking", "brand_id", "category_code", "type", "product_id_ori"]
    ori_rows = ori.select("customer_id", "product_id", "ranking", "brand_id", "category_code",
                          F.lit("ori").alias("type"), F.col("product_id").alias("product_id_ori"))
    rcm_rows = rcm.select("customer_id", F.col("_pick").alias("product_id"),
                          F.col("next_ranking").alias("ranking"), "brand_id",
                          F.lit("rcm").alias("type"), F.col("product_id").alias("product_id_ori"),
                          *(["category_code"] if "category_code" in ks else []))
    if "category_code" not in ks:
        # brand-only ladder keys: the suggestion may sit in the other category
        cat = ladder.select("product_id", "brand_id", "category_code")
        rcm_rows = rcm_rows.join(cat, ["product_id", "brand_id"], "left")
    # by customer, for this window and the running counts per customer that follow
    rows = ori_rows.unionByName(rcm_rows.select(*cols)).repartition("customer_id")
    return first_per_key(rows, ["customer_id", "product_id"],
                         [F.col("ranking").asc(), type_order().asc(), F.col("product_id_ori").asc()])


def origin_islands(rows: DataFrame) -> DataFrame:
    """Positional origin, as the sorted-table form computes it.

    Rows in (ranking, ori first, product) order per (customer, category,
    brand); every 'ori' row opens an island and heads it.
    """
    order = [F.col("ranking").asc(), type_order().asc(), F.col("product_id").asc()]
    out = _row_num(rows)
    out = islands(out, ["customer_id", "category_code", "brand_id"], order,
                  F.col("type") == "ori", "product_id", out_col="product_id_ori_pos")
    return out


def _row_num(rows: DataFrame) -> DataFrame:
    """Running number of 'rcm' rows per (customer, category); 0 for 'ori' (W11)."""
    order = [F.col("ranking").asc(), type_order().asc(), F.col("product_id").asc()]
    out = running_count(rows, ["customer_id", "category_code"], order, F.col("type") == "rcm", "_rc")
    return out.withColumn("row_num", F.when(F.col("type") == "ori", F.lit(0)).otherwise(F.col("_rc"))
                          .cast("bigint")).drop("_rc")


def link_origin(rows: DataFrame, cycle: DataFrame, min_score: float = L.CYCLE_MIN_SCORE) -> DataFrame:
    """Cycle rank of the origin on both rows, per-customer rank, and the
    origin + adjacent-step filter (J13 W14 W17)."""
    ranks = (cycle.filter(F.col("score") >= min_score)
             .select("customer_id", F.col("product_id").alias("product_id_ori"),
                     F.col("rank_cycle").alias("rank_chu_ky")))
    ranks = first_per_key(ranks, ["customer_id", "product_id_ori"], [F.col("rank_chu_ky").asc()])
    out = _row_num(rows).join(ranks, ["customer_id", "product_id_ori"], "left")
    out = adjacent_step(out)
    return renumber(out, "customer_id", [F.col("rank_chu_ky").asc_nulls_last(), F.col("ranking").asc(),
                                         type_order().asc(), F.col("product_id").asc()], "rank")


def adjacent_step(rows: DataFrame) -> DataFrame:
    """Per (customer, origin): the lowest 'ori' row, and the 'rcm' rows one
    rung up — or, if none, the nearest higher one (W17).

    Windows over (customer, origin) only, in one pass (no self join).
    """
    g = Window.partitionBy("customer_id", "product_id_ori")
    is_ori = F.col("type") == "ori"
    ori_rank = F.min(F.when(is_ori, F.col("ranking"))).over(g)
    out = rows.withColumn("_step", F.col("ranking") - ori_rank)
    up = (~is_ori) & (F.col("_step") > 0)
    out = (out.withColumn("_has1", F.max(F.when(up & (F.col("_step") == 1), 1).otherwise(0)).over(g))
           .withColumn("_o", F.row_number().over(g.orderBy(is_ori.desc(), F.col("ranking"), F.col("product_id"))))
           .withColumn("_u", F.row_number().over(g.orderBy(up.desc(), F.col("_step"), F.col("product_id")))))
    keep = ((is_ori & (F.col("_o") == 1))
            | (up & (F.col("_has1") == 1) & (F.col("_step") == 1))
            | (up & (F.col("_has1") == 0) & (F.col("_u") == 1)))
    return out.filter(keep).drop("_step", "_has1", "_o", "_u")


def last_purchase(purchases: DataFrame, date_col: str = "purchase_date") -> DataFrame:
    """Latest purchase per (customer, product), aggregated before any join."""
    return purchases.groupBy("customer_id", "product_id").agg(F.max(date_col).alias("formatted_date"))


def latest_purchase(rows: DataFrame, purchases: DataFrame) -> DataFrame:
    """The origin's last purchase date on both rows; keep the rows of
    the latest date per (customer, category), ties kept (J13 A8 A11).

    A suggestion whose origin has no purchase gets NULL (T20).
    """
    last = last_purchase(purchases).withColumnRenamed("product_id", "product_id_ori")
    out = rows.join(last, ["customer_id", "product_id_ori"], "left")
    out = out.filter(F.col("category_code").isNotNull())
    return top_k_per_key(out, ["customer_id", "category_code"],
                         [F.col("formatted_date").desc_nulls_last()], 1, method="rank")
