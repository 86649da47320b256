"""R5, R6, R8 — age ranges of products, age candidates, diversification.

Range matching (customer age within a product's [min, max] months, weight
within its [min, max] kg) is an inequality join in two dimensions; here a
product is the canonical tree nodes of its ranges and a customer the
nodes above its age and weight (:mod:`intervals`), matched by equality and
then checked exactly.  Candidates are computed once per distinct age and
weight and joined back to the customers, so the work grows with the
catalog, not with customers x products.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import age_range, size_like, weight_range
from ..sources import literals as L
from .intervals import cell_of, nodes_of, pairs, path_of
from .keys import first_per_key, round_robin, top_k_per_key

KG_CELLS = 10  # cells of a kilogram


def label_ranges(labels: DataFrame, label_col: str = "label") -> DataFrame:
    """Distinct labels -> parsed (min, max), before any fill.

    Size-like labels are dropped here (their products get no range).
    """
    d = labels.select(label_col).distinct().filter(~size_like(F.col(label_col)))
    r = age_range(F.col(label_col))
    return d.select(label_col, r["min_age_months"].alias("min_age_months"),
                    r["max_age_months"].alias("max_age_months"))


def age_ranges(labels: DataFrame, label_col: str = "label", key: str = "product_id",
               categories: Iterable | None = None, properties: Iterable | None = None,
               category_col: str = "category_code", property_col: str = "propertyid",
               label_properties: Iterable | None = None) -> DataFrame:
    """Product -> [min, max] months.

    Open end -> the largest parsed maximum over all labels (A9); unparsed ->
    [0, that maximum] and ``parsed = false`` (T10); size-like -> NULL range.
    Optional allow-lists of categories and property ids (P9) apply after that
    maximum, which is taken over all labels, or over those of
    ``label_properties``; a label that these do not have has no range.
    """
    rows = labels
    if label_properties is not None:
        labels = labels.filter(F.col(property_col).isin(list(label_properties)))
    lr = label_ranges(labels, label_col)
    top = F.max("max_age_months").over(Window.partitionBy())
    lr = lr.select(label_col,
                   F.col("min_age_months").isNotNull().alias("parsed"),
                   F.coalesce("min_age_months", F.lit(0.0)).alias("min_age_months"),
                   F.coalesce("max_age_months", top).alias("max_age_months"))
    if categories is not None:
        rows = rows.filter(F.col(category_col).cast("string").isin([str(c) for c in categories]))
    if properties is not None:
        rows = rows.filter(F.col(property_col).isin(list(properties)))
    return rows.select(key, label_col).join(lr, label_col, "left")


def weight_ranges(labels: DataFrame, label_col: str = "label", key: str = "product_id") -> DataFrame:
    """Product -> [min, max] kg from weight labels; open end stays open."""
    r = weight_range(F.col(label_col))
    out = labels.select(key, r["min_kg"].alias("min_kg"), r["max_kg"].alias("max_kg"))
    return out.filter(F.col("min_kg").isNotNull())


def age_candidates(customers: DataFrame, ranges: DataFrame, k: int = L.AGE_POOL_K,
                   age_col: str = "expected_age_last", include_unparsed: bool = True,
                   weights: DataFrame | None = None, weight_col: str = "weight_kg",
                   attributes: DataFrame | None = None) -> DataFrame:
    """The best ``k`` products per customer age (re-aimed choice).

    A product matches when ``min <= age <= max`` (narrowest range if it has
    several).  With ``weights`` (product_id, min_kg, max_kg), a product that
    has a weight range must also contain the customer's weight (open end
    allowed); products without one are not restricted.  Candidates are
    computed per distinct (age, weight).  Order: parsed first, narrower
    range, closer to the middle, smaller product id.
    ``attributes`` (product_id, ...) are attached to the per-age table before
    it fans out to customers, so no customer-level join on product is needed
    (a product popular at a common age would be a hot key there).
    Returns (customer_id, age, product_id, cand_rank[, attributes]).
    """
    r = ranges.filter(F.col("min_age_months").isNotNull() & F.col("max_age_months").isNotNull())
    if not include_unparsed:
        r = r.filter("parsed")
    width = F.col("max_age_months") - F.col("min_age_months")
    r = first_per_key(r.withColumn("_width", width), "product_id",
                      [F.col("parsed").desc(), F.col("_width").asc(), F.col("min_age_months").asc()])
    r = r.filter(F.col("min_age_months") <= F.col("max_age_months"))
    wt = F.col(weight_col).cast("double") if weights is not None else F.lit(None).cast("double")
    points = customers.select(F.col(age_col).alias("age"), wt.alias("_wt")).filter(F.col("age").isNotNull()).distinct()
    nodes, path = nodes_of(cell_of(F.col("min_age_months")), cell_of(F.col("max_age_months"))), path_of(cell_of(F.col("age")))
    if weights is not None:
        # a product without a weight range takes every weight, an unknown one too
        w = first_per_key(weights.select("product_id", "min_kg", "max_kg"), "product_id",
                          [(F.col("max_kg") - F.col("min_kg")).asc_nulls_last(), F.col("min_kg").asc()])
        r = r.join(w, "product_id", "left").filter(F.col("max_kg").isNull() | (F.col("min_kg") <= F.col("max_kg")))
        kg = nodes_of(cell_of(F.col("min_kg"), KG_CELLS), cell_of(F.col("max_kg"), KG_CELLS))
        nodes, path = pairs(nodes, kg), pairs(path, path_of(cell_of(F.col("_wt"), KG_CELLS)))
    # products of one range differ by id only, so a point's best k are among each
    # range's first k: the node join grows with the ranges, not with the catalog
    same = ["parsed", "_width", "min_age_months", "max_age_months"] + (["min_kg", "max_kg"] if weights is not None else [])
    r = top_k_per_key(r, same, [F.col("product_id").asc()], k)
    m = points.withColumn("_node", F.explode(path)).join(r.withColumn("_node", F.explode(nodes)), "_node").filter(
        (F.col("age") >= F.col("min_age_months")) & (F.col("age") <= F.col("max_age_months")))
    if weights is not None:
        m = m.filter(F.col("min_kg").isNull() | ((F.col("_wt") >= F.col("min_kg")) & (
            F.col("max_kg").isNull() | (F.col("_wt") <= F.col("max_kg")))))
    mid = (F.col("min_age_months") + F.col("max_age_months")) / 2
    key = F.struct(F.col("age"), F.col("_wt"))
    best = top_k_per_key(m.withColumn("_key", key), "_key",
                         [F.col("parsed").desc(), F.col("_width").asc(),
                          F.abs(F.col("age") - mid).asc(), F.col("product_id").asc()],
                         k, rank_col="cand_rank")
    best = best.select("age", "_wt", "product_id", "cand_rank")
    extra = []
    if attributes is not None:
        best = best.join(attributes, "product_id", "left")
        extra = [c for c in attributes.columns if c != "product_id"]
    cust = customers.select("customer_id", F.col(age_col).alias("age"), wt.alias("_wt"))
    return (cust.join(best, (cust.age == best.age) & cust._wt.eqNullSafe(best._wt))
            .select("customer_id", cust.age, "product_id", "cand_rank", *extra))


def diversify(candidates: DataFrame, catalog: DataFrame | None = None, k: int = L.AGE_FINAL_K,
              max_per_item: int = L.MAX_PER_BASE_ITEM, pos_col: str = "cand_rank",
              bucket: str = "category_id") -> DataFrame:
    """At most ``max_per_item`` variants per base item, then one pick per
    category in turn (ascending category; NULL category dropped, T17) until
    ``k`` picks.  A missing base item falls back to the product id.
    Without ``catalog`` the candidates already carry the bucket and base item
    (see ``age_candidates(attributes=...)``)."""
    ext = candidates
    if catalog is not None:
        ext = ext.join(catalog.select("product_id", bucket, "item_base_id"), "product_id", "left")
    # spread by customer once, in as many parts as the cluster shuffles: all windows
    # below use it, and a few input partitions of customers are no few large sorts
    ext = ext.repartition(int(ext.sparkSession.conf.get("spark.sql.shuffle.partitions")), "customer_id")
    ext = ext.withColumn("item_base_id", F.coalesce("item_base_id", "product_id"))
    ext = top_k_per_key(ext, ["customer_id", "item_base_id"], [F.col(pos_col).asc()], max_per_item)
    out = round_robin(ext, "customer_id", bucket, [F.col(pos_col).asc()], k, name="pick")
    return out.select("customer_id", "product_id", bucket, "item_base_id", pos_col, "pick")


def unmatched(customers: DataFrame, matched: DataFrame, key: str = "customer_id") -> DataFrame:
    """Customers without any result, kept apart."""
    return customers.join(matched.select(key).distinct(), key, "left_anti")
