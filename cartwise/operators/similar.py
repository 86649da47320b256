"""R9-R11 — attribute importance, product profiles, similar products.

All categories run in one job (the original job runs one hard-coded
category per run).  Aggregates are per (category, property, value);
profiles are per product with at most ``max_props`` pairs; similar
products go through :func:`pair_top_n`, so a value shared by a large part of
a category is never expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip, trim_key
from ..sources import literals as L
from .keys import top_k_per_key
from .pairs import DEFAULT_HOT_THRESHOLD, pair_top_n


def active(properties: DataFrame, status_ids: Iterable[int] | None = L.ACTIVE_STATUS_IDS) -> DataFrame:
    """Products on sale only."""
    if status_ids is None:
        return properties
    return properties.filter(F.col("status_id").isin(list(status_ids)))


def real_value(value: Column, placeholder: str = L.PLACEHOLDER_VALUE) -> Column:
    """A filled-in value: not NULL, not blank, not the placeholder."""
    return value.isNotNull() & (strip(value) != "") & (value != placeholder)


def listed_properties(properties: DataFrame, list_col: str = "list_property",
                      group: str = "category_id") -> DataFrame:
    """Property ids named in the comma lists, per category.

    ``"3,-1, x"`` -> 3: split, tolerant cast, positive only.
    """
    d = properties.select(group, list_col).distinct()
    d = d.select(group, F.explode(F.split(F.col(list_col), ",")).alias("_p"))
    return (d.select(group, strip("_p").try_cast("int").alias("property_id"))
            .filter(F.col("property_id") > 0).distinct())


def attributes_in_list(properties: DataFrame, group: str = "category_id") -> DataFrame:
    """(category, property id, name) of the listed properties."""
    allowed = listed_properties(properties, group=group)
    return (properties.select(group, "property_id", "property_name").distinct()
            .join(allowed, [group, "property_id"], "left_semi"))


def normalize_weights(df: DataFrame, keys, order, weight: str = "weight",
                      top_k: int = L.ATTRIBUTE_TOP_K, digits: int = 6) -> DataFrame:
    """Missing weight -> round(1/n, 6); divide by the sum and round;
    then keep the first ``top_k`` by ``order`` (normalise before the cut, T13)."""
    w = Window.partitionBy(*keys)
    n = F.count(F.lit(1)).over(w)
    filled = df.withColumn(weight, F.coalesce(F.col(weight), F.round(F.lit(1.0) / n, digits)))
    s = F.sum(weight).over(w)
    filled = filled.withColumn(weight, F.when(s > 0, F.round(F.col(weight) / s, digits))
                               .otherwise(F.col(weight)))
    return top_k_per_key(filled, keys, order, top_k, rank_col="attr_rank")


def attribute_importance(properties: DataFrame, top_k: int = L.ATTRIBUTE_TOP_K,
                         group: str = "category_id") -> DataFrame:
    """R9 (re-aimed): weight of each listed attribute of a category.

    coverage = products with a real value / products in the category;
    H = -sum p ln p over the value shares; raw = coverage * H / ln(max(2, n)).
    Ordered by raw (9 digits) desc, then name; weights normalised (A14).
    """
    p = properties.select(group, trim_key("product_code").alias("code"), "property_id", "property_name",
                          F.col("value_id").alias("value"))
    n_cat = p.groupBy(group).agg(F.count_distinct("code").alias("_n"))
    attrs = attributes_in_list(properties, group)
    vals = p.filter(real_value(F.col("value"))).join(attrs, [group, "property_id", "property_name"], "left_semi")
    per_value = vals.groupBy(group, "property_id", "property_name", "value").agg(
        F.count_distinct("code").alias("_c"))
    per_attr = vals.groupBy(group, "property_id", "property_name").agg(F.count_distinct("code").alias("_with"))
    share = per_value.join(per_attr, [group, "property_id", "property_name"]).withColumn(
        "_p", F.col("_c") / F.col("_with"))
    ent = share.groupBy(group, "property_id", "property_name").agg(
        (-F.sum(F.col("_p") * F.log(F.col("_p")))).alias("_h"), F.first("_with").alias("_with"))
    scored = attrs.join(ent, [group, "property_id", "property_name"], "left").join(n_cat, group)
    raw = (F.coalesce(F.col("_with"), F.lit(0)) / F.col("_n")) * F.coalesce(F.col("_h"), F.lit(0.0)) / \
        F.log(F.greatest(F.lit(2), F.col("_n")))
    scored = scored.select(group, "property_id", "property_name", F.round(raw, 9).alias("weight"))
    out = normalize_weights(scored, [group], [F.col("weight").desc(), F.col("property_name").asc()],
                            top_k=top_k)
    return out.select(group, "property_id", "property_name", "weight", "attr_rank")


def top_attributes(properties: DataFrame, weights: DataFrame, k: int = 1,
                   group: str = "category_id") -> DataFrame:
    """Property rows of each category's ``k`` most important attributes (R9
    feeding R10/R11; the original job profiles and compares on the top one)."""
    chosen = weights.filter(F.col("attr_rank") <= k).select(group, "property_id")
    return properties.join(chosen, [group, "property_id"], "left_semi")


def product_profiles(properties: DataFrame, max_props: int = L.MAX_PROPS_PER_PROFILE) -> DataFrame:
    """``name@@code | p: v; p: v | Category: c | Brand: b`` per product.

    Distinct (code, property, value); the first ``max_props`` by property id,
    name, value (W9); pairs joined in that order (A12).  NULL parts become
    empty text, never the text "None" (F7).
    """
    p = properties.select(trim_key("product_code").alias("product_code"), strip("product_name").alias("product_name"),
                          "property_id", strip("property_name").alias("property_name"),
                          strip("value_id").alias("value"), "category_id", "brand_id").distinct()
    order = [F.col("property_id").asc(), F.col("property_name").asc(), F.col("value").asc()]
    p = top_k_per_key(p, "product_code", order, max_props, rank_col="_pos")
    pair = F.concat(F.coalesce("property_name", F.lit("")), F.lit(": "), F.coalesce("value", F.lit("")))
    g = p.groupBy("product_code", "product_name", "category_id", "brand_id").agg(
        F.array_sort(F.collect_list(F.struct("_pos", pair.alias("pair")))).alias("_pairs"))
    pairs = F.array_join(F.transform("_pairs", lambda x: x["pair"]), "; ")
    text = F.concat(F.col("product_name"), F.lit("@@"), F.col("product_code"), F.lit(" | "), pairs,
                    F.lit(" | Category: "), F.coalesce(F.col("category_id").cast("string"), F.lit("")),
                    F.lit(" | Brand: "), F.coalesce(F.col("brand_id").cast("string"), F.lit("")))
    return g.select("product_code", "product_name", "category_id", "brand_id", text.alias("text_for_llm"))


def similar_products(properties: DataFrame, weights: DataFrame | None = None, top_n: int = L.SIMILAR_TOP_N,
                     same_category_only: bool = True, exclude_same_brand: bool = False,
                     hot_threshold: int = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """R11 (re-aimed): the ``top_n`` most similar products of each product.

    Pairs share a (property, value) with a real value; same category unless
    switched off; other brand if asked (NULL brand counts as other, except
    NULL vs NULL, T3).  score = sum of attribute weights over shared pairs
    (1 where ``weights`` has none).  Order: score desc, shared desc, code.
    """
    p = properties.select(trim_key("product_code").alias("code"), "category_id", "property_id",
                          F.col("value_id").alias("value"), "brand_id").filter(real_value(F.col("value"))).distinct()
    keys = (["category_id"] if same_category_only else []) + ["property_id", "value"]
    left = p
    if weights is not None:
        # one weight per property, whatever rows repeat it
        w = weights.groupBy("category_id", "property_id").agg(F.max("weight").alias("_w"))
        left = left.join(w, ["category_id", "property_id"], "left")
        left = left.withColumn("_w", F.coalesce("_w", F.lit(1.0)))
    else:
        left = left.withColumn("_w", F.lit(1.0))
    left = left.select(F.col("code").alias("a"), *keys, "_w", "brand_id")
    right = p.select(F.col("code").alias("b"), *keys, "brand_id")
    dis = ["brand_id"] if exclude_same_brand else []
    if not exclude_same_brand:
        # a product listed under two brands still shares a value once
        left, right = left.drop("brand_id").distinct(), right.drop("brand_id").distinct()
    return pair_top_n(left, right, keys, weight="_w", distinct_on=dis, top_n=top_n,
                      hot_threshold=hot_threshold)


def similar_with_names(pairs: DataFrame, properties: DataFrame) -> DataFrame:
    """Name and category columns of the target and the alike product."""
    names = properties.select(trim_key("product_code").alias("code"), "product_name", "category_id").distinct()
    # names grow with the catalog: joined by shuffle, never sent through the driver
    return (pairs.join(names.withColumnRenamed("code", "a").hint("merge"), "a")
            .join(names.select(F.col("code").alias("b"), F.col("product_name").alias("alike_product_name")).hint("merge"), "b")
            .select(F.col("a").alias("product_code"), "product_name", "category_id",
                    F.col("b").alias("alike_product_code"), "alike_product_name", "score", "shared",
                    F.col("pair_rank").alias("alike_rank")))


def similar_errors(properties: DataFrame, pairs: DataFrame) -> DataFrame:
    """Targets without any similar product, kept apart as error rows."""
    targets = properties.select(trim_key("product_code").alias("productcode"), "product_name").distinct()
    found = pairs.select(F.col("a").alias("productcode")).distinct()
    return (targets.join(found.hint("merge"), "productcode", "left_anti")
            .select("productcode", F.col("product_name").alias("productname"),
                    F.lit("no product shares a property value").alias("error")))
