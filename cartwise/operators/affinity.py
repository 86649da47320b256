"""R2 — companion products through mapped property values.

A product's (property, value) pairs are mapped to (mapped property, mapped
value) targets; every other product holding such a target is a companion.
The score of a pair is the number of distinct (property, value, mapped
property, mapped value) combinations that link them; the best companion
per (product, companion category) is kept, ties to the smallest code.

The reference expands the many-to-many join into all pairs before
counting; here the scoring goes through :func:`pair_top_n`, which never
expands a hot target into all its pairs and returns the same top-1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import trim_key
from .frequency import attach_model_code
from .pairs import DEFAULT_HOT_THRESHOLD, pair_top_n


def _props(properties: DataFrame) -> DataFrame:
    return properties.select(trim_key("product_code").alias("product_code"), "product_name",
                             "property_id", "value_id", "property_name", "category_id")


def companion_sources(properties: DataFrame, mapping: DataFrame) -> DataFrame:
    """Each product's mapped targets, weighted by the number of distinct
    source combinations that reach them (J3 J5 P15)."""
    p = _props(properties)
    m = mapping.select("property_id", "value_id", "property_id_map", "value_id_map").distinct()
    main = p.join(m, ["property_id", "value_id"]).select(
        "product_code", "property_id", "value_id", "property_name",
        "property_id_map", "value_id_map").distinct()
    return main.groupBy("product_code", "property_id_map", "value_id_map").agg(
        F.count(F.lit(1)).alias("links"))


def companion_products(properties: DataFrame, mapping: DataFrame,
                       model_map: DataFrame | None = None,
                       hot_threshold: int = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """R2: best companion per (product, companion category)."""
    p = _props(properties)
    left = companion_sources(properties, mapping).select(
        F.col("product_code").alias("a"), "property_id_map", "value_id_map", "links")
    right = p.select(F.col("product_code").alias("b"), F.col("category_id").alias("category_id_sub"),
                     F.col("property_id").alias("property_id_map"),
                     F.col("value_id").alias("value_id_map"))
    top = pair_top_n(left, right, ["property_id_map", "value_id_map"], weight="links",
                     partition=["category_id_sub"], top_n=1, hot_threshold=hot_threshold,
                     tie_by_shared=False)
    # names grow with the catalog: joined by shuffle, as the size of a compressed
    # file would let the planner send them all through the driver
    names = p.select("product_code", "product_name").distinct().hint("merge")
    out = (top.join(names.withColumnRenamed("product_code", "a"), "a")
           .join(names.select(F.col("product_code").alias("b"),
                              F.col("product_name").alias("product_name_sub")).hint("merge"), "b")
           .select(F.col("a").alias("product_code"), "product_name",
                   F.col("b").alias("product_code_sub"), "product_name_sub", "category_id_sub",
                   F.col("score").cast("bigint").alias("score")))
    if model_map is not None:
        out = attach_model_code(out, model_map, product_col="product_code_sub")
    return out
