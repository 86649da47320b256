"""R1 — purchase frequency profile per customer and category.

Plan shape — one scan of the order lines, three shuffles, one action:

1. lines (output-type filter pushed to the scan, anti join on excluded
   customers, which AQE broadcasts when the list is small at run time) are
   hash-partitioned once by (customer, order): a hot customer is spread over
   tasks by order;
2. on that partitioning, without another exchange: dedupe to (customer,
   category, product, order), and flag the first row of each order and of
   each (order, category) with windows over (customer, order) — one order's
   lines, a small group;
3. one partial aggregate per (customer, category, product) gives the order
   count, the last purchase, and how many distinct orders / category-orders
   start at that product;
4. repartitioned by customer (aggregated rows, bounded by the catalog per
   customer): window sums give the distinct orders per category and per
   customer, the top product is a rank filter, the category rank a window.

The original job computes the same distinct counts in four separate
aggregations over the lines and joins them back.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import as_timestamp, pct, trim_key
from ..sources import literals as L
from .keys import top_k_per_key

LINE_COLUMNS = ("customer_id", "order_id", "product_id", "category_id", "ordered_at")


def filter_lines(lines: DataFrame, excluded: DataFrame | None = None,
                 output_types: Iterable[int] | None = L.OUTPUT_TYPES) -> DataFrame:
    """Keep the listed output types, drop excluded customers."""
    out = lines
    if isinstance(lines.schema["ordered_at"].dataType, T.StringType):
        out = out.withColumn("ordered_at", as_timestamp("ordered_at"))
    if output_types is not None:
        out = out.filter(F.col("output_type").isin(list(output_types)))
    if excluded is not None:
        out = out.join(excluded.select("customer_id"), "customer_id", "left_anti")
    return out.select(*LINE_COLUMNS)


def clean_lines(lines: DataFrame, excluded: DataFrame | None = None,
                output_types: Iterable[int] | None = L.OUTPUT_TYPES) -> DataFrame:
    """Filtered order lines without duplicate rows."""
    return filter_lines(lines, excluded, output_types).distinct()


def order_product_stats(lines: DataFrame) -> DataFrame:
    """Per (customer, category, product): distinct orders, last purchase,
    and the customer's distinct orders in the category and in total."""
    d = (lines.repartition("customer_id", "order_id")
         .groupBy("customer_id", "category_id", "product_id", "order_id")
         .agg(F.max("ordered_at").alias("ordered_at")))
    in_order = Window.partitionBy("customer_id", "order_id")
    in_order_cat = Window.partitionBy("customer_id", "order_id", "category_id")
    # a NULL order id is no order: its lines count for dates only
    real = F.col("order_id").isNotNull()
    d = (d.withColumn("_fo", (real & (F.row_number().over(
            in_order.orderBy(F.col("category_id").asc_nulls_first(), "product_id")) == 1)).cast("int"))
         .withColumn("_fc", (real & (F.row_number().over(in_order_cat.orderBy("product_id")) == 1)).cast("int"))
         .withColumn("_real", real.cast("int")))
    p = d.groupBy("customer_id", "category_id", "product_id").agg(
        F.sum("_real").alias("order_count"), F.max("ordered_at").alias("last_purchase_date"),
        F.sum("_fc").alias("_fc"), F.sum("_fo").alias("_fo"))
    p = p.repartition("customer_id")
    per_cat = Window.partitionBy("customer_id", "category_id")
    per_cust = Window.partitionBy("customer_id")
    return (p.withColumn("category_order_count", F.sum("_fc").over(per_cat))
            .withColumn("total_orders", F.sum("_fo").over(per_cust))
            .drop("_fc", "_fo"))


def _category_rank() -> Column:
    w = Window.partitionBy("customer_id").orderBy(
        F.col("category_id").isNull().asc(), F.col("category_order_count").desc(), F.col("category_id").asc())
    return F.rank().over(w)


def category_frequency(lines: DataFrame) -> DataFrame:
    """Per (customer, category): distinct orders, share of the customer's
    orders (percent, 2 digits) and rank; NULL category ranks last (A1 A2 F16 W1)."""
    cats = (order_product_stats(lines).groupBy("customer_id", "category_id")
            .agg(F.first("category_order_count").alias("category_order_count"),
                 F.first("total_orders").alias("total_orders")))
    return cats.select(
        "customer_id", "category_id", "category_order_count", "total_orders",
        pct("category_order_count", "total_orders").alias("category_freq"),
        _category_rank().alias("category_rank"))


def _top_product(stats: DataFrame) -> DataFrame:
    return top_k_per_key(stats, ["customer_id", "category_id"],
                         [F.col("order_count").desc(), F.col("last_purchase_date").desc(),
                          F.col("product_id").asc()], k=1, method="rank")


def top_product_per_category(lines: DataFrame) -> DataFrame:
    """The most-ordered product per (customer, category); ties by the latest
    purchase, then the smallest product id (A3 A4 W2)."""
    return _top_product(order_product_stats(lines)).select(
        "customer_id", "category_id", "product_id", "order_count", "last_purchase_date")


def attach_model_code(df: DataFrame, model_map: DataFrame, product_col: str = "product_id",
                      code_col: str = "product_code", one_code: bool = False) -> DataFrame:
    """Left join of the model code on blank-trimmed product codes.

    A product with several codes fans out, as a left join does (T15);
    ``one_code=True`` keeps the smallest code instead.
    """
    m = model_map.select(trim_key(code_col).alias("_code"), "model_code")
    if one_code:
        m = m.groupBy("_code").agg(F.min("model_code").alias("model_code"))
    # one row a product: joined by shuffle, as the size of its compressed file would
    # let the planner send the whole map through the driver
    out = df.join(m.hint("merge"), trim_key(product_col) == F.col("_code"), "left")
    return out.drop("_code")


def frequency_profile(lines: DataFrame, excluded: DataFrame | None = None,
                      model_map: DataFrame | None = None,
                      output_types: Iterable[int] | None = L.OUTPUT_TYPES) -> DataFrame:
    """Top product per (customer, category) with category statistics.

    NULL categories and NULL customers keep their rows, but their statistics
    stay NULL, as the original equality joins on a NULL key give (T4).
    """
    top = _top_product(order_product_stats(filter_lines(lines, excluded, output_types)))
    known = F.col("category_id").isNotNull() & F.col("customer_id").isNotNull()
    out = top.select(
        "customer_id", "category_id", "product_id", "order_count",
        F.when(known, F.col("category_order_count")).alias("total_orders_in_category"),
        F.when(known, pct("order_count", "category_order_count")).alias("product_freq_in_category"),
        "last_purchase_date",
        F.when(known, pct("category_order_count", "total_orders")).alias("category_freq"),
        F.when(known, _category_rank()).alias("category_rank"))
    if model_map is not None:
        out = attach_model_code(out, model_map)
    return out
