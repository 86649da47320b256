"""R16-R18 — append ranked lists, cold start, final blended top 30.

All steps are windows per customer over lists that are already capped or
bounded by the catalog (upsize rows, <= 15 age picks, per-product
frequency rows), joined by equality on customer or product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import literals as L
from .frequency import attach_model_code
from .keys import renumber, top_k_per_key

BLEND_COLUMNS = ("customer_id", "product_id", "rank", "brand_id", "category_code", "category_name",
                 "product_name", "rank_chu_ky", "formatted_date", "type", "row_num", "product_id_ori")


def _priority(col: str = "type") -> F.Column:
    return F.array_position(F.array(*[F.lit(t) for t in L.SOURCE_PRIORITY]), F.col(col))


def append_ranked(first: DataFrame, second: DataFrame, second_type: str = "age_rcm",
                  first_order: str = "rank", second_order: str = "pick",
                  cap: int = L.BLEND_CAP, how: str = "inner") -> DataFrame:
    """Renumber the first list 1..n per customer, put the second list
    after it (n+1, n+2, ...), union by name, keep ``cap`` per customer.

    ``how="inner"`` keeps the second list only for customers of the first,
    as the job does (T14); ``how="left"`` starts them at 1.  One union and
    windows per customer; each list is read once.
    """
    f = first.withColumn("_src", F.lit(0)).withColumnRenamed(first_order, "_o")
    s = second.withColumn("type", F.lit(second_type)).withColumn("_src", F.lit(1)).withColumnRenamed(second_order, "_o")
    # by customer once, for the windows of both lists
    both = f.unionByName(s, allowMissingColumns=True).repartition("customer_id")
    both = renumber(both, ["customer_id", "_src"], [F.col("_o").asc(), F.col("product_id").asc()], "_rr").drop("_o")
    top = F.max(F.when(F.col("_src") == 0, F.col("_rr"))).over(Window.partitionBy("customer_id"))
    both = both.withColumn("_max", top)
    if how == "inner":
        both = both.filter((F.col("_src") == 0) | F.col("_max").isNotNull())
    both = both.withColumn("_rr", F.when(F.col("_src") == 1, F.col("_rr") + F.coalesce("_max", F.lit(0)))
                           .otherwise(F.col("_rr"))).drop("_max", "_src")
    both = top_k_per_key(both, "customer_id", [F.col("_rr").asc(), _priority().asc(),
                                               F.col("product_id").asc()], cap)
    return both.withColumnRenamed("_rr", "rank").withColumn("rank", F.col("rank").cast("int"))


def frequency_list(purchases: DataFrame, date_col: str = "purchase_date",
                   customers: DataFrame | None = None) -> DataFrame:
    """Stand-in frequency recommendations: per (customer, product) the number
    of purchase dates and the last one; of ``customers`` only, if given."""
    if customers is not None:
        # hashed customers of a part, so that the purchases are not sorted
        purchases = purchases.join(customers.hint("shuffle_hash"), "customer_id", "left_semi")
    return purchases.groupBy("customer_id", "product_id").agg(
        F.count_distinct(date_col).alias("freq"), F.max(date_col).alias("last_date"))


def cold_customers(cycle: DataFrame, min_score: float = L.CYCLE_MIN_SCORE,
                   categories=(L.DIAPER_CATEGORY, L.MILK_CATEGORY)) -> DataFrame:
    """Customers of the cycle table without any usable row."""
    usable = (F.col("score") >= min_score) & F.col("category_code").isin(list(categories))
    return (cycle.groupBy("customer_id").agg(F.max(usable.cast("int")).alias("_u"))
            .filter(F.coalesce("_u", F.lit(0)) == 0).select("customer_id"))


def cold_start(cycle: DataFrame, frequency: DataFrame, min_score: float = L.CYCLE_MIN_SCORE,
               categories=(L.DIAPER_CATEGORY, L.MILK_CATEGORY)) -> DataFrame:
    """Customers of the cycle table without any usable row get their
    frequency list, ranked by frequency, then recency, then id (J2 W8); one
    without such a list stays as one row without a product.

    ``frequency`` need not hold other customers (see ``frequency_list``)."""
    rows = cold_customers(cycle, min_score, categories).join(frequency, "customer_id", "left")
    rows = renumber(rows, "customer_id", [F.col("freq").desc(), F.col("last_date").desc(),
                                          F.col("product_id").asc()], "rank")
    return rows.select("customer_id", "product_id", F.col("rank").cast("int").alias("rank"),
                       F.lit("freg_rcm").alias("type"), F.col("last_date").alias("formatted_date"))


def blend(ranked: DataFrame, cold: DataFrame, catalog: DataFrame, model_map: DataFrame | None = None,
          cap: int = L.BLEND_CAP) -> DataFrame:
    """Union, one row per (customer, product) — lowest rank, then source
    priority ori, rcm, age_rcm, freg_rcm (T16) — cap per customer, catalog
    columns, model code."""
    # by customer once, for both cuts
    both = ranked.unionByName(cold, allowMissingColumns=True).repartition("customer_id")
    order = [F.col("rank").asc(), _priority().asc(), F.col("product_id").asc()]
    both = top_k_per_key(both, ["customer_id", "product_id"], order, 1)
    both = top_k_per_key(both, "customer_id", order, cap)
    cat = catalog.select("product_id", F.col("brand_id").alias("_brand"), F.col("category_code").alias("_cat"),
                         "category_name", "product_name")
    out = both.join(cat, "product_id", "left").withColumn(
        "brand_id", F.coalesce("brand_id", "_brand")).withColumn(
        "category_code", F.coalesce("category_code", "_cat")).drop("_brand", "_cat")
    out = out.select(*[F.col(c) if c in out.columns else F.lit(None).alias(c) for c in BLEND_COLUMNS])
    out = out.withColumn("row_num", F.col("row_num").cast("bigint"))
    if model_map is not None:
        out = attach_model_code(out, model_map)
    return out


def cap_per_customer(df: DataFrame, order, cap: int = L.BLEND_CAP, name: str = "rn") -> DataFrame:
    """Keep the first ``cap`` rows per customer."""
    return top_k_per_key(df, "customer_id", order, cap, rank_col=name)
