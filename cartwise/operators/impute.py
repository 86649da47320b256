"""R3, R4 — group-wise imputation and growth-table gap filling.

Aggregates here are per group (a handful of stages per cluster) or per
distinct age in months, so every window runs on a small derived table and
is joined back to the customers by equality.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import first_per_key, forward_fill, linear_fill
from .scan import fill_by_position


def group_mode(df: DataFrame, group: str, col: str, name: str | None = None) -> DataFrame:
    """Most frequent non-NULL value per group, ties to the smallest."""
    return (df.filter(F.col(col).isNotNull()).groupBy(group)
            .agg(F.mode(col, True).alias(name or f"mode_{col}")))


def impute_by_group(df: DataFrame, group: str = "prediction", mode_col: str = "stage_last",
                    mean_col: str = "expected_age_last", id_col: str = "customer_id",
                    digits: int = 0) -> DataFrame:
    """Fill ``mode_col`` with the group mode, then ``mean_col`` with the
    mean of (group, original ``mode_col``), round, one row per id.

    The mean is taken on the unfilled rows, so groups of a NULL stage never
    supply a mean (T19).
    """
    mode = group_mode(df, group, mode_col, "_mode")
    mean = (df.filter(F.col(mean_col).isNotNull()).groupBy(group, mode_col)
            .agg(F.avg(mean_col).alias("_mean")))
    filled = (df.join(mode, group, "left")
              .withColumn(mode_col, F.coalesce(F.col(mode_col), F.col("_mode"))).drop("_mode"))
    filled = (filled.join(mean, [group, mode_col], "left")
              .withColumn(mean_col, F.round(F.coalesce(F.col(mean_col), F.col("_mean")), digits))
              .drop("_mean"))
    filled = first_per_key(filled, id_col, [F.col(mode_col).asc_nulls_last(),
                                            F.col(mean_col).asc_nulls_last()])
    return filled.select(id_col, mode_col, mean_col)


def _age_grid(customers: DataFrame, growth: DataFrame, age_col: str, sheet_age: str,
              cols: Sequence[str]) -> DataFrame:
    ages = customers.select(F.col(age_col).alias("_age")).filter(F.col("_age").isNotNull()).distinct()
    known = growth.select(F.col(sheet_age).alias("_age"), *cols)
    return ages.join(known, "_age", "full")


def attach_growth(customers: DataFrame, growth: DataFrame, age_col: str = "expected_age_last",
                  sheet_age: str = "age_months", cols: Sequence[str] = ("weight_kg", "height_cm"),
                  digits: int = 6) -> DataFrame:
    """Growth values by age, linear between sheet ages, nearest at the
    ends (W18).  Works on distinct ages, so customers of one age always get
    one answer (T8); a NULL age gets NULL values."""
    grid = linear_fill(_age_grid(customers, growth, age_col, sheet_age, cols), [], "_age", list(cols))
    grid = grid.select(F.col("_age").alias(age_col), *[F.round(c, digits).alias(c) for c in cols])
    return customers.join(grid, age_col, "left")


def carry_growth_forward(customers: DataFrame, growth: DataFrame, age_col: str = "expected_age_last",
                         sheet_age: str = "age_months",
                         cols: Sequence[str] = ("weight_kg", "height_cm")) -> DataFrame:
    """Forward fill along age: each age takes the values of the largest
    sheet age at or below it (W19)."""
    grid = forward_fill(_age_grid(customers, growth, age_col, sheet_age, cols), [], ["_age"], list(cols))
    grid = grid.select(F.col("_age").alias(age_col), *cols)
    return customers.join(grid, age_col, "left")


def growth_by_position(customers: DataFrame, growth: DataFrame, age_col: str = "expected_age_last",
                       sheet_age: str = "age_months", cols: Sequence[str] = ("weight_kg", "height_cm"),
                       id_col: str = "customer_id", digits: int = 6) -> DataFrame:
    """The original's positional form over all customers (W18 W19): sheet values by equal age, linear
    along the rows from the oldest to the youngest, then forward along the rows from the youngest on.

    Customers of one age get different values where the age is not in the sheet
    (T8); an unknown age comes last both times, equal ages by id.
    """
    known = growth.select(F.col(sheet_age).alias(age_col), *cols)
    rows = customers.select(id_col, age_col).join(known, age_col, "left").select(id_col, age_col, *cols)
    tie = F.col(id_col).asc()
    rows = fill_by_position(rows, [F.col(age_col).desc_nulls_last(), tie], cols)
    rows = fill_by_position(rows, [F.col(age_col).asc_nulls_last(), tie], cols, "forward")
    return rows.select(id_col, age_col, *[F.round(c, digits).alias(c) for c in cols])
