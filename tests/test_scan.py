"""Positional gap filling in two passes (W18 W19) against pandas."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwise.operators.scan import fill_by_position


def expected(values, method):
    s = pd.Series(values, dtype=float)
    return (s.interpolate(method="linear") if method == "linear" else s.ffill()).tolist()


@pytest.mark.parametrize("method", ["linear", "forward"])
@pytest.mark.parametrize("known", [0.3, 0.02, 0.0, 1.0])
def test_fill_matches_pandas(spark, method, known):
    """Duplicate ages, a leading gap, partitions that know nothing, a trailing gap."""
    rnd, n = random.Random(int(known * 100)), 400
    ages = sorted(rnd.randint(0, 30) for _ in range(n))
    x = [rnd.uniform(0, 9) if rnd.random() < known and 20 <= i < 370 else None for i in range(n)]
    y = [float(i) if i % 50 == 7 else None for i in range(n)]
    df = spark.createDataFrame(list(zip(range(n), ages, x, y)), "id int, age int, x double, y double").repartition(6)
    out = fill_by_position(df, [F.col("age").asc(), F.col("id").asc()], ["x", "y"], method)
    assert out.columns == df.columns
    got = out.orderBy("id").toPandas()
    for c, v in (("x", x), ("y", y)):
        want = expected(v, method)
        assert all((pd.isna(a) and pd.isna(b)) or abs(a - b) < 1e-9 for a, b in zip(got[c], want, strict=True))


def test_fill_keeps_types_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 3.0, None), (3, None, "c")], "id int, x float, t string")
    out = fill_by_position(df, [F.col("id").asc()], ["x"])
    assert out.schema == df.schema and [r.x for r in out.orderBy("id").collect()] == [None, 3.0, 3.0]
    assert fill_by_position(df.limit(0), [F.col("id").asc()], ["x"]).count() == 0


def test_no_window_over_the_whole_table(spark):
    df = spark.range(100).selectExpr("id", "IF(id % 7 = 0, CAST(id AS double), NULL) AS x")
    plan = fill_by_position(df, [F.col("id").asc()], ["x"])._jdf.queryExecution().optimizedPlan().toString()
    whole = [line for line in plan.split("\n") if "Window [" in line and "windowspecdefinition(_part#" not in line
             and "windowspecdefinition(c#" not in line]
    assert "Window [" in plan and all("sum(_rows#" in line for line in whole)  # a row per range partition


def test_no_frame_is_read_again_for_each_row(spark):
    """Frames run from the first row on, in either direction: one up to the last row costs the square of a partition."""
    from cartwise.operators.keys import linear_fill
    df = spark.range(100).selectExpr("id", "IF(id % 7 = 0, CAST(id AS double), NULL) AS x")
    for out in (fill_by_position(df, [F.col("id").asc()], ["x"]), linear_fill(df, [], "id", ["x"])):
        plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan
