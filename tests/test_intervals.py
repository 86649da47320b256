"""Canonical nodes of ranges and paths of points."""

import random

from pyspark.sql import functions as F

from cartwise.operators.ages import age_candidates
from cartwise.operators.intervals import cell_of, nodes_of, path_of


def test_a_point_meets_its_ranges_once(spark):
    rnd, bits = random.Random(1), 5
    ranges = [(i, *sorted((rnd.randint(0, 31), rnd.randint(0, 31)))) for i in range(150)] + [(900, None, 7), (901, 9, None), (902, None, None)]
    r = spark.createDataFrame(ranges, "id int, a int, b int").select("id", F.explode(nodes_of(F.col("a"), F.col("b"), bits)).alias("node"))
    p = spark.range(32).select(F.col("id").cast("int").alias("c"), F.explode(path_of(F.col("id").cast("int"), bits)).alias("node"))
    got = sorted((x.id, x.c) for x in r.join(p, "node").collect())
    assert got == sorted((i, c) for i, a, b in ranges for c in range(32) if (a or 0) <= c <= (31 if b is None else b))
    assert max(x["count"] for x in r.groupBy("id").count().collect()) <= 2 * bits


def test_cells_and_unknown_points(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,), (5.96,), (9e9,), (None,)], "x double")
    got = {r.x: r.c for r in df.select("x", cell_of(F.col("x"), 10, 6).alias("c")).collect()}
    assert got == {-3.0: 0, 0.0: 0, 5.96: 59, 9e9: 63, None: None}
    assert df.filter("x IS NULL").select(path_of(cell_of(F.col("x")))).first()[0] == [1]


def test_age_and_weight_match_brute_force(spark):
    rnd = random.Random(4)
    ranges = [(i, f"l{i % 5}", bool(i % 3), *sorted((round(rnd.uniform(0, 40), 1), round(rnd.uniform(0, 40), 1)))) for i in range(120)]
    kg = [(i, lo, None if i % 4 == 0 else lo + rnd.uniform(0, 6)) for i in range(0, 120, 2) for lo in [round(rnd.uniform(0, 20), 2)]]
    people = [(c, None if c % 11 == 0 else round(rnd.uniform(0, 42), 1), None if c % 7 == 0 else round(rnd.uniform(0, 25), 3)) for c in range(60)]
    r = spark.createDataFrame(ranges, "product_id int, label string, parsed boolean, min_age_months double, max_age_months double")
    w = spark.createDataFrame(kg, "product_id int, min_kg double, max_kg double")
    c = spark.createDataFrame(people, "customer_id int, expected_age_last double, weight_kg double")
    got = {(x.customer_id, x.product_id) for x in age_candidates(c, r, k=1000, weights=w).collect()}
    limits = {i: (lo, hi) for i, lo, hi in kg}
    want = set()
    for cid, age, wt in people:
        for i, _, _, a, b in ranges:
            lo, hi = limits.get(i, (None, None))
            fits = lo is None or (wt is not None and wt >= lo and (hi is None or wt <= hi))
            if age is not None and a <= age <= b and fits:
                want.add((cid, i))
    assert got == want
