"""Rows that cannot be in a result are left out before a join multiplies them."""

import json

from cartwise.operators.ages import age_candidates, diversify
from cartwise.operators.replies import resolve_products


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_age_candidates_take_the_first_products_of_each_range(spark):
    """Many products of few ranges: as by comparing all, and each range's first products chosen before the join."""
    spans = [(0.0, 12.0, True), (6.0, 24.0, True), (0.0, 36.0, False), (6.0, 18.0, True)]
    rows = [(i, *spans[(i * 7 + i // 9) % 4]) for i in range(300)]
    cust = [(c, float(c % 40)) for c in range(60)]
    got = age_candidates(spark.createDataFrame(cust, "customer_id int, expected_age_last double"), spark.createDataFrame(
        rows, "product_id int, min_age_months double, max_age_months double, parsed boolean"), k=5)
    want = []
    for c, age in cust:
        fit = sorted((not ok, hi - lo, abs(age - (lo + hi) / 2), p) for p, lo, hi, ok in rows if lo <= age <= hi)
        want += [(c, age, f[-1], i + 1) for i, f in enumerate(fit[:5])]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert "windowspecdefinition(parsed#" in _plan(got)


def test_picks_are_spread_by_customer_before_their_windows(spark):
    cand = spark.range(40).selectExpr("id % 4 customer_id", "id product_id", "int(id) cand_rank", "id % 3 category_id", "id item_base_id")
    out = diversify(cand.coalesce(1))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "RepartitionByExpression [customer_id#" in _plan(out) and f", {n}\n" in _plan(out)
    assert {r["count"] for r in out.groupBy("customer_id").count().collect()} == {10}


def test_a_name_of_many_products_gives_an_item_one_row(spark):
    """Products that share a name or a code: the smallest code of either match, and one row a name joined."""
    prof = [(f"{i:03d}", f"Name {i % 3}" if i % 2 else f"NAME {i % 3}") for i in range(90)] + [("007", "Other"), ("500", None)]
    replies = [(1, [{"productcode": "", "productname": "name 2"}, {"productcode": "044", "productname": "name 1"}]),
               (2, [{"productcode": "500", "productname": ""}, {"productcode": "999", "productname": "none"}])]
    got = resolve_products(spark.createDataFrame([(k, json.dumps(v)) for k, v in replies], "request_id int, reply string"),
                           spark.createDataFrame(prof, "product_code string, product_name string"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0, "002", "NAME 2"), (1, 1, "001", "Name 1"), (2, 0, "500", None)]
    assert "windowspecdefinition(_low#" in _plan(got)
