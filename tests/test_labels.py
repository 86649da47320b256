"""Literal cases of the label parsers (F8, F9, P14); FIXTURES.md §3."""

import pytest
from pyspark.sql import functions as F

from cartwise.functions.labels import age_range, size_like, strict_milk_label
from cartwise.sources.fixtures import AGE_LABELS

AGE_ANSWERS = {
    0: (0.0, 2.0, False), 1: (0.0, 6.0, False), 2: (0.0, 18.0, False), 3: (6.0, 24.0, False),
    4: (36.0, None, False), 5: (18.0, None, False), 6: (0.0, 6.0, False), 7: (12.0, 36.0, False),
    8: (6.0, 24.0, False), 9: (24.0, 24.0, False), 10: (9.0, 9.0, False), 11: (None, None, False),
    12: (None, None, False), 13: (None, None, True), 14: (None, None, True), 15: (None, None, True),
}


def test_age_labels(spark):
    df = spark.createDataFrame(AGE_LABELS, "label_no int, label string")
    r = age_range(F.col("label"))
    rows = df.select("label_no", r["min_age_months"].alias("lo"), r["max_age_months"].alias("hi"),
                     size_like(F.col("label")).alias("rej")).collect()
    for row in rows:
        lo, hi, rej = AGE_ANSWERS[row.label_no]
        assert row.rej == rej, row
        if not rej:
            assert (row.lo, row.hi) == (lo, hi), row


@pytest.mark.parametrize("text,lo,hi", [
    ("  DƯỚI 2 TUỔI  ", 0.0, 24.0),
    ("từ 1.5 tuổi đến 3 tuổi", 18.0, 36.0),
    ("2,5 - 4 tuổi", 30.0, 48.0),
    ("Sản phẩm cho trẻ sơ sinh", 0.0, 2.0),
    ("18tháng", 18.0, 18.0),
    ("khoảng 3 tuổi", None, None),
    (None, None, None),
])
def test_age_label_variants(spark, text, lo, hi):
    df = spark.createDataFrame([(text,)], "label string")
    r = df.select(age_range(F.col("label")).alias("r")).first().r
    assert (r.min_age_months, r.max_age_months) == (lo, hi)


def test_size_like_null_is_kept(spark):
    df = spark.createDataFrame([(None,), ("m",), ("XL",)], "label string")
    assert [r.x for r in df.select(size_like(F.col("label")).alias("x")).collect()] == [False, False, True]


def test_strict_milk_labels(spark):
    rows = [("Trẻ sơ sinh", 0, 1), ("0 - 6 tháng", 0, 6), ("6 - 12 tháng", 6, 6), ("1 - 2 tuổi", 12, 12),
            ("Từ 1 tuổi", 12, None), ("Từ 2 tuổi", 24, None)]
    df = spark.createDataFrame([(r[0],) for r in rows], "label string")
    got = df.select("label", strict_milk_label(F.col("label"), strict=True).alias("p")).collect()
    for g, (_, lo, width) in zip(sorted(got, key=lambda r: r.label), sorted(rows)):
        assert (g.p.min_age_months, g.p.range_months) == (lo, width)


def test_strict_milk_label_unknown(spark):
    df = spark.createDataFrame([("2 tuổi",)], "label string")
    lenient = df.select(strict_milk_label(F.col("label"), strict=False).alias("p")).first().p
    assert lenient.min_age_months is None
    with pytest.raises(Exception, match="unknown milk label"):
        df.select(strict_milk_label(F.col("label"), strict=True).alias("p")).collect()


@pytest.mark.parametrize("text,lo,hi", [
    ("Dưới 5 kg", 0.0, 5.0),
    ("từ 3 đến 6,5 kg", 3.0, 6.5),
    ("Trên 9 kg", 9.0, None),
    ("4 - 8kg", 4.0, 8.0),
    ("11 kg", 11.0, 11.0),
    ("6 tháng", None, None),
])
def test_weight_labels(spark, text, lo, hi):
    from cartwise.functions.labels import weight_range
    df = spark.createDataFrame([(text,)], "label string")
    r = df.select(weight_range(F.col("label")).alias("r")).first().r
    assert (r.min_kg, r.max_kg) == (lo, hi)


def test_age_candidates_with_weight_interval(spark):
    from cartwise.operators.ages import age_candidates, weight_ranges
    ranges = spark.createDataFrame([(1, True, 0.0, 24.0), (2, True, 0.0, 24.0), (3, True, 0.0, 24.0)],
                                   "product_id long, parsed boolean, min_age_months double, max_age_months double")
    wl = spark.createDataFrame([(1, "dưới 8 kg"), (2, "trên 10 kg")], "product_id long, label string")
    cust = spark.createDataFrame([(10, 12.0, 9.5), (11, 12.0, 7.0), (12, 20.0, 11.0)],
                                 "customer_id long, expected_age_last double, weight_kg double")
    got = age_candidates(cust, ranges, weights=weight_ranges(wl)).collect()
    by = {}
    for r in got:
        by.setdefault(r.customer_id, set()).add(r.product_id)
    assert by == {10: {3}, 11: {1, 3}, 12: {2, 3}}
