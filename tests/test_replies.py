"""Literal reply cases (F11-F13, A14); FIXTURES.md §3 "Replies"."""

from pyspark.sql import functions as F

from cartwise.functions.replies import attribute_list, name_list, product_list
from cartwise.functions.text import before_marker
from cartwise.operators.replies import reply_attributes, resolve_products


def names(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(name_list(F.col("t")).alias("n")).first().n


def test_bracket_first_block(spark):
    assert names(spark, 'Đây: [a, "b",  c  d ] [x]') == ["a", "b", "c d"]


def test_empty_bracket_wins_over_bullets(spark):
    assert names(spark, "[]\n- a") == []


def test_bullets(spark):
    assert names(spark, "- a\n* b\n• c") == ["a", "b", "c"]


def test_lines(spark):
    assert names(spark, 'a\n\n"b"\n') == ["a", "b"]


def test_marker(spark):
    df = spark.createDataFrame([("a@@123",), (" b @@x",)], "t string")
    assert [r.b for r in df.select(before_marker(F.col("t")).alias("b")).collect()] == ["a", "b"]


def _attrs(spark, text, allowed, top_k=5):
    replies = spark.createDataFrame([(1, text)], "request_id int, reply string")
    ok = spark.createDataFrame([(1, a) for a in allowed], "category_id int, property_name string")
    return [(r.attribute, r.weight) for r in
            reply_attributes(replies, ok, top_k=top_k).orderBy("attr_rank").collect()]


def test_attribute_weights(spark):
    text = 'x [{"attribute":" a ","weight":"0.x"},{"attribute":"b","weight":0.4},3,{"weight":1}]'
    assert _attrs(spark, text, ["a", "b"]) == [("a", 0.555556), ("b", 0.444444)]


def test_attribute_cut_is_not_renormalised(spark):
    text = '[{"attribute":"a","weight":2},{"attribute":"b","weight":1},{"attribute":"c","weight":1}]'
    assert _attrs(spark, text, ["a", "b", "c"], top_k=1) == [("a", 0.5)]


def test_attribute_not_json(spark):
    assert _attrs(spark, "xin lỗi", ["a"]) == []
    df = spark.createDataFrame([("xin lỗi",)], "t string")
    assert df.select(attribute_list(F.col("t")).alias("a")).first().a == []


def _products(spark, text):
    replies = spark.createDataFrame([(1, text)], "request_id int, reply string")
    prof = spark.createDataFrame([("12", "Máy A"), ("13", "máy b"), ("14", "MÁY B")],
                                 "product_code string, product_name string")
    return [(r.alike_product_code, r.alike_product_name) for r in
            resolve_products(replies, prof).orderBy("pos").collect()]


def test_product_object_without_brackets(spark):
    assert _products(spark, '{"code":"12 ","name":""}') == []


def test_product_code_in_brackets(spark):
    assert _products(spark, '[{"code":"12 ","name":""}]') == [("12", "Máy A")]


def test_product_name_first_profile_wins(spark):
    got = _products(spark, '[{"productcode":"","productname":"MÁY b"}, {"code":"13"}]')
    assert got == [("13", "máy b")]


def test_product_list_cut_before_filter(spark):
    items = ",".join(['{"x":1}'] * 10 + ['{"code":"12"}'])
    df = spark.createDataFrame([(f"[{items}]",)], "t string")
    assert df.select(product_list(F.col("t"), 10).alias("p")).first().p == []
