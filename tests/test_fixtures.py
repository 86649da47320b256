"""Non-vacuity: the derived inputs exercise the cases FIXTURES.md counts (sf0.01)."""

import pytest
from pyspark.sql import functions as F

from cartwise.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SF)


def test_sizes(fx):
    assert fx.order_lines().count() == 60000
    assert fx.excluded().count() == 122
    assert fx.catalog().count() == 2000
    assert fx.model_map().count() == 1958
    assert fx.person().count() == 1500
    assert fx.growth().count() == 11
    assert fx.size_labels().count() == 322
    assert fx.cycle().count() == 20132
    assert fx.purchases().count() == 59945
    assert fx.properties().count() == 6200
    assert fx.property_map().count() == 632
    assert fx.reply_items().count() == 6750
    assert fx.milk_product().count() == 353


def test_order_line_cases(fx):
    kept = fx.order_lines().filter(F.col("output_type").isin(1, 2, 4, 5)).join(fx.excluded(), "customer_id",
                                                                                 "left_anti")
    assert kept.count() == 31422
    projected = kept.drop("output_type")
    assert projected.count() - projected.distinct().count() == 18
    nulls = fx.order_lines().filter(F.col("category_id").isNull())
    assert nulls.count() == 1526 and nulls.select("product_id").distinct().count() == 50


def test_catalog_and_person_nulls(fx):
    cat = fx.catalog()
    assert cat.filter("brand_id IS NULL").count() == 100
    assert cat.filter("item_base_id IS NULL").count() == 134
    assert cat.count() - cat.select("product_name").distinct().count() == 311
    p = fx.person()
    assert p.filter("stage_last IS NULL").count() == 375
    assert p.filter("expected_age_last IS NULL").count() == 500


def test_cycle_and_size_cases(fx):
    c = fx.cycle()
    assert c.filter("score >= 0.5").count() == 10957
    assert c.filter("score = 0.5").count() == 2005
    usable = c.groupBy("customer_id").agg(F.max((F.col("score") >= 0.5).cast("int")).alias("u"))
    assert usable.filter("u = 0").count() == 10
    assert fx.size_labels().filter("size_label = 'FREE'").count() == 29


def test_property_cases(fx):
    assert fx.properties().filter(F.col("status_id").isin(4, 5)).count() == 2065
    per = fx.purchases().groupBy("customer_id", "product_id").count()
    assert per.filter("count > 1").count() == 550


def test_reply_cases(fx):
    items = fx.reply_items()
    assert items.select("request_id").distinct().count() == 1350
    replies = fx.name_replies()
    assert replies.count() == 1500 and replies.filter("reply = '[]'").count() == 150
