"""Sinks and end-to-end jobs write what they should."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from cartwise.plans import jobs
from cartwise.sources import batches, ranged, sinks
from cartwise.sources.fixtures import Fixtures

from paths import SF_SMALL


def test_quarantine(spark):
    df = spark.range(0, 1234).withColumnRenamed("id", "customer_id")
    ok, bad = sinks.split_quarantine(df.withColumn("x", F.when(F.col("customer_id") % 2 == 0, 1)),
                                     F.col("x").isNotNull())
    assert ok.count() + bad.count() == 1234 and bad.count() == 617


def test_jobs_write(spark):
    out = tempfile.mkdtemp(prefix="cw-job-")
    fx = Fixtures(spark, SF_SMALL)
    jobs.frequency_job(fx.order_lines(), fx.excluded(), fx.model_map(), f"{out}/freq", output_types=(1, 2, 4, 5))
    jobs.companion_job(fx.properties(), fx.property_map(), fx.model_map(), f"{out}/comp", n_files=4)
    jobs.similar_job(fx.properties(), f"{out}/sim", f"{out}/sim_err")
    jobs.similar_job(fx.properties(), f"{out}/sim_top1", attribute_top_k=1)
    top1 = spark.read.schema(spark.read.parquet(f"{out}/sim").schema).parquet(f"{out}/sim_top1")
    assert top1.count() <= spark.read.parquet(f"{out}/sim").count()
    assert spark.read.parquet(f"{out}/freq").count() > 0
    assert spark.read.parquet(f"{out}/comp").count() > 0
    sim = spark.read.parquet(f"{out}/sim")
    assert sim.count() > 0 and "text_for_llm_alike" in sim.columns
    assert spark.read.parquet(f"{out}/sim").select("category_id").distinct().count() >= 1


def test_age_upsize_and_reply_jobs(spark):
    from cartwise.operators import ages, impute
    from cartwise.sources.fixtures import AGE_LABELS, MILK_LABELS, label_sheet
    out = tempfile.mkdtemp(prefix="cw-job2-")
    fx = Fixtures(spark, SF_SMALL)
    labels = fx.product_label().join(label_sheet(spark, AGE_LABELS), "label_no").select("product_id", "label")
    catalog = fx.catalog().withColumn("category_id", F.col("category_code").cast("int"))
    jobs.age_job(fx.person(), fx.growth(), labels, catalog, f"{out}/age", f"{out}/age_none", batch_size=100)
    age = batches.read_batches(spark, f"{out}/age")
    assert age.count() > 0 and "batch" in age.columns
    none = spark.read.parquet(f"{out}/age_none")
    assert none.join(age.select("customer_id").distinct(), "customer_id").count() == 0

    cust = impute.attach_growth(impute.impute_by_group(fx.person()), fx.growth())
    picks = ages.diversify(ages.age_candidates(cust, ages.age_ranges(labels)), catalog)
    milk = fx.milk_product().join(label_sheet(spark, MILK_LABELS), "label_no").select("product_id", "brand_id", "label")
    jobs.upsize_job(fx.cycle(), fx.catalog(), fx.size_labels(), milk, fx.purchases(), picks, fx.model_map(),
                    f"{out}/blend")
    blend = spark.read.parquet(f"{out}/blend")
    assert blend.count() > 0
    assert blend.groupBy("customer_id").agg(F.count_distinct("product_id").alias("n")).agg(F.max("n")).first()[0] <= 30

    table, observed = jobs.name_reply_job(fx.name_replies(), fx.catalog(), f"{out}/names", f"{out}/names_none")
    metrics = table.first()
    assert observed["product_rows"] == metrics.product_rows
    assert observed["fuzzy_rows"] > 0
    assert metrics.requests == fx.person().count()
    assert metrics.matched_requests + metrics.unmatched_requests == metrics.requests
    assert spark.read.parquet(f"{out}/names_none").count() == metrics.unmatched_requests


def test_run_date_partitions(spark):
    out = tempfile.mkdtemp(prefix="cw-day-")
    df = spark.range(0, 10).withColumnRenamed("id", "customer_id")
    sinks.write_table(sinks.with_run_date(df, "20261201"), out, partition_by=["run_date"])
    sinks.write_table(sinks.with_run_date(df.limit(3), "20261202"), out, partition_by=["run_date"])
    sinks.write_table(sinks.with_run_date(df.limit(4), "20261202"), out, partition_by=["run_date"])
    counts = {r.run_date: r["count"] for r in spark.read.parquet(out).groupBy("run_date").count().collect()}
    assert counts == {20261201: 10, 20261202: 4}  # dynamic overwrite: other days kept
    today = sinks.with_run_date(df).select("run_date").first().run_date
    assert len(today) == 8 and today.isdigit()


def test_batches_resume_after_an_end(spark):
    """A job that ends after some batches; the next one writes the missing ones only, with equal rows."""
    out, rnd = tempfile.mkdtemp(prefix="cw-batch-"), random.Random(2)
    rows = [(c, rnd.randint(0, 99), f"n{c % 7}" if c % 5 else None) for c in range(230) for _ in range(rnd.randint(1, 4))] + [(None, 1, "x")]
    df = spark.createDataFrame(rows, "customer_id long, product_id int, name string").repartition(5)
    whole = batches.write_batches(df, f"{out}/whole", ["customer_id"], 50)
    seen = []

    def end(batch):
        seen.append(batch)
        if len(seen) == 3:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        batches.write_batches(df, f"{out}/part", ["customer_id"], 50, wave=2, on_commit=end)
    assert seen == [0, 1, 2] and batches.commits(spark, f"{out}/part").count() == 3
    times = {b: os.path.getmtime(f"{out}/part/batch={b}") for b in seen}
    # what an end between rename and commit leaves is written again
    os.makedirs(f"{out}/part/batch=4")
    with open(f"{out}/part/batch=4/part-x.parquet", "w") as f:
        f.write("broken")
    more = []
    again = batches.write_batches(df, f"{out}/part", ["customer_id"], 50, wave=2, on_commit=more.append)
    assert more == [3, 4] and times == {b: os.path.getmtime(f"{out}/part/batch={b}") for b in seen}
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, whole.collect()))
    got = batches.read_batches(spark, f"{out}/part").select(df.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
    batches.write_batches(df, f"{out}/part", ["customer_id"], 50, on_commit=more.append)
    assert more == [3, 4]
    with pytest.raises(ValueError):
        batches.write_batches(df, f"{out}/part", ["customer_id"], 60)
    assert batches.write_batches(df.limit(0), f"{out}/none", ["customer_id"], 50).count() == 0


def test_sorted_files_do_not_overlap(spark):
    out, rnd = tempfile.mkdtemp(prefix="cw-range-"), random.Random(3)
    rows = [(7 if i % 2 else rnd.choice([None, *range(40)]), i) for i in range(4000)]  # half the rows of one customer
    df = spark.createDataFrame(rows, "customer_id int, n int").repartition(4)
    files = ranged.write_sorted(df, f"{out}/t", ["customer_id", "n"], 8).orderBy("rows_before").collect()
    key = lambda k: (k[0] is not None, k[0] or 0, k[1])
    assert len(files) == 8 and sum(f.rows for f in files) == 4000
    assert all(key(a.last_key) < key(b.first_key) for a, b in zip(files, files[1:]))
    assert max(f.rows for f in files) < 1200  # the heavy customer is spread
    want = sorted(rows, key=key)
    got = sorted((r.row_no, r.customer_id, r.n) for r in ranged.read_sorted(spark, f"{out}/t").collect() if r.customer_id is not None)
    assert got == [(i, *r) for i, r in enumerate(want) if r[0] is not None]
    few = ranged.read_sorted(spark, f"{out}/t", 30, 33)
    assert sorted((r.row_no, r.customer_id, r.n) for r in few.collect()) == [(i, *r) for i, r in enumerate(want) if r[0] in range(30, 34)]
    assert len(few.inputFiles()) < 8
    assert ranged.read_sorted(spark, f"{out}/t", 100).count() == 0
    ranged.write_sorted(df.limit(0), f"{out}/e", ["customer_id", "n"])
    assert ranged.read_sorted(spark, f"{out}/e").count() == 0
