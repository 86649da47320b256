"""Order-dependent literal cases (FIXTURES.md §3) for the keyed operators."""

from pyspark.sql import functions as F

from cartwise.operators import keys, upsize
from cartwise.operators.blend import append_ranked
from cartwise.operators.impute import group_mode


def test_round_robin(spark):
    rows = [(1, "A1", 2, 1), (1, "A2", 2, 2), (1, "A3", 2, 3), (1, "B1", 1, 4), (1, "C1", None, 5)]
    df = spark.createDataFrame(rows, "customer_id int, product string, cat int, pos int")
    out = keys.round_robin(df, "customer_id", "cat", [F.col("pos")], k=4).orderBy("pick")
    assert [r.product for r in out.collect()] == ["B1", "A1", "A2", "A3"]


def test_round_robin_against_loop(spark):
    import random
    rnd = random.Random(7)
    rows, expected = [], {}
    for cust in range(40):
        items = [(f"p{cust}_{i}", rnd.choice([1, 2, 3, None])) for i in range(rnd.randint(1, 12))]
        rows += [(cust, p, c, i) for i, (p, c) in enumerate(items)]
        buckets = {}
        for p, c in items:
            if c is not None:
                buckets.setdefault(c, []).append(p)
        order, picks, ptr = sorted(buckets), [], {c: 0 for c in buckets}
        while len(picks) < 5 and any(ptr[c] < len(buckets[c]) for c in order):
            for c in order:
                if len(picks) >= 5:
                    break
                if ptr[c] < len(buckets[c]):
                    picks.append(buckets[c][ptr[c]])
                    ptr[c] += 1
        expected[cust] = picks
    df = spark.createDataFrame(rows, "customer_id int, product string, cat int, pos int")
    got = {}
    for r in keys.round_robin(df, "customer_id", "cat", [F.col("pos")], k=5).orderBy("pick").collect():
        got.setdefault(r.customer_id, []).append(r.product)
    assert {c: v for c, v in expected.items() if v} == got


def test_variants_max_two(spark):
    df = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3)], "customer_id int, product_id int, pos int")
    out = keys.top_k_per_key(df, ["customer_id"], [F.col("pos")], 2)
    assert sorted(r.product_id for r in out.collect()) == [10, 11]


def test_linear_gap_positional(spark):
    df = spark.createDataFrame([(0, None), (1, 4.0), (2, None), (3, None), (4, 1.0), (5, None)], "x int, v double")
    out = keys.linear_fill(df, [], "x", ["v"], ends="forward").orderBy("x")
    assert [r.v for r in out.collect()] == [None, 4.0, 3.0, 2.0, 1.0, 1.0]
    near = keys.linear_fill(df, [], "x", ["v"]).orderBy("x")
    assert [r.v for r in near.collect()] == [4.0, 4.0, 3.0, 2.0, 1.0, 1.0]


def test_forward_fill(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, 3.0), (3, None)], "x int, v double")
    out = keys.forward_fill(df, [], ["x"], ["v"]).orderBy("x")
    assert [r.v for r in out.collect()] == [1.0, 1.0, 3.0, 3.0]


def test_islands(spark):
    rows = [(1, "36", 0, "p1", 1, "ori"), (1, "36", 0, "p2", 2, "rcm"), (1, "36", 0, "p3", 3, "ori"),
            (1, "36", 0, "p4", 4, "rcm")]
    df = spark.createDataFrame(rows, "customer_id int, category_code string, brand_id int, product_id string, "
                                     "ranking int, type string")
    out = upsize.origin_islands(df).orderBy("ranking")
    assert [r.product_id_ori_pos for r in out.collect()] == ["p1", "p1", "p3", "p3"]


def _steps(spark, rcm_rungs):
    rows = [(1, "o", "o", 2, "ori")] + [(1, f"r{i}", "o", r, "rcm") for i, r in enumerate(rcm_rungs)]
    df = spark.createDataFrame(rows, "customer_id int, product_id string, product_id_ori string, ranking int, "
                                     "type string")
    return sorted(r.ranking for r in upsize.adjacent_step(df).filter("type = 'rcm'").collect())


def test_adjacent_step(spark):
    assert _steps(spark, [3, 3, 5]) == [3, 3]
    assert _steps(spark, [4, 5]) == [4]


def test_next_rung_md5_pick(spark):
    ladder = spark.createDataFrame([(1, 7, "36", 1), (2, 7, "36", 3), (3, 7, "36", 3), (4, 7, "36", 7)],
                                   "product_id long, brand_id long, category_code string, ranking int")
    cycle = spark.createDataFrame([(100, 1, "36", 0.9, 1)],
                                  "customer_id long, product_id long, category_code string, score double, "
                                  "rank_cycle int")
    catalog = spark.createDataFrame([(i, 7) for i in range(1, 5)], "product_id long, brand_id long")
    out = upsize.upsize(cycle, catalog, ladder).filter("type = 'rcm'").collect()
    assert len(out) == 1 and out[0].product_id in (2, 3) and out[0].ranking == 3
    again = upsize.upsize(cycle, catalog, ladder).filter("type = 'rcm'").collect()
    assert again[0].product_id == out[0].product_id


def test_mode_tie(spark):
    df = spark.createDataFrame([(1, "b"), (1, "b"), (1, "a"), (1, "a"), (1, None)], "prediction int, stage string")
    assert group_mode(df, "prediction", "stage").first()[1] == "a"


def test_append(spark):
    first = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3)], "customer_id int, product_id int, rank int")
    second = spark.createDataFrame([(1, 20, 1), (1, 21, 2)], "customer_id int, product_id int, pick int")
    out = append_ranked(first, second).orderBy("rank")
    assert [r["rank"] for r in out.collect()] == [1, 2, 3, 4, 5]


def test_row_numbers_across_partitions(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k")).repartition(5)
    out = keys.batch_numbers(df, ["k"], 500).collect()
    assert sorted((r.k, r.row_no) for r in out) == [(i, i) for i in range(5000)]
    assert {r.batch for r in out} == set(range(10))


def test_brand_only_ladder_crosses_category(spark):
    # With brand-only ladder keys the next rung may be in the other category
    ladder = spark.createDataFrame([(1, 7, "36", 2), (2, 7, "99", 3), (3, 7, "36", 5)],
                                   "product_id long, brand_id long, category_code string, ranking int")
    cycle = spark.createDataFrame([(100, 1, "36", 0.9, 1)],
                                  "customer_id long, product_id long, category_code string, score double, "
                                  "rank_cycle int")
    catalog = spark.createDataFrame([(i, 7) for i in range(1, 4)], "product_id long, brand_id long")
    brand_only = upsize.upsize(cycle, catalog, ladder, keys=("brand_id",)).filter("type = 'rcm'").collect()
    assert [(r.product_id, r.category_code, r.ranking) for r in brand_only] == [(2, "99", 3)]
    default = upsize.upsize(cycle, catalog, ladder).filter("type = 'rcm'").collect()
    assert [(r.product_id, r.category_code, r.ranking) for r in default] == [(3, "36", 5)]


def test_row_range_bounds(spark):
    df = spark.range(0, 1000, 1, 6).select((F.col("id") * 7 % 1000).alias("k")).repartition(4)
    out = keys.row_range(df, ["k"], start=100, end=249).collect()
    assert sorted(r.k for r in out) == list(range(100, 250))
    assert sorted(r.row_no for r in out) == list(range(100, 250))


def test_lists_are_dealt_by_customer_once(spark):
    """Both lists' windows and the cut run on one exchange; gaps, equal ranks and customers of one list only."""
    first = spark.createDataFrame([(1, 10, 7, "ori"), (1, 12, 7, "ori"), (1, 11, 3, "rcm"), (2, 10, 1, "ori"), (None, 4, 1, "ori")],
                                  "customer_id long, product_id long, rank int, type string")
    second = spark.createDataFrame([(1, 30, 2), (1, 29, 9), (3, 30, 1), (None, 30, 5)], "customer_id long, product_id long, pick int")
    out = append_ranked(first, second)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = sorted(((r.customer_id or 0, r["rank"], r.product_id, r.type) for r in out.collect()))
    assert got == [(0, 1, 4, "ori"), (0, 2, 30, "age_rcm"), (1, 1, 11, "rcm"), (1, 2, 10, "ori"), (1, 3, 12, "ori"),
                   (1, 4, 30, "age_rcm"), (1, 5, 29, "age_rcm"), (2, 1, 10, "ori")]


def test_frequency_list_of_cold_customers_only(spark):
    """The cold list is the same from all customers' frequencies and from those of cold customers."""
    from cartwise.operators.blend import cold_customers, cold_start, frequency_list
    cycle = spark.createDataFrame([(1, "36", 0.9), (2, "36", 0.1), (3, "7", 0.9), (4, None, None), (None, "36", 0.0)],
                                  "customer_id long, category_code string, score double")
    bought = [(c, p, f"2024-01-0{d}") for c in (1, 2, 3, None) for p in (5, 6) for d in range(1, p - 2)]
    purchases = spark.createDataFrame(bought, "customer_id long, product_id long, purchase_date string")
    few = frequency_list(purchases, customers=cold_customers(cycle))
    assert {r.customer_id for r in few.collect()} == {2, 3}
    key = [sorted((tuple(r) for r in cold_start(cycle, f).collect()), key=str) for f in (few, frequency_list(purchases))]
    assert key[0] == key[1] and len(key[0]) == 6
