"""Exactness of the hot-key split in pair_top_n."""

import random

import pytest

from cartwise.operators.affinity import companion_products
from cartwise.operators.pairs import pair_top_n
from cartwise.operators.similar import active, similar_products
from cartwise.sources.fixtures import Fixtures

from paths import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("threshold", [1, 2, 3, 5])
def test_companion_hot_split_is_exact(spark, threshold):
    fx = Fixtures(spark, SF_SMALL)
    base = companion_products(fx.properties(), fx.property_map(), hot_threshold=10 ** 9)
    hot = companion_products(fx.properties(), fx.property_map(), hot_threshold=threshold)
    assert _rows(base) == _rows(hot)


@pytest.mark.parametrize("threshold,other", [(1, False), (2, True), (4, False), (3, True)])
def test_similar_hot_split_is_exact(spark, threshold, other):
    props = active(Fixtures(spark, SF_SMALL).properties())
    base = similar_products(props, exclude_same_brand=other, hot_threshold=10 ** 9)
    hot = similar_products(props, exclude_same_brand=other, hot_threshold=threshold)
    assert _rows(base) == _rows(hot)


@pytest.mark.parametrize("max_subset", [1, 2, 3, 4])
def test_pair_top_n_against_brute_force(spark, max_subset):
    rnd = random.Random(3)
    brand = {i: rnd.choice([1, 2, None]) for i in range(30)}
    left = [(a, f"k{rnd.randint(0, 6)}", float(rnd.randint(0, 3)), brand[a]) for a in range(30)
            for _ in range(5)]
    right = [(b, f"c{b % 3}", f"k{rnd.randint(0, 6)}", brand[b]) for b in range(30) for _ in range(5)]
    ldf = spark.createDataFrame(left, "a int, k string, w double, brand int")
    rdf = spark.createDataFrame(right, "b int, part string, k string, brand int")
    got = pair_top_n(ldf, rdf, ["k"], weight="w", partition=["part"], distinct_on=["brand"], top_n=2,
                     hot_threshold=2, max_subset=max_subset)
    # brute force in Python
    lw = {}
    for a, k, w, br in left:
        lw[(a, k, br)] = lw.get((a, k, br), 0.0) + w
    rset = set(right)
    scores = {}
    for (a, k, lbr), w in lw.items():
        for (b, part, rk, rbr) in rset:
            if rk == k and a != b and lbr != rbr:
                s, c = scores.get((a, b, part), (0.0, 0))
                scores[(a, b, part)] = (s + w, c + 1)
    best = {}
    for (a, b, part), (s, c) in scores.items():
        best.setdefault((a, part), []).append((-s, -c, b))
    expected = sorted((a, b, part, -s, -c) for (a, part), v in best.items() for (s, c, b) in sorted(v)[:2])
    got_rows = sorted((r.a, r.b, r.part, r.score, r.shared) for r in got.collect())
    assert got_rows == expected


def test_many_hot_keys_are_exact_and_bounded(spark):
    """15 properties of 5 values: brute force, and few pairs scored for each result row."""
    rnd, n, top = random.Random(8), 500, 10
    held = {a: [(p, rnd.randint(0, 4)) for p in range(15)] for a in range(n)}
    held |= {n + i: held[7] for i in range(30)}  # a group of copies
    rows = [(a, p, v) for a, ks in held.items() for p, v in ks]
    left = spark.createDataFrame(rows, "a int, p int, v int")
    right = left.withColumnRenamed("a", "b")
    trace = []
    got = pair_top_n(left, right, ["p", "v"], top_n=top, trace=trace)
    want = []
    for a, ks in held.items():
        mine = set(ks)
        near = sorted((-len(mine & set(other)), b) for b, other in held.items() if b != a and mine & set(other))
        want += [(a, b, float(-s), -s, i + 1) for i, (s, b) in enumerate(near[:top])]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert sum(trace) < 25 * len(held) * top and sum(trace) < len(held) ** 2 / 2, trace


@pytest.mark.parametrize("tie_by_shared", [True, False])
def test_weights_partitions_and_brands_of_many_hot_keys(spark, tie_by_shared):
    rnd, n = random.Random(9), 70
    info = {i: (rnd.choice([1, 2, None]), rnd.choice(["x", "y", None])) for i in range(n)}
    held = {i: {(p, rnd.randint(0, 2)) for p in range(rnd.randint(5, 12))} for i in range(n)}
    weight = {(p, v): round(rnd.random() + 0.01, 3) for p in range(12) for v in range(3)}
    left = spark.createDataFrame([(i, p, v, weight[p, v], info[i][0]) for i in held for p, v in held[i]],
                                 "a int, p int, v int, w double, brand int")
    right = spark.createDataFrame([(i, info[i][1], p, v, info[i][0]) for i in held for p, v in held[i]],
                                  "b int, part string, p int, v int, brand int")
    got = pair_top_n(left, right, ["p", "v"], weight="w", partition=["part"], distinct_on=["brand"], top_n=3,
                     hot_threshold=3, max_subset=2, tie_by_shared=tie_by_shared)
    want = []
    for a in held:
        by = {}
        for b in held:
            both = held[a] & held[b]
            if a != b and info[a][0] != info[b][0] and both:
                s = round(sum(weight[k] for k in both), 9)
                by.setdefault(info[b][1], []).append((-s, -len(both), b) if tie_by_shared else (-s, 0, b, len(both)))
        for part, rows in by.items():
            for r in sorted(rows)[:3]:
                want.append((a, r[2], part, -r[0], -r[1] if tie_by_shared else r[3]))
    assert sorted(((r.a, r.b, r.part, r.score, r.shared) for r in got.collect()), key=str) == sorted(want, key=str)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tables_as_long_as_the_catalog_are_joined_by_shuffle(spark):
    """Names (twice) and model codes: the size of a compressed file may not send them through the driver."""
    fx = Fixtures(spark, SF_SMALL)
    assert _plan(companion_products(fx.properties(), fx.property_map(), fx.model_map())).count("strategy=merge") == 3


def test_hot_keys_are_numbers_whatever_their_text(spark):
    """Long values, NULLs in keys and a value that holds another's text: as by plain counting, and no text in the sets."""
    values = ["x" * 500, "x" * 499, '"x', None, "y"]
    held = {i: [(p, values[(i * (p + 3) + p) % 5]) for p in range(3)] for i in range(40)}
    rows = [(i, p, v) for i, ks in held.items() for p, v in ks]
    left = spark.createDataFrame(rows, "a int, p int, v string")
    got = pair_top_n(left, left.withColumnRenamed("a", "b"), ["p", "v"], top_n=3, hot_threshold=2)
    want = []
    for a, ks in held.items():
        real = {k for k in ks if k[1] is not None}
        near = sorted((-len(real & set(o)), b) for b, o in held.items() if b != a and real & set(o))
        want += [(a, b, float(-s), -s, i + 1) for i, (s, b) in enumerate(near[:3])]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert "to_json" not in _plan(got)


def test_many_brands_do_not_lengthen_the_index(spark):
    """One value for all, 30 brands of uneven size and a NULL one: each item's first others, from 2 * (top_n + 1) entries a set."""
    brand = {i: None if i % 7 == 3 else 1 if i < 20 else i % 30 for i in range(120)}
    left = spark.createDataFrame([(i, "k", w) for i, w in brand.items()], "a int, k string, brand int")
    got = pair_top_n(left, left.withColumnRenamed("a", "b"), ["k"], distinct_on=["brand"], top_n=4, hot_threshold=2)
    want = [(a, b, i + 1) for a in brand for i, b in enumerate([b for b in brand if brand[b] != brand[a]][:4])]
    assert sorted((r.a, r.b, r.pair_rank) for r in got.collect()) == want
    assert "<= 10)" in _plan(got)


def test_sets_are_dealt_to_parts_by_number(spark):
    """Entries and look-ups of key sets: parts grow with the rows, AQE does not merge them into one a core."""
    rows = [(i, p, (i * (p + 1)) % 3) for i in range(60) for p in range(3)]
    left = spark.createDataFrame(rows, "a int, p int, v int")
    plan = _plan(pair_top_n(left, left.withColumnRenamed("a", "b"), ["p", "v"], top_n=3, hot_threshold=2))
    dealt = [line for line in plan.splitlines() if "RepartitionByExpression [_set#" in line]
    assert len(dealt) == 3, plan  # shares of the entries, entries, look-ups
