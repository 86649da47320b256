"""The segment-indexed fuzzy join loses no match against a full comparison."""

import random

from pyspark.sql import functions as F

from cartwise.operators.fuzzy import candidate_pairs, fuzzy_best, numbered_strings
from cartwise.operators.replies import resolve_names


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def norm(s):
    return " ".join(sorted(" ".join(s.strip().split()).lower().split(" ")))


def test_fuzzy_matches_brute_force(spark):
    rnd = random.Random(11)
    words = ["sữa", "bột", "tã", "quần", "xe", "đẩy", "bình", "nước", "áo", "size", "mini", "pro"]
    choices = sorted({" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4))) + f" {rnd.randint(1, 99)}"
                      for _ in range(300)})
    queries = []
    for i in range(300):
        s = list(rnd.choice(choices))
        for _ in range(rnd.randint(0, 3)):
            pos = rnd.randrange(len(s))
            op = rnd.random()
            if op < 0.33:
                del s[pos]
            elif op < 0.66:
                s[pos] = rnd.choice("abcdexyz ")
            else:
                s.insert(pos, rnd.choice("abcxyz"))
        queries.append((i, "".join(s) or "x"))
    expected = {}
    for qid, q in queries:
        qn = norm(q)
        best = None
        for c in choices:
            cn = norm(c)
            big = max(len(qn), len(cn))
            if big == 0 or not qn:
                continue
            d = lev(qn, cn)
            if (big - d) * 100 >= 89 * big:
                key = (d / big, c)
                if best is None or key < best:
                    best = key
        if best:
            expected[qid] = best[1]
    qdf = spark.createDataFrame(queries, "qid int, query string")
    cdf = spark.createDataFrame([(c,) for c in choices], "name string")
    got = {r.qid: r.name for r in fuzzy_best(qdf, cdf).collect()}
    assert got == expected
    assert len(expected) > 100


def test_resolve_cascade(spark):
    cat = spark.createDataFrame([(1, "sữa bột a"), (2, "sữa bột a"), (3, "Xe Đẩy"), (4, "bình nước lớn 2")],
                                "product_id long, product_name string")
    names = spark.createDataFrame([(1, 0, "sữa bột a"), (1, 1, "xe đẩy"), (1, 2, "sữa bột a@@9"),
                                   (1, 3, "bình nuớc lớn 2"), (1, 4, "không có")],
                                  "request_id long, pos int, name string")
    got = sorted((r.pos, r.product_id, r.match_kind) for r in resolve_names(names, cat).collect())
    assert got == [(0, 1, "exact"), (0, 2, "exact"), (1, 3, "lower"), (3, 4, "fuzzy")]
    assert F is not None


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def test_lcs_bit_parallel():
    from cartwise.operators.fuzzy import lcs_length
    rnd = random.Random(5)
    for _ in range(500):
        a = "".join(rnd.choice("abcdé ") for _ in range(rnd.randint(0, 40)))
        b = "".join(rnd.choice("abcdé ") for _ in range(rnd.randint(0, 40)))
        assert lcs_length(a, b) == lcs_dp(a, b)


def test_fuzzy_indel_matches_brute_force(spark):
    rnd = random.Random(17)
    words = ["sữa", "bột", "tã", "quần", "xe", "đẩy", "bình", "nước", "áo", "size", "mini", "pro"]
    choices = sorted({" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4))) + f" {rnd.randint(1, 99)}"
                      for _ in range(250)})
    queries = []
    for i in range(250):
        s = list(rnd.choice(choices))
        for _ in range(rnd.randint(0, 4)):
            pos = rnd.randrange(len(s))
            if rnd.random() < 0.5:
                del s[pos]
            else:
                s.insert(pos, rnd.choice("abcxyz "))
        queries.append((i, "".join(s) or "x"))
    expected = {}
    for qid, q in queries:
        qn = norm(q)
        best = None
        for c in choices:
            cn = norm(c)
            tot = len(qn) + len(cn)
            if not qn or not cn:
                continue
            d = tot - 2 * lcs_dp(qn, cn)
            if (tot - d) * 100 >= 89 * tot:
                key = (d / tot, c)
                if best is None or key < best:
                    best = key
        if best:
            expected[qid] = best[1]
    qdf = spark.createDataFrame(queries, "qid int, query string")
    cdf = spark.createDataFrame([(c,) for c in choices], "name string")
    got = {r.qid: r.name for r in fuzzy_best(qdf, cdf, metric="indel").collect()}
    assert got == expected
    assert len(expected) > 100


def test_candidates_hold_every_match_and_little_else(spark):
    """Every pair within the cutoff is a candidate; under 1 % of all pairs are, on names of one pattern."""
    from cartwise.functions.text import token_sort
    from cartwise.sources.fixtures import Fixtures
    from paths import SF_CHECK
    fx = Fixtures(spark, SF_CHECK)
    q = fx.misspelt().select(token_sort("query_name").alias("_s")).distinct()
    c = fx.catalog().select(token_sort("product_name").alias("_s")).distinct()
    strings = numbered_strings(q, c)
    text = {r.sid: r.s for r in strings.collect()}
    total = q.count() * c.count()
    for metric, cutoff in (("levenshtein", 89), ("indel", 89), ("levenshtein", 75), ("indel", 80)):
        got = {(text[r.qid], text[r.cid]) for r in candidate_pairs(strings, cutoff, metric).collect()}
        if cutoff == 89:
            assert len(got) < 0.01 * total, (metric, len(got), total)
        some = sorted(r._s for r in q.collect())[::40]
        for a in some:
            for b in (r._s for r in c.collect()[::3]):
                big = len(a) + len(b) if metric == "indel" else max(len(a), len(b))
                d = big - 2 * lcs_dp(a, b) if metric == "indel" else lev(a, b)
                if (big - d) * 100 >= cutoff * big:
                    assert (a, b) in got


def test_fuzzy_on_empty_null_and_repeated_names(spark):
    q = spark.createDataFrame([(1, None), (2, ""), (3, "  "), (4, "a"), (5, "a"), (6, "zz zz")], "qid int, query string")
    c = spark.createDataFrame([("A",), ("a",), (None,), ("",), ("zz  ZZ",)], "name string")
    for metric in ("levenshtein", "indel"):
        got = sorted((r.qid, r.name, r.score) for r in fuzzy_best(q, c, metric=metric).collect())
        assert got == [(4, "A", 100.0), (5, "A", 100.0), (6, "zz  ZZ", 100.0)]
        assert fuzzy_best(q.limit(0), c, metric=metric).count() == 0 == fuzzy_best(q, c.limit(0), metric=metric).count()


def test_products_of_a_name_come_from_lists(spark):
    """A name of 3,000 products, a product twice, one without id, for several requests: every pair once, joined as lists."""
    cat = [(i, "tã L") for i in range(3000)] + [(5, "tã L"), (None, "tã L"), (7, "xe"), (None, "xe"), (8, None)]
    names = [(r, 0, "TÃ L" if r % 2 else "tã L") for r in range(4)] + [(9, 0, "xe"), (9, 1, "xe")]
    out = resolve_names(spark.createDataFrame(names, "request_id long, pos int, name string"),
                        spark.createDataFrame(cat, "product_id long, product_name string"))
    assert out.columns == ["request_id", "pos", "product_id", "product_name", "match_kind"]
    want = [(r, 0, p, "tã L", "lower" if r % 2 else "exact") for r in range(4) for p, n in cat if n == "tã L"]
    want += [(9, 0, p, "xe", "exact") for p in (7, None)]
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(want, key=str)
    assert "Generate inline" in out._jdf.queryExecution().optimizedPlan().toString()
