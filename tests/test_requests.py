"""Request tables (S10), reply intake (S11) and allow-lists."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from cartwise.operators import ages, replies, requests
from cartwise.sources.fixtures import Fixtures

from paths import SF_SMALL


def test_reply_content_and_attach(spark):
    body = json.dumps({"choices": [{"message": {"content": "[a, b]"}}]})
    raw = spark.createDataFrame([(1, body), (2, '{"error": "x"}')], "request_id int, raw string")
    got = {r.request_id: r.reply for r in raw.select("request_id", replies.reply_content(F.col("raw"))
                                                      .alias("reply")).collect()}
    assert got == {1: "[a, b]", 2: "[]"}
    reqs = spark.createDataFrame([(1,), (2,), (3,)], "request_id int")
    rep = spark.createDataFrame([(1, "[a]")], "request_id int, reply string")
    out = {r.request_id: r.reply for r in replies.attach_replies(reqs, rep).collect()}
    assert out == {1: "[a]", 2: "[]", 3: "[]"}


def test_catalog_lines(spark):
    lines = replies.catalog_lines(Fixtures(spark, SF_SMALL).catalog()).collect()
    names = [r.name for r in lines]
    assert names == sorted(names) and len(names) == len(set(names))
    assert all(r.line == "- " + r.name for r in lines)


@pytest.mark.parametrize("other_brand", [False, True])
@pytest.mark.parametrize("limit,block", [(5, 3), (4, 100), (1000, 7)])
def test_requests_take_a_run_of_their_category(spark, limit, block, other_brand):
    """Every request: the next ``limit`` others of its category around the ring, from its own start."""
    rnd = random.Random(limit + block)
    rows = [(f"p{i:03d}", f"n{i}", "big" if i < 40 else rnd.choice(["x", "y", None]), rnd.choice([1, 2, None]), f"t{i}") for i in range(60)]
    rows += [("lonely", "l", "alone", 1, "tl"), ("p001", "zz", "zz", 9, "second profile")]
    prof = spark.createDataFrame(rows, "product_code string, product_name string, category_id string, brand_id int, text_for_llm string")
    got = {r.product_code: r for r in requests.similarity_requests(prof.repartition(5), limit, other_brand, block).collect()}
    one = {r[0]: r for r in reversed(rows)}
    assert set(got) == set(one)
    for code, _, cat, brand, text in one.values():
        order = sorted((r for r in one.values() if cat is not None and r[2] == cat),
                       key=lambda r: (r[3] is not None, r[3] or 0, r[0]))
        rest = [r[4] for r in order if (r[3] != brand if other_brand else r[0] != code)]
        start = int(hashlib.md5(f"similar|{code}".encode()).hexdigest()[:15], 16) % len(rest) if rest else 0
        want = (rest[start:] + rest[:start])[:limit]
        assert got[code].target_text == text and got[code].n_candidates == len(want)
        assert got[code].candidates == "\n".join(want)
    assert requests.similarity_requests(prof.limit(0)).count() == 0


def test_similarity_requests_keep_every_target_and_candidate(spark, tmp_path):
    from cartwise.plans import jobs
    rows = [(str(i), f"p{i}", 1, 1, "color", "red", 7, 4, "1") for i in range(14)]
    rows.append(("99", "alone", 2, 1, "color", "red", 7, 4, "1"))
    props = spark.createDataFrame(rows, "product_code string, product_name string, category_id int, property_id int, "
                                        "property_name string, value_id string, brand_id int, status_id int, "
                                        "list_property string")
    jobs.similar_job(props, f"{tmp_path}/sim", requests_out=f"{tmp_path}/req")
    got = {r.product_code: r.candidates for r in spark.read.parquet(f"{tmp_path}/req").collect()}
    assert len(got) == 15 and got.pop("99") == ""
    assert all(len(c.split("\n")) == 13 for c in got.values())


def test_cold_customer_without_purchases_stays(spark):
    from cartwise.operators import blend
    cycle = spark.createDataFrame([(1, 0.1, "36"), (2, 0.1, "36"), (3, 0.9, "36")],
                                  "customer_id int, score double, category_code string")
    freq = spark.createDataFrame([(1, 10, 2, 5), (3, 10, 2, 5)],
                                 "customer_id int, product_id int, freq long, last_date int")
    out = blend.cold_start(cycle, freq).collect()
    assert sorted((r.customer_id, r.product_id or 0, r.rank, r.type) for r in out) == [
        (1, 10, 1, "freg_rcm"), (2, 0, 1, "freg_rcm")]


def test_age_job_lists(spark):
    from cartwise.sources import literals as L
    labels = spark.createDataFrame([(1, "6 tháng", "114", "age_range"), (2, "6 tháng", "999", "age_range"),
                                    (3, "6 tháng", "114", "color"), (4, "Từ 3 tháng", "114", "age_usp"),
                                    (5, "90 tuổi", "114", "color")],
                                   "product_id int, label string, category_code string, propertyid string")
    full = ages.age_ranges(labels, label_properties=["age_range", "age_usp"]).collect()
    assert {r.product_id: r.max_age_months for r in full}[5] is None
    out = ages.age_ranges(labels, categories=L.AGE_JOB_CATEGORIES, properties=L.AGE_JOB_PROPERTIES,
                          label_properties=L.AGE_LABEL_PROPERTIES).collect()
    assert sorted(r.product_id for r in out) == [1, 4]


def test_age_range_allow_lists(spark):
    rows = [(1, "6 tháng", "114", "age_range"), (2, "6 tháng", "999", "age_range"),
            (3, "6 tháng", "114", "color")]
    labels = spark.createDataFrame(rows, "product_id int, label string, category_code string, propertyid string")
    out = ages.age_ranges(labels, categories=[114, 112], properties=["age_range", "age_usp"])
    assert [r.product_id for r in out.collect()] == [1]


def test_growth_sheet_reader(spark):
    import os
    import tempfile

    from cartwise.operators.impute import attach_growth
    from cartwise.sources.sheets import read_growth_sheet
    d = tempfile.mkdtemp(prefix="cw-sheet-")
    path = os.path.join(d, "growth.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("Tuổi (tháng),Cân nặng (kg), Cân nặng (lb),Chiều cao (inch),Chiều cao (cm)\n")
        fh.write("0,3.3,7.3,19.6,49.9\n12,9.6,21.2,29.8,75.7\n24,12.2,26.9,34.2,87.1\n")
    sheet = read_growth_sheet(spark, path)
    assert sheet.columns == ["age_months", "weight_kg", "weight_lb", "height_inch", "height_cm"]
    cust = spark.createDataFrame([(1, 6.0), (2, 30.0)], "customer_id int, expected_age_last double")
    got = {r.customer_id: r.weight_kg for r in attach_growth(cust, sheet, cols=("weight_kg",)).collect()}
    assert got == {1: 6.45, 2: 12.2}


def test_lines_are_cut_out_of_windows(spark):
    """Categories below, at and above a window, with small and large brands: as by plain counting, whatever the path."""
    from cartwise.operators.requests import similarity_requests
    rows = [(f"{c}{i:03d}", c, None if c == "z" and i < 60 else i % 4, f"t{c}{i:03d}")
            for c, n in (("x", 9), ("y", 24), ("z", 90)) for i in range(n)]
    rows += [("q1", None, 1, "tq1"), (None, "z", 2, "none")]
    df = spark.createDataFrame([(p, c, b, "n", t) for p, c, b, t in rows],
                               "product_code string, category_id string, brand_id int, product_name string, text_for_llm string")
    for other in (False, True):
        out = similarity_requests(df, limit=10, other_brand=other, block=4)
        got = {r.product_code: r for r in out.collect()}
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=merge" in plan and len(got) == len(rows)
        for p, c, b, t in rows:
            ring = sorted(((x[2] is not None, x[2] or 0, x[0] is not None, x[0] or "", x) for x in rows if x[1] == c and c), key=lambda k: k[:4])
            others = [k[4][3] for k in ring if (k[4][2] != b if other else k[4][0] != p)]
            lines = got[p].candidates.split("\n") if got[p].candidates else []
            want = min(10, len(others)) if p and c else 0
            assert got[p].target_text == t and got[p].n_candidates == want == len(lines)
            if want:
                at = others.index(lines[0])
                assert lines == [others[(at + i) % len(others)] for i in range(want)]
