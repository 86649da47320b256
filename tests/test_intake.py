"""Raw reply bodies to items (S11), spreadsheets (S3), statistics that add up over batches."""

import json
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from cartwise.operators import intake, statistics
from cartwise.sources.fixtures import growth_workbook
from cartwise.sources.sheets import read_growth_sheet
from cartwise.sources.workbook import read_workbook


def body(content):
    return json.dumps({"choices": [{"message": {"content": content}}]}, ensure_ascii=False)


def test_bodies_and_contents(spark):
    rows = [
        (1, body('[{"productcode": " A1 ", "productname": "x"}, {"code": 7, "name": "y"}]')),
        (2, body('```json\n[{"attribute": "màu", "reason": "r", "weight": "0.5"}, {"attribute": "", "weight": "cao"}]\n```')),
        (3, body('{"productcode": "", "code": "B2", "weight": 2}')),
        (4, body('[1, "a", null, [2], {"name": "z"}]')), (5, body("xin lỗi")), (6, body("[1, 2")), (7, body("[]")),
        (8, "{}"), (9, "[]"), (10, "not json"), (11, None), (12, body(None)), (13, '{"choices": []}'), (14, '"text"')]
    out = intake.reply_items(spark.createDataFrame(rows, "request_id int, raw string")).collect()
    by = {}
    for r in sorted(out, key=lambda r: (r.request_id, -1 if r.pos is None else r.pos)):
        by.setdefault(r.request_id, []).append(r)
    assert {k: v[0].state for k, v in by.items()} == {
        1: "ok", 2: "ok", 3: "ok", 4: "ok", 5: "no_items", 6: "no_items", 7: "ok", 8: "no_content", 9: "broken", 10: "broken",
        11: "missing", 12: "no_content", 13: "no_content", 14: "broken"}
    assert [(r.pos, r.code, r.name) for r in by[1]] == [(0, "A1", "x"), (1, "7", "y")]
    assert [(r.attribute, r.reason, r.weight) for r in by[2]] == [("màu", "r", 0.5), (None, None, None)]
    assert [(r.code, r.weight) for r in by[3]] == [("B2", 2.0)]
    assert [r.is_object for r in by[4]] == [False, False, False, False, True] and by[4][4].name == "z"
    assert len(by[7]) == 1 and by[7][0].pos is None  # an empty list has no items
    assert set(intake.STATES) >= {r.state for r in out}
    assert intake.reply_items(spark.createDataFrame([], "request_id int, raw string")).count() == 0


def test_workbook_cells_and_ranges(spark):
    path = tempfile.mkdtemp(prefix="cw-book-") + "/growth.xlsx"
    rows = [(float(a), 3.0 + a, 50.0 + a) for a in (0, 2, 6, 9, 12)]
    growth_workbook(spark.createDataFrame(rows, "age_months double, weight_kg double, height_cm double"), path)
    sheet = read_growth_sheet(spark, path, "xlsx", bad_cells=True)
    got = {r.age_months: r for r in sheet.collect()}
    assert sorted(got) == [0.0, 2.0, 6.0, 9.0, 12.0] and got[9.0].weight_kg is None and got[9.0].bad_cells == "B5=n/a"
    assert got[12.0].weight_lb == 30.0 and got[2.0].bad_cells is None
    columns = {"Tuổi (tháng)": "age", "Chiều cao (cm)": "cm"}
    small = read_workbook(spark, path, columns, rows=2)
    assert small.rdd.getNumPartitions() == 3 and small.dtypes == [("age", "double"), ("cm", "double"), ("bad_cells", "string")]
    assert sorted(r.cm for r in small.collect()) == [50.0, 52.0, 56.0, 59.0, 62.0]
    with pytest.raises(Exception, match="lacks columns"):
        read_workbook(spark, path, {"no such": "x"}).count()


def test_bitmaps_add_up(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 6), rnd.randint(0, 90000), rnd.choice([None, *range(40)])) for _ in range(5000)]
    df = spark.createDataFrame(rows, "batch int, a long, b int").repartition(7)
    got = {r.batch: (r.rows, r.distinct_a, r.distinct_b) for r in statistics.run_statistics(df, "batch", ["a", "b"]).collect()}
    for k in [*range(7), None]:
        mine = [r for r in rows if k is None or r[0] == k]
        assert got[k] == (len(mine), len({r[1] for r in mine}), len({r[2] for r in mine} - {None}))
    parts = [statistics.batch_bitmaps(df.filter(F.col("batch") % 2 == k), "batch", ["a"]) for k in (0, 1)]
    both = statistics.distinct_counts(parts[0].union(parts[1])).first()["ids"]
    assert both == len({r[1] for r in rows})
    assert statistics.run_statistics(df.limit(0), "batch", ["a"]).collect()[0].rows == 0


def test_statistics_of_a_join_without_its_rows(spark):
    """Products under several names, twice under one, NULL ids and names, names of no product: as counted over the joined rows."""
    rnd = random.Random(6)
    rows = [(rnd.choice([0, 1, 2, None]), rnd.choice([None, *range(300)]), rnd.choice([None, *"abcdefgh"])) for _ in range(400)]
    members = [(rnd.choice([None, *"abcdexy"]), rnd.choice([None, *range(0, 200000, 997)])) for _ in range(600)]
    members += [("f", 7 + 40000 * i) for i in range(37)] * 2
    df = spark.createDataFrame(rows, "batch int, request long, name string").repartition(5)
    mem = spark.createDataFrame(members, "name string, product long").repartition(3)
    out = statistics.run_statistics(df, "batch", ["request", "product"], members=mem, on=["name"])
    got = sorted((str(r.batch), r.rows, r.distinct_request, r.distinct_product) for r in out.collect())
    joined = [(b, q, p) for b, q, name in rows for m, p in members if name is not None and name == m]

    def counted(rs):
        return len(rs), len({r[1] for r in rs} - {None}), len({r[2] for r in rs} - {None})
    want = [(str(b), *counted([r for r in joined if r[0] == b])) for b in (0, 1, 2, None)]
    assert [g for g in got if g[0] != "None"] == [w for w in want if w[0] != "None"]
    assert max(g for g in got if g[0] == "None")[1:] == counted(joined)


def test_counts_of_resolved_names_build_no_product_rows(spark):
    from cartwise.operators.replies import match_metrics, resolve_names
    from cartwise.plans import catalog
    from cartwise.sources.fixtures import Fixtures
    from paths import SF_SMALL
    cat = spark.createDataFrame([(i, "a" if i % 2 else "B") for i in range(9)], "product_id long, product_name string")
    names = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "zz")], "request_id long, pos int, name string")
    got = sorted(tuple(r) for r in resolve_names(names, cat, products=False).collect())
    assert got == [(1, 0, "a", "exact", 4), (1, 1, "B", "lower", 5)]
    asked = names.select("request_id").distinct()
    assert tuple(match_metrics(asked, resolve_names(names, cat, products=False)).first()) == (2, 1, 9, 1)
    fx = Fixtures(spark, SF_SMALL)
    for name in ("run_statistics", "match_metrics", "no_match_rows"):
        catalog.QUERIES[name](spark, SF_SMALL)
    assert "catalog:_resolved_to_names" in fx._built
