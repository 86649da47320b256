"""Operator 2 against plain loops: features, trees, tables and which labels are learnt from."""

import bisect
import math
import random
import re
import zlib

import numpy as np

from cartwise.llm import quality_model as qm
from cartwise.llm.common import read_documents, read_labels

SF = "/root/testdata/sf0.001"


def loss(g, h, reg):
    return -sum(g) ** 2 / (sum(h) + reg)


def test_cuts_and_trees_by_enumeration():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(1, 9))
        g, h = rng.standard_normal(n), rng.uniform(0.01, 1, n)
        gain, at = qm.best_cut(g, h, 1.0)
        options = [loss(g, h, 1.0) - loss(g[:c], h[:c], 1.0) - loss(g[c:], h[c:], 1.0) for c in range(1, n)]
        want = max(options, default=0.0)
        assert abs(gain - max(want, 0.0)) < 1e-9 and (not at or abs(options[at - 1] - want) < 1e-9)
        leaf = qm.shallow_tree(g, h, 1.0)
        edges = [0, *(i for i in range(1, n) if leaf[i] != leaf[i - 1]), n]
        assert len(edges) <= 4
        for a, b in zip(edges, edges[1:]):
            part = slice(a, b)
            assert np.allclose(leaf[part], leaf[a])
        grid, weight = rng.standard_normal((3, 4)), rng.uniform(0.01, 1, (3, 4))
        total, table = qm.pair_tree(grid, weight, 1.0)
        values = {}
        for i in range(3):
            for j in range(4):
                values.setdefault(round(table[i, j], 12), []).append((i, j))
        assert len(values) <= 4 and total >= 0
        for v, cells in values.items():
            s, w = sum(grid[c] for c in cells), sum(weight[c] for c in cells)
            if len({round(table[c], 12) for c in cells}) == 1 and len(values) == 4:
                assert abs(v + s / (w + 1.0)) < 1e-9


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 4))
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    model = qm.fit(x, y, max_bins=8, rounds=20, pair_rounds=10, n_pairs=3)
    assert len(model.pairs) == 3
    for row, score in zip(x[:60], model.score(x[:60])):
        b = [bisect.bisect_right(e.tolist(), v) for e, v in zip(model.edges, row)]
        z = model.intercept + sum(t[k] for t, k in zip(model.tables, b)) + sum(t[b[i], b[j]] for (i, j), t in model.pairs.items())
        assert abs(score - 1 / (1 + math.exp(-z))) < 1e-12


def test_features_of_every_text(spark):
    docs = read_documents(spark, SF)
    got = {r["doc_id"]: r for r in qm.featured(docs).collect()}
    for r in docs.collect():
        t, f = r["text"] or "", got[r["doc_id"]]
        n, words, lines = max(len(t), 1), re.findall(r"[^\x20\x09-\x0D]+", t), t.split("\n")
        want = {"log_chars": math.log1p(len(t)), "symbols": sum(c in "#*$%&|<>@~^_=+\\{}[]" for c in t) / n,
                "marks": sum(c in "!?" for c in t) / n, "stops": sum(c in ".,;:" for c in t) / n,
                "digits": sum(c in "0123456789" for c in t) / n, "blanks": sum(c in " \t\n\r" for c in t) / n,
                "distinct": len(set(words)) / max(len(words), 1), "word_chars": sum(map(len, words)) / max(len(words), 1),
                "line_words": math.log1p(len(words) / max(len(lines), 1)), "dup_lines": 1 - len(set(lines)) / max(len(lines), 1),
                "log_words": math.log1p(len(words))}
        assert all(abs(f[k] - v) < 1e-9 for k, v in want.items()), r["doc_id"]


def test_held_out_labels_and_sources_change_nothing(spark):
    docs, labels, rnd = read_documents(spark, SF), read_labels(spark, SF), random.Random(1)
    base = {r["doc_id"]: (r["score"], r["held_out"]) for r in qm.quality_scores(docs, labels).collect()}
    assert all(held == (zlib.crc32(str(d).encode()) % 3 == 1) for d, (_, held) in base.items())
    rows = [(r["doc_id"], rnd.randint(0, 1) if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 else r["quality"]) for r in labels.collect()]
    other = spark.createDataFrame(rows, "doc_id long, quality int")
    again = qm.quality_scores(docs.selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source", "1 AS n_chars"), other).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {d: s for d, (s, _) in base.items()}
