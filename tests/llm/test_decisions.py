"""Decisions per text rather than per id, independent trials, many languages, newer code points, long texts."""

import random
import time
from collections import Counter

import numpy as np
import public_tokenizers  # noqa: F401
import pytest
from tokenizers import Tokenizer

from cartwise.llm import bpe, exact_dedup, jaccard_join, language_id, mixing, quality_rules, queries, secrets

from llm_helpers import SCHEMA, prose

A, B, C = prose(1, 120), prose(2, 120), prose(3, 120)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)], SCHEMA).repartition(3)


def left(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("rows,want", [
    ([(None, A), (5, A), (None, B)], [(5, A), (None, B)]),
    ([(1, A), (1, B), (2, A)], [(2, A), (1, B)]),
    ([(7, C), (7, C)], [(7, C)]),
    ([(None, A), (None, A), (None, None), (3, "")], [(None, A), (3, "")]),
    ([(4, A), (4, A.upper()), (3, A)], [(4, None)]),
])
def test_one_row_per_text_stays(spark, rows, want):
    out = left(exact_dedup.drop_copies(frame(spark, rows)))
    assert out == sorted(want, key=str) or (len(out) == 1 and out[0][0] == want[0][0] and out[0][1].lower() == A)


@pytest.mark.parametrize("rows,want", [
    ([(1, A), (3, A + " x"), (3, C)], [(1, A), (3, C)]),
    ([(None, A), (None, A + " x"), (None, C)], [(None, None), (None, C)]),
    ([(2, A), (2, A), (9, A + " y")], [(2, A)]),
    ([(2, A), (2, A + " y"), (None, A)], [(2, None)]),
    ([(1, ""), (1, ""), (2, None)], [(1, ""), (1, ""), (2, None)]),
])
def test_one_document_per_component_stays(spark, rows, want):
    out = left(jaccard_join.one_per_component(frame(spark, rows)))
    assert len(out) == len(want) and [i for i, _ in out] == [i for i, _ in sorted(want, key=str)]
    assert {t for _, t in want if t} <= {t for _, t in out}


def test_merged_runs_of_many_partitions(spark):
    rng = random.Random(6)
    rows = [(i if i % 9 else None, rng.choice([A, B, C, f"text {i % 50}"])) for i in range(900)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).repartition(40)
    for levels in (1, 3):
        got = {r["text_sha256"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_dedup(df, ranges=7, levels=levels).collect()}
        groups = {}
        for i, t in rows:
            groups.setdefault(t, []).append(i)
        assert sorted(got.values(), key=str) == sorted(((max((x for x in g if x is not None), default=None), len(g))
                                                       for g in groups.values()), key=str)


def test_mix_keeps_columns_and_rows(spark):
    rows = [(i % 4, A, "en", "s", i // 8) for i in range(16)] + [(None, B, "en", None, 1)] * 3
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS _pass", "'own' AS _th", "map('k', n_chars) AS m")
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and {(r["_pass"], r["_th"]) for r in out.collect()} == {(1, "own")}
    taken = mixing.mix_sources(df).agg({"times": "sum"}).first()[0]
    assert out.count() == taken
    seen = Counter((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect())
    assert all(n <= 2 * sum(1 for x in rows if (x[0], x[1], x[4]) == k) for k, n in seen.items())


def test_a_repeated_label_is_one_trial(spark):
    good = " ".join(f"##{i}" for i in range(60))
    other = " ".join(f"#%{i * 7}" for i in range(70))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    rows = [(1, good, "en", "s", 0)] * 4000 + [(2, other, "en", "s", 0)]
    out = quality_rules.quality_rules(spark.createDataFrame(rows, SCHEMA), labels).collect()
    assert all(r["kept"] for r in out)


def test_any_number_of_languages(spark):
    rng = random.Random(3)
    words = {k: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(12)] for k in range(1500)}
    rows = [(4 * k + j, " ".join(rng.choices(words[k], k=60)), f"l{k}", "s", 0) for k in range(1500) for j in range(2)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = language_id.fit(df, held=40)
    assert len(model.languages) == 1500 and model.code.shape[0] == 1500
    out = language_id.predict(df.limit(60), model, ["lang"]).collect()
    assert sum(r["k0"] == r["lang_pred"] for r in out) >= 54
    small = language_id.fit(df.filter("lang IN ('l1', 'l2', 'l3')"))
    counts = np.zeros((3, language_id.DIM))
    for _, t, lang, _, _ in rows:
        if lang in ("l1", "l2", "l3"):
            counts[int(lang[1]) - 1] += language_id.ngram_counts(t)
    freq = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * language_id.DIM)
    for b in range(small.code.shape[1]):
        side = small.code[:, b] > 0
        assert np.allclose(small.weights[:, b], np.log(freq[side].mean(0) / freq[~side].mean(0)))


def test_every_code_point_like_the_library(spark):
    ref = Tokenizer.from_file(queries.VOCABULARY)
    ref.no_truncation()
    ref.no_padding()
    with open(queries.VOCABULARY, encoding="utf-8") as f:
        spec = f.read()
    import json
    coder = bpe.Encoder(bpe.Vocabulary(json.loads(spec)), None, bpe.Newer(spec))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + chr(c) + "b " + chr(c) for c in points if c < 0x30000 or c % 97 == 0 or 0xE0000 <= c < 0xE0200]
    texts += ["\u0345\u08d0 x", "\u1c89\u1c8a", "e\u0301\u0897"]
    rng = random.Random(1)
    texts += ["".join(chr(rng.choice(points)) for _ in range(rng.randint(1, 12))) for _ in range(20000)]
    wrong = []
    for k in range(0, len(texts), 20000):
        part = texts[k:k + 20000]
        want = ref.encode_batch(part, add_special_tokens=False)
        wrong += [t for t, ids, w in zip(part, coder.encode(part), want) if np.frombuffer(ids, "<u4").tolist() != w.ids]
    assert not wrong, (len(wrong), [ascii(t) for t in wrong[:5]])


def test_spans_take_linear_time_and_secrets_are_found():
    rng = random.Random(9)
    key = lambda letters, k: "".join(rng.choices(letters, k=k))
    lower, upper, digit = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    text = " ".join(f"token={key(lower + digit, 24)} {key(lower + upper + digit, 26)}" for _ in range(30000))
    start = time.time()
    assert len(secrets.scan(text)) >= 50000
    assert time.time() - start < 20
    for letters, k in ((lower + upper + digit, 24), (lower + upper, 23), (lower + upper + digit + "+/", 32),
                       (lower + upper + "+/", 33), (upper + digit, 30)):
        made = [key(letters, k) for _ in range(300)]
        for frame_ in ("see %s here", "https://hooks.chat.example.org/services/T01/B02/%s", "{'v':'%s'}"):
            found = sum(any(s[0] == "entropy" for s in secrets.scan(frame_ % m)) for m in made)
            assert found >= 0.9 * len(made), (letters, k, frame_, found)
    words = ["internationalisation-handbook", "getUserNameByIdentifier", "XMLHttpRequestEventTarget", "someVeryLongCamelCaseName",
             "SOME_VERY_LONG_CONSTANT_NAME", "path/to/some/other/Directory", "DieDonaudampfschifffahrtsgesellschaft"]
    assert not [w for w in words if secrets.scan(f"see {w} here")]
