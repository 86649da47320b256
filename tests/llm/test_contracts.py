"""Base columns of operators 3, 6 and 8 from their contracts, by SQL or plain scanning."""

import hashlib
import zlib
from collections import defaultdict

import duckdb

from cartwise.llm import queries

SF = "/root/testdata/sf0.001"

BASE_3 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
win AS (SELECT doc_id, unnest(generate_series(1, len(ws) - 2)) AS k, ws FROM d WHERE len(ws) > 2),
keyed AS (SELECT doc_id, k, ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2] AS g FROM win),
twice AS (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, g) AS n FROM keyed),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest([k, k + 1, k + 2]) AS p FROM twice WHERE n > 1) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS word_chars,
       length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
       coalesce(words.n, 0) AS n_repeat_words, len(ws) < 50 OR 100 * coalesce(words.n, 0) > 50 * len(ws) AS base_failed
FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN words USING (doc_id)
"""


def test_rules_base_columns_by_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = {r[0]: tuple(int(v) for v in r[1:]) for r in con.sql(BASE_3).fetchall()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = {r["doc_id"]: tuple(int(r[c]) for c in names) for r in queries.op3_quality_rules(spark, SF).collect()}
    assert got == want


def test_shards_hold_whole_groups_of_near_equal_size(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    out = {r["doc_id"]: r for r in queries.op6_sharding(spark, SF).collect()}
    assert len(out) == len(docs)
    shards, groups, sizes = defaultdict(list), defaultdict(set), defaultdict(int)
    for d in docs:
        r, raw = out[d["doc_id"]], (d["text"] or "").encode()
        assert r["size"] == len(raw) + 16 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "bytes" and r["grown_shard"] is None
        assert 0 <= r["shard"] < 40
        shards[r["shard"]].append(r["slot"])
        groups[raw].add(r["shard"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert all(len(s) == 1 for s in groups.values())
    group_size = defaultdict(int)
    for d in docs:
        group_size[(d["text"] or "").encode()] += len((d["text"] or "").encode()) + 16
    assert max(sizes.values()) <= max(max(group_size.values()), sum(sizes.values()) / 40 + max(group_size.values()))


WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
SIGNS = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def lowered(c):
    return chr(ord(c) + 32) if "A" <= c <= "Z" else c


def base_spans(t):
    """Scanned character by character, without patterns."""
    out, low, i = [], "".join(map(lowered, t)), 0
    while i < len(t):  # assignments: the leftmost, not overlapping, also where one is too short to count
        end = None
        for w in WORDS:
            if low.startswith(w, i):
                j = i + len(w)
                if j < len(t) and t[j] in "\"'":
                    j += 1
                while j < len(t) and t[j] == " ":
                    j += 1
                if j < len(t) and t[j] in ":=":
                    j += 1
                    while j < len(t) and t[j] == " ":
                        j += 1
                    if j < len(t) and t[j] in "\"'":
                        j += 1
                    k = j
                    while k < len(t) and t[k] in SIGNS:
                        k += 1
                    if k > j:
                        end = k
                        if k - j >= 6:
                            out.append((i, 0, k, "assign"))
                break
        i = end or i + 1
    for name, order, letters, head, least in (("access", 1, set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), "AKIA", 20),
                                              ("hex", 2, set("0123456789abcdef"), "", 24)):
        i = 0
        while i < len(t):
            k = i + len(head)
            if not t.startswith(head, i) or k >= len(t) or t[k] not in letters:
                i += 1
                continue
            while k < len(t) and t[k] in letters:
                k += 1
            if k - i >= least:
                out.append((i, order, k, name))
            i = k
    return [(name, a, b) for a, _, b, name in sorted(out)]


def test_base_spans_by_scanning(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    more = ["token = = x", "TOKEN:'abcdef' apikey=1234567 api_key = \"a.b/c+d=\"", "passwordpassword=secret=abcdefg", "AKIAAKIA" * 4 + "a",
            "0" * 23 + "g" + "f" * 24, "é secret: ünï token=abc token=abcdef", "Secret\":   zzzzzz", "Api_Key=KKabcdefg ſecret=abcdefg"]
    rows = [*docs.items(), *((10 ** 6 + i, t) for i, t in enumerate(more))]
    from cartwise.llm import secrets
    out = secrets.secret_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in out:
        want = base_spans(dict(rows)[r["doc_id"]])
        counts = [sum(k == kind for k, _, _ in want) for kind in ("assign", "access", "hex")]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts, r["doc_id"]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(r["spans"].split(","))
