"""Whitening, MinHash near-dedup and the Merkle manifest: brute force, odd input, empty tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cartwise.llm import jaccard_join, merkle, minhash, queries, whitening

from llm_helpers import SCHEMA, odd_rows, prose

SF = "/root/testdata/sf0.001"


# operator 11
def brute_whitening(vectors):
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors], np.int64)
    n, s = len(x), x.sum(0)
    y = x - s / n
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1][:8], q[:, ::-1][:, :8]
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return n, dev, y @ q / np.sqrt(e), e / np.trace(y.T @ y / n)


def same_components(rows, ids, vectors, tol=1e-9):
    n, dev, z, share = brute_whitening(vectors)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(got) == len(ids) * z.shape[1]
    for j in range(z.shape[1]):
        mine = np.array([got[i, j + 1]["whitened"] for i in ids])
        sign = np.sign((mine * z[:, j]).sum())
        assert np.abs(mine - sign * z[:, j]).max() < tol
    for i, v in zip(ids, dev):
        r = got[i, 1]
        assert r["n"] == n and r["deviation"] == v and r["identity_error"] < 1e-10
        assert all(abs(got[i, j + 1]["explained"] / share[j] - 1) < 1e-10 for j in range(len(share)))


def test_whitening_of_the_whole_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = queries.op11_whitening(spark, SF).collect()
    held = table.collect()
    same_components(rows, [r["vec_id"] for r in held], [r["embedding"] for r in held])


def test_whitening_of_odd_vectors(spark):
    rng = random.Random(3)
    good = [(i, [rng.gauss(0, 1) * (k + 1) for k in range(5)]) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0., 0., 0., 0.]),
           (104, [1.0, 2.0]), (105, []), (106, [1e300, 0., 0., 0., 0.])]
    table = spark.createDataFrame([(i, v, 1) for i, v in good + bad], "vec_id long, embedding array<double>, n int")
    rows = whitening.whiten(table.repartition(5)).collect()
    same_components(rows, [i for i, _ in good], [v for _, v in good])
    twice = spark.createDataFrame([(None, v) for _, v in good] + [(7, v) for _, v in good], "vec_id long, embedding array<double>")
    out = whitening.whiten(twice).collect()
    assert Counter(r["vec_id"] for r in out) == {None: 200, 7: 200} and out[0]["identity_error"] < 1e-10
    flat = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id long, embedding array<double>")
    assert whitening.whiten(flat).count() == 0 == whitening.whiten(flat.limit(0)).count()
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "vec_id long, embedding array<float>")
    assert {r["component"] for r in whitening.whiten(line).collect()} == {1}


@pytest.mark.parametrize("d,n", [(1, 30), (12, 400), (150, 90), (300, 1500)])
def test_eigenpairs_reach_rounding_level(d, n):
    y = np.random.default_rng(d).standard_normal((n, d)) * np.linspace(1, 9, d)
    y -= y.mean(0)
    v = y.T @ y / n
    e, q = whitening.jacobi_davidson(lambda u: y.T @ (y @ u) / n, d, 8)
    assert np.abs(np.linalg.eigvalsh(v)[::-1][:len(e)] - e).max() < 1e-13 * e[0]
    assert np.linalg.norm(v @ q - q * e, axis=0).max() < 1e-13 * e[0]
    assert np.abs(q.T @ q - np.eye(len(e))).max() < 1e-13


def test_deviations_are_exact_beyond_machine_words():
    rng = random.Random(5)
    x = np.array([[rng.randint(0, 4000) for _ in range(6)] for _ in range(9)], np.int64)
    for n in (9, 10 ** 7, 10 ** 9):
        s = [rng.randint(2000 * n - n, 2000 * n + n) for _ in range(6)]
        c = whitening.Centre(n, np.array([v // n for v in s]), np.array([v % n for v in s]))
        want = [sum((n * int(a) - b) ** 2 for a, b in zip(r, s)) for r in x]
        assert c.deviations(x.tobytes()) == [v if v < 1 << 63 else None for v in want]


# operator 12
def brute_components(rows, percent):
    sets = {}
    for d, t in rows:
        w = t.encode().translate(jaccard_join.LOWER).split()
        sets[d] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def near_rows(seed, n=60):
    rng, rows = random.Random(seed), []
    base = [prose(70 + b, 200).split() for b in range(3)]
    for i in range(n):
        w = list(base[i % 3])
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"n{rng.random()}"
        rows.append((200 + i, " ".join(w), "en", "s", 0))
    return rows


@pytest.mark.parametrize("options", [{}, {"chunk": 3}, {"chunk": 7, "hubs": 1}])
def test_near_copies_match_brute_force(spark, odd, options):
    df = odd.filter("doc_id IS NOT NULL").select("doc_id", "text").union(
        spark.createDataFrame(near_rows(4), SCHEMA).select("doc_id", "text"))
    rows = [(r["doc_id"], r["text"] or "") for r in df.collect()]
    out = minhash.near_components(df, **options).collect()
    assert len(out) == len(rows)
    assert {r["doc_id"]: tuple(r)[1:] for r in out} == brute_components(rows, 85)


def test_near_copies_of_odd_tables(spark, odd, empty):
    out = minhash.near_components(odd).collect()
    comp = {r["doc_id"]: r["component_id"] for r in out}
    assert len(out) == len(odd_rows()) and comp[1] == comp[2] == comp[3] == comp[10] == 1 and comp[4] == 4
    assert comp[None] is None and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    assert minhash.near_components(empty).count() == 0
    big = (1 << 53) + 1
    df = spark.createDataFrame([(None, prose(1, 120)), (big, prose(1, 120)), (big + 1, prose(1, 119))], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in minhash.near_components(df).collect()} == {
        (None, big), (big, big), (big + 1, big)}


def test_sketches_fill_and_agree_like_jaccard():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 40, 300, 9000):
        s = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        assert minhash.sketch(s).max() < np.iinfo(np.uint64).max
        assert (minhash.sketch(s) == minhash.sketch(s[::-1])).all()
    agree = []
    for _ in range(60):
        s = rng.integers(0, 1 << 63, 170, np.uint64)
        agree.append((minhash.sketch(s[:150]) == minhash.sketch(s[20:])).mean())
    assert abs(np.mean(agree) - 130 / 170) < 0.02
    # a sketch is the least value of every coordinate over all rounds, one round at a time
    s, t = rng.integers(0, 1 << 63, 30, np.uint64), minhash.SIZE
    slow = {}
    for r in range(2 * t):
        for h in minhash.mix(s ^ minhash.SALTS[r]).tolist():
            at = ((h & 0xFFFF) * t) >> 16 if r < t else r - t
            slow[at] = min(slow.get(at, 1 << 64), (r << 48) | (h >> 16))
        if len(slow) == t:
            break
    assert minhash.sketch(s).tolist() == [slow[i] for i in range(t)]


# operator 13
def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row."""
    def leaf(r, text):
        values = [r[0], r[3], r[2], r[4], text]
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def climb(hs):
        """Last digest, and the siblings of each node by level (left, right)."""
        paths, at, owners = [[] for _ in hs], hs, [[i] for i in range(len(hs))]
        while len(at) > 1:
            up, who = [], []
            for k in range(0, len(at), 16):
                run = at[k:k + 16]
                for j, group in enumerate(owners[k:k + 16]):
                    for i in group:
                        paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
                up.append(digest("".join(run)))
                who.append([i for group in owners[k:k + 16] for i in group])
            at, owners = up, who
        return at[0], paths

    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append((r[0], leaf(r, r[1]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(climb([x[1] for x in groups[s]]))
    root, above = climb([t[0] for t in trees])
    out = Counter()
    for s, (subroot, paths), top in zip(order, trees, above):
        for (d, h, r), path in zip(groups[s], paths):
            path, seen = path + top, h
            if zlib.crc32(str("" if d is None else d).encode()) % 5 == 0 and r[1] is not None:
                seen = leaf(r, r[1].encode().translate(jaccard_join.LOWER).decode())
            for left, right in path:
                seen = digest(left + seen + right)
            out[d, h, subroot, root, digest("".join(a + b for a, b in path)), seen, seen == root] += 1
    return out


def test_manifest_matches_brute_force(spark, odd, empty):
    rows = [tuple(r) for r in odd.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    out = merkle.verified_manifest(odd).collect()
    assert Counter(tuple(r) for r in out) == brute_manifest(rows)
    assert merkle.verified_manifest(empty).count() == 0
    # more than one block in a source, more sources than one run holds
    many = [(i, f"Text {i % 40}", "en", "big" if i < 9000 else f"s{i % 37}", i) for i in range(9200)]
    df = spark.createDataFrame(many, SCHEMA).repartition(6)
    out = merkle.verified_manifest(df).collect()
    assert Counter(tuple(r) for r in out) == brute_manifest(many)
    assert 0 < sum(not r["verified"] for r in out) < len(out) / 3


def test_manifest_proves_every_row(spark, odd):
    rows = merkle.manifest(odd, {"n": odd["n_chars"]}).withColumn("again", merkle.folded(merkle.F.col("leaf"), merkle.F.col("path")))
    rows = rows.collect()
    assert len(rows) == len(odd_rows()) and all(r["again"] == r["root"] for r in rows)
    assert len({r["root"] for r in rows}) == 1 and len({r["subroot"] for r in rows}) == len({r["source"] for r in rows})
