"""N-gram Jaccard join (operator 10): count-vector R-tree.

A document's set holds its distinct 5-word shingles (64-bit hashes of the words,
A-Z lower-cased).  Two documents link at Jaccard >= 75 / 100; the result is
each document's connected component.

1. Sets.  Documents with equal sets are one class; the smallest id stands for it.
2. Blocks.  Shingles are ordered by hash; of their first n - ceil(0.75 n) + 1 + k
   shingles, linked sets share at least k + 1 (k = n // 20).  Shingles held by
   one class only drop out.  A class with at most ceil(0.75 n) // 20 frequent shingles
   (held by more than ``hot`` classes) leaves their blocks: each of its links
   still shares another one.  Boilerplate thus makes no large blocks; they only hold
   sets that consist of frequent shingles.  Shingles held by the same classes
   are one block.
3. Trees.  In a block, every class is a point: its shingles are hashed into
   groups, the coordinates are the group counts.  The overlap of two sets
   is at most the sum of coordinate minima, and that of a point with a box of
   points at most the sum of minima with the box's upper corner.  Points are packed
   into the leaves of an R-tree by size and descended with this bound; surviving
   pairs make classes of a block hang together (chains, not pairs, leave it).
   Chains over all blocks give clusters, which hold every link.
4. Verification.  Whole sets meet once per cluster and are compared exactly,
   again under the tree bound, skipping pairs that are already connected.

A block or cluster of more than ``chunk`` classes is split.  A cluster's chunks
are first joined inside, then over their best connected members, and only the
parts that are still apart are compared chunk by chunk; a block's chunks are
compared chunk by chunk.  Nothing is capped: every pair of a block is either
bounded out, compared, or already connected.  64-bit hashes stand for shingles
and classes.

Results for odd input: NULL texts and texts without words have an empty set,
are their own component and link with nothing; fewer than five words make one
shingle of the whole sequence; repeated rows (equal ids) share a component; a
NULL id is in the result, in the component of its class if that has another
id, else NULL; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import top_k_per_key
from .common import connected, id_long, id_text, quoted, written
from .wordhash import WordHasher, mix

SHINGLE, PERCENT = 5, 75
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LEAF, COARSE, SPARE, STEP, BATCH = 32, 64, 20, 4096, 50_000


def shingle_set(hasher: WordHasher, text) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    if not text:
        return np.zeros(0, np.uint64)
    h = hasher.word_hashes(text.encode("utf-8", "surrogatepass").translate(LOWER))
    if not len(h):
        return h
    s = np.sort(hasher.runs(h, min(SHINGLE, len(h))))
    return s[np.append(True, s[1:] != s[:-1])]


def needed(n):
    """Least overlap of a set of ``n`` with a linked one."""
    return -(-PERCENT * n // 100)


def linked(common: int, a: int, b: int) -> bool:
    return 100 * common >= PERCENT * (a + b - common)


def count_vector(s: np.ndarray) -> np.ndarray:
    """Group counts; the number of groups is a power of two near a quarter of the set's size."""
    groups = 1 << int(np.clip(np.ceil(np.log2(max(len(s), 1) / 4 + 1)), 6, 14))
    return np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups)


def folded(v: np.ndarray, groups: int) -> np.ndarray:
    return v.reshape(-1, groups).sum(0) if len(v) > groups else v


def coarse_counts(vectors: list[np.ndarray]) -> np.ndarray:
    """The vectors folded to ``COARSE`` groups, those of one length at a time."""
    out, lengths = np.empty((len(vectors), COARSE), np.int32), np.array([len(v) for v in vectors])
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        out[at] = np.concatenate([vectors[i] for i in at.tolist()]).reshape(len(at), -1, COARSE).sum(1)
    return out


class Tree:
    """R-tree over count vectors, packed in order of set size, then of coarse counts."""

    def __init__(self, sizes: np.ndarray, vectors: list[np.ndarray]):
        self.sizes, self.vectors = sizes, vectors
        coarse = coarse_counts(vectors)
        self.order = np.lexsort((coarse[:, 0], sizes))
        self.coarse = coarse
        self.levels = []  # from the leaves up: first point, last point, upper corner, sizes
        edges = np.arange(0, len(sizes), LEAF)
        corner = np.maximum.reduceat(coarse[self.order], edges)
        lo, hi = sizes[self.order][edges], sizes[self.order][np.append(edges[1:], len(sizes)) - 1]
        while True:
            self.levels.append((corner, lo, hi))
            if len(corner) <= LEAF:
                break
            up = np.arange(0, len(corner), LEAF)
            lo, hi = lo[up], hi[np.append(up[1:], len(hi)) - 1]
            corner = np.maximum.reduceat(corner, up)

    def near(self, i: int, label: np.ndarray) -> np.ndarray:
        """Points after ``i`` in packed order, of another label, that the bounds let link with the point at place ``i``."""
        p = self.order[i]
        n, c = self.sizes[p], self.coarse[p]
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, lo, hi = self.levels[depth]
            bound = np.minimum(corner[nodes], c).sum(1)
            # overlap >= 75/175 (n + m) for the smallest m of the node that can link at all
            least = np.maximum(lo[nodes], n)
            ok = (hi[nodes] >= n) & (lo[nodes] * PERCENT <= n * 100) & (
                bound * (100 + PERCENT) >= PERCENT * (n + least))
            nodes = nodes[ok]
            if depth:
                width = len(self.levels[depth - 1][0])
                nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
                nodes = nodes[nodes < width]
        at = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
        at = at[(at > i) & (at < len(self.order))]
        q = self.order[at]
        q = q[label[q] != label[p]]
        m = self.sizes[q]
        bound = np.minimum(self.coarse[q], c).sum(1)
        q = q[(m * PERCENT <= n * 100) & (bound * (100 + PERCENT) >= PERCENT * (n + m))]
        v = self.vectors[p]  # then the finest bound both points have
        return np.array([x for x in q.tolist() if may_link(n, v, self.sizes[x], self.vectors[x])], np.int64)


    def near_pairs(self, label: np.ndarray):
        """Pairs of points of different labels that the bounds let link, leaf by leaf.

        Both sides descend together: a pair of nodes is opened where the corners' minima allow a link.
        """
        a, b = np.triu_indices(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, lo, hi = self.levels[depth]
            # a <= b: b's sizes are not below a's
            ok = hi[a] * 100 >= lo[b] * PERCENT
            a, b = a[ok], b[ok]
            bound = np.concatenate([np.minimum(corner[a[k:k + STEP]], corner[b[k:k + STEP]]).sum(1)
                                    for k in range(0, len(a), STEP)] or [np.zeros(0, np.int64)])
            # the smallest sizes of the two nodes that can link at all
            least = lo[b] + np.maximum(lo[a], -(-PERCENT * lo[b] // 100))
            ok = bound * (100 + PERCENT) >= PERCENT * least
            a, b = a[ok], b[ok]
            if depth:
                width, step = len(self.levels[depth - 1][0]), np.arange(LEAF)
                shape = (len(a), LEAF, LEAF)
                up = np.broadcast_to((a[:, None] * LEAF + step)[:, :, None], shape).ravel()
                down = np.broadcast_to((b[:, None] * LEAF + step)[:, None, :], shape).ravel()
                ok = (up <= down) & (down < width)
                a, b = up[ok], down[ok]
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = self.order[x * LEAF:(x + 1) * LEAF], self.order[y * LEAF:(y + 1) * LEAF]
            apart = (label[p][:, None] != label[q]) & (self.sizes[q] * PERCENT <= self.sizes[p][:, None] * 100)
            if x == y:
                apart = np.triu(apart, 1)
            if not apart.any():
                continue
            bound = np.minimum(self.coarse[p][:, None], self.coarse[q]).sum(2)
            i, j = np.nonzero(apart & (bound * (100 + PERCENT) >= PERCENT * (self.sizes[p][:, None] + self.sizes[q])))
            for m, n in zip(p[i].tolist(), q[j].tolist()):
                v, w = self.vectors[m], self.vectors[n]
                if label[m] != label[n] and (len(v) == len(w) == COARSE or may_link(self.sizes[m], v, self.sizes[n], w)):
                    yield m, n


class Parts:
    """Labels of the points of a task; joining two parts relabels the smaller one."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.members = [[i] for i in range(n)]

    def join(self, a: int, b: int) -> bool:
        a, b = int(self.label[a]), int(self.label[b])
        if a == b:
            return False
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        self.label[self.members[b]] = a
        self.members[a] += self.members[b]
        self.members[b] = []
        return True


def groups_of(batches, key: str):
    """Whole groups of rows that arrive sorted by ``key``, across batches: column name -> array."""
    held = None
    for pdf in batches:
        cols = {c: pdf[c].to_numpy() for c in pdf.columns}
        if held is not None:
            cols = {c: np.concatenate([held[c], v]) for c, v in cols.items()}
        k = cols[key]
        if not len(k):
            continue
        edge = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            yield {c: v[a:b] for c, v in cols.items()}
        held = {c: v[edge[-1]:] for c, v in cols.items()}
    if held is not None:
        yield held


def large_frames(columns, size: int):
    """Frames of at least ``size`` rows (the last one fewer) from dicts of arrays."""
    held, n = [], 0
    for c in columns:
        held.append(c)
        n += len(next(iter(c.values())))
        if n >= size:
            yield pd.DataFrame({k: np.concatenate([h[k] for h in held]) for k in c})
            held, n = [], 0
    if held:
        yield pd.DataFrame({k: np.concatenate([h[k] for h in held]) for k in held[0]})


def may_link(n: int, v: np.ndarray, m: int, w: np.ndarray) -> bool:
    """Whether sizes and summed coordinate minima let two sets link."""
    if min(n, m) * 100 < PERCENT * max(n, m):
        return False
    g = min(len(v), len(w))
    return int(np.minimum(folded(v, g), folded(w, g)).sum()) * (100 + PERCENT) >= PERCENT * (n + m)


def text_key(docs: DataFrame) -> Column:
    """Tells apart the texts of rows with one id."""
    return F.xxhash64(docs["text"])


def sets_table(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, cls, prefix, vec) of every row; a task gives a class's prefix once.  ``key``: see text_key."""
    def rows(batches):
        hasher, seen = WordHasher(), set()
        for pdf in batches:
            out = []
            for d, k, t in zip(pdf["doc_id"], pdf["key"], pdf["text"]):
                s = shingle_set(hasher, t)
                n = len(s)
                cls = int(mix(mix(s + np.uint64(n)).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])
                if n and cls not in seen:
                    seen.add(cls)
                    out.append((d, k, n, cls, s[:n - needed(n) + 1 + n // SPARE].view(np.int64), count_vector(s).astype("<u2").tobytes()))
                else:
                    out.append((d, k, n, cls, None, None))
            yield pd.DataFrame(out, columns=["doc_id", "key", "n", "cls", "prefix", "vec"])

    return id_long(id_text(docs.select("doc_id", text_key(docs).alias("key"), "text")).mapInPandas(
        rows, "doc_id string, key long, n long, cls long, prefix array<long>, vec binary"))


def chunk_pairs(df: DataFrame, key: str, size: str, item: str, chunk: int) -> DataFrame:
    """Split groups of more than ``chunk`` rows: a row goes to every pair of chunks with its own.

    Adds ``part`` (null where the group is whole) and ``side`` (the row's chunk).
    """
    c = F.ceil(F.col(size) / chunk).cast("int")
    mine = F.pmod(F.xxhash64(F.col(item), F.lit(5)), c).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), c - 1), lambda o: F.least(o, mine) * c + F.greatest(o, mine))
    return df.select("*", mine.alias("side"), F.explode(F.array_distinct(pairs)).alias("part"))


def block_chains(members: DataFrame, chunk: int) -> DataFrame:
    """(a, b): classes chained by pairs that the bounds let pass; b is the smallest class a task chained a with.

    ``members``: tok, cls, n_cls (classes of the block), n, vec.
    """
    split = chunk_pairs(members, "tok", "n_cls", "cls", chunk).withColumn("task", F.struct("tok", "part"))
    split = split.withColumn("key", F.concat_ws("/", "tok", "part")).drop("task", "tok")

    def rows(batches):
        up: dict[int, int] = {}  # what this task has chained in earlier blocks

        def find(c: int) -> int:
            while up.get(c, c) != c:
                up[c] = c = up.get(up[c], up[c])
            return c

        for g in groups_of(batches, "key"):
            cls, n = g["cls"].tolist(), g["n"]
            comp = [find(c) for c in cls]
            if len(set(comp)) == 1:
                continue
            vec = [np.frombuffer(v, "<u2").astype(np.int64) for v in g["vec"]]
            parts, places = Parts(len(cls)), {}
            for i, c in enumerate(comp):
                parts.join(places.setdefault(c, i), i)
            near = Tree(n, vec).near_pairs(parts.label) if len(cls) > 2 else [
                (0, 1)] * may_link(int(n[0]), vec[0], int(n[1]), vec[1])
            for p, q in near:
                if parts.join(p, q):
                    x, y = find(cls[p]), find(cls[q])
                    up[max(x, y)] = min(x, y)
        at = list(up)
        for k in range(0, len(at), BATCH):
            yield pd.DataFrame({"a": at[k:k + BATCH], "b": [find(c) for c in at[k:k + BATCH]]})

    return (split.select("key", "cls", "n", "vec").repartition("key").sortWithinPartitions("key", "cls")
            .mapInPandas(rows, "a long, b long"))


def verified(keyed: DataFrame) -> DataFrame:
    """(cls, comp, root, degree) of the rows (key, cls, comp, grams) of whole groups.

    ``comp`` is the part a class is known to be in; ``root`` the smallest of those
    that links join in its group; ``degree`` its links found here.
    """
    def groups(batches):
        for g in groups_of(batches, "key"):
            comp = g["comp"]
            sets = [np.frombuffer(x, np.uint64) for x in g["grams"]]
            sizes, parts = np.array([len(s) for s in sets]), Parts(len(sets))
            places: dict[int, int] = {}
            for i, c in enumerate(comp.tolist()):  # what is joined already
                parts.join(places.setdefault(c, i), i)
            tree = Tree(sizes, [count_vector(s) for s in sets])
            degree = np.zeros(len(sets), np.int64)
            for i in range(len(sets)):
                p = int(tree.order[i])
                near = tree.near(i, parts.label)
                for q in near[np.argsort(-degree[near], kind="stable")].tolist():  # likely centres first
                    if parts.label[p] != parts.label[q]:
                        both = np.concatenate([sets[p], sets[q]])
                        both.sort()
                        if linked(int((both[1:] == both[:-1]).sum()), sizes[p], sizes[q]):
                            parts.join(p, q)
                            degree[p] += 1
                            degree[q] += 1
            root = np.full(len(sets), np.iinfo(np.int64).max)
            np.minimum.at(root, parts.label, comp)
            yield {"cls": g["cls"], "comp": comp, "root": root[parts.label], "degree": degree}

    def rows(batches):
        yield from large_frames(groups(batches), BATCH)

    return (keyed.select("key", "cls", "comp", "grams").repartition("key").sortWithinPartitions("key", "cls")
            .mapInPandas(rows, "cls long, comp long, root long, degree long"))


def grams_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, cluster, size, grams): the whole sets of the wanted representatives (rep, key, cls, cluster, size)."""
    def rows(batches):
        hasher = WordHasher()
        for pdf in batches:
            yield pd.DataFrame({"cls": pdf["cls"], "cluster": pdf["cluster"], "size": pdf["size"],
                                "grams": [shingle_set(hasher, t).tobytes() for t in pdf["text"]]})

    held = docs.select("doc_id", text_key(docs).alias("_key"), "text")
    met = held.join(wanted, held["doc_id"].eqNullSafe(wanted["rep"]) & (held["_key"] == wanted["key"]))
    met = met.select("cls", "cluster", "size", "text").dropDuplicates(["cls"])
    return met.mapInPandas(rows, "cls long, cluster long, size long, grams binary")


def moved(parts: DataFrame, roots: DataFrame) -> DataFrame:
    """``parts`` (cls, comp) with every comp replaced by its root, where ``roots`` (comp, root) has one."""
    return parts.join(roots, "comp", "left").select("cls", F.coalesce("root", "comp").alias("comp"))


def component_parts(docs: DataFrame, chunk: int = 1024, hubs: int = 4, hot: int = 64) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, key, n, cls), classes, and the parts (cls, comp) that links make."""
    table = written(sets_table(docs), "sets")
    spark = docs.sparkSession
    parallel = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    classes = written(table.filter("n > 0").groupBy("cls", "n").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"),
        F.max("vec").alias("vec"), F.max("prefix").alias("prefix")).select(
        "cls", "n", F.col("first.doc_id").alias("rep"), F.col("first.key").alias("key"), "vec", "prefix"), "classes")
    # blocks: one shuffle by shingle, counted in place
    tokens = classes.select("cls", F.explode("prefix").alias("tok")).repartition(parallel, "tok")
    held = tokens.select("tok", "cls", F.count(F.lit(1)).over(Window.partitionBy("tok")).alias("n_cls"))
    held = written(held.filter("n_cls > 1"), "recurring")
    frequent = held.filter(F.col("n_cls") > hot).select("tok", "cls")
    heavy = (frequent.groupBy("cls").agg(F.count(F.lit(1)).alias("h")).join(classes.select("cls", "n"), "cls")
             .filter(F.col("h") > F.floor(F.ceil(F.col("n") * PERCENT / 100) / SPARE)).select("cls"))
    held = held.filter(F.col("n_cls") <= hot).select("tok", "cls").union(
        frequent.join(heavy, "cls").select("tok", "cls"))
    lists = held.groupBy("tok").agg(F.count(F.lit(1)).alias("n_cls"), F.bit_xor(F.xxhash64("cls")).alias("x"),
                                    F.bit_xor(F.xxhash64("cls", F.lit(9))).alias("y")).filter("n_cls > 1")
    blocks = lists.groupBy("n_cls", "x", "y").agg(F.min("tok").alias("tok")).select("tok", "n_cls")
    members = written(held.join(blocks, "tok"), "members")
    members = members.join(classes.select("cls", "n", "vec"), "cls")
    chains = written(block_chains(members, chunk), "chains")
    # clusters and their sets
    cluster = connected(chains).withColumnsRenamed({"id": "cls", "component_id": "cluster"})
    sizes = cluster.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    wanted = cluster.join(sizes, "cluster").join(classes.select("cls", "rep", "key"), "cls")
    sets = written(grams_of(docs, wanted), "grams")
    # inside chunks: a class is in one group, so its root there is its part
    chunks = F.ceil(F.col("size") / chunk).cast("int")
    mine = F.pmod(F.xxhash64("cls", F.lit(5)), chunks)
    inside = written(verified(sets.select(F.concat_ws("/", "cluster", mine).alias("key"), "cls",
                                          F.col("cls").alias("comp"), "grams")), "links")
    parts = inside.select("cls", F.col("root").alias("comp"))
    large = sets.filter(F.col("size") > chunk)
    if large.limit(1).count():
        # over the best connected members of the chunks' parts; a part is in one group
        ranked = large.select("cls", "cluster").join(parts.join(inside.select("cls", "degree"), "cls"), "cls")
        best = top_k_per_key(ranked, ["cluster", "comp"], [F.col("degree").desc(), F.col("cls").asc()], hubs)
        n_best = best.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_best"))
        group = F.pmod(F.xxhash64("comp", F.lit(5)), F.ceil(F.col("n_best") / chunk))
        keyed = (best.join(n_best, "cluster").withColumn("key", F.concat_ws("/", "cluster", group))
                 .select("key", "comp", "cls").join(large.select("cls", "grams"), "cls"))
        over = written(verified(keyed), "links").filter("comp <> root").select("comp", "root").distinct()
        parts = written(moved(parts, over), "parts")
        # what is still apart: chunk by chunk
        still = large.join(parts, "cls")
        apart = still.groupBy("cluster").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
        rest = chunk_pairs(still.join(apart.select("cluster"), "cluster"), "cluster", "size", "cls", chunk)
        links = written(verified(rest.withColumn("key", F.concat_ws("/", "cluster", "part"))), "links")
        parts = moved(parts, connected(links, "comp", "root").withColumnsRenamed(
            {"id": "comp", "component_id": "root"}))
    return table, classes, parts


def jaccard_components(docs: DataFrame, chunk: int = 1024, hubs: int = 4, hot: int = 64) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id."""
    return component_rows(*component_parts(docs, chunk, hubs, hot))


def component_rows(table: DataFrame, classes: DataFrame, parts: DataFrame) -> DataFrame:
    """Every row with its set size and the smallest id of its component; a class without a part is its own."""
    parts = classes.select("cls", "n", "rep").join(parts, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    low = parts.groupBy("comp").agg(F.min("rep").alias("component_id"))
    ids = parts.join(low, "comp").select("cls", "n", "component_id")
    out = table.select("doc_id", "n", "cls").join(ids, ["cls", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_per_component(docs: DataFrame, **options) -> DataFrame:
    """One row of each component, all columns kept: the smallest id's (of its texts the one with the least hash,
    of repeated rows one); of NULL ids only where no other is there.  Texts without words all stay."""
    table, classes, parts = component_parts(docs, **options)
    comp = F.coalesce("comp", "cls").alias("comp")
    first = classes.join(parts, "cls", "left").select(comp, F.struct(F.col("rep").isNull().alias("none"), "rep", "key").alias("f"))
    first = first.groupBy("comp").agg(F.min("f").alias("f")).select("f.rep", F.col("f.key").alias("rep_key"))
    held = table.filter("n > 0").groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("rows"))
    plan = held.join(first, held["doc_id"].eqNullSafe(first["rep"]) & (held["key"] == first["rep_key"]), "left")
    # what a row's id and text say: absent (no words), gone, the one that stays, or one of several equal ones
    plan = plan.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"),
                       F.when(F.col("rep_key").isNull(), 0).when(F.col("rows") == 1, 1).otherwise(2).alias("_stay"))
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), "doc_id", text_key(docs).alias("key"))
    met = rows.join(plan, rows["doc_id"].eqNullSafe(plan["_id"]) & (rows["key"] == plan["_key"]), "left")
    once = met.filter("_stay IS NULL OR _stay = 1").select("row.*")
    more = met.filter("_stay = 2").groupBy("_id", "_key").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return once.union(more.select("row.*"))
