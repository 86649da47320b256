"""Substring dedup (operator 4): repeated-phrase automata.

A window is ``WINDOW`` consecutive words.  It is removed from a document when the
same word sequence also starts in a document with a smaller id.

1. Anchors.  Every window has an anchor phrase: among its 8-word phrases the
   one with the smallest hash (the leftmost of equal ones).  Equal windows have
   equal anchors.  Neighbouring windows share an anchor, and the words they
   cover together are a span; a document has about one span per 22 words, and
   only (phrase, span digest, id) is shuffled.
2. Confirmation.  A phrase in two documents or more recurs.  A span whose digest
   is also in a smaller document is a copy as a whole.  The first holder of a
   span needs a closer look only if its phrase also stands in other spans.
3. Automata.  Documents meet their marks; each slice of documents is a shard:
   its confirmed passages (maximal runs of copied windows, one letter per
   word) are compiled into one Aho-Corasick automaton, and the documents of
   the shard stream through it, which locates every occurrence; an occurrence
   counts if all its windows start in a smaller document.
4. First holders under closer look list the digests of their windows; Spark
   finds the smallest document per window, and step 3 is repeated for them.

Digests have 128 bits; an automaton match is confirmed on the word hashes.
Phrases and spans held by many documents are counted before they are shuffled,
and joins on them are left to adaptive skew splitting.

Results for odd input: NULL and empty texts have no words, no removals, and the
digest of the empty string; texts with fewer words than a window lose nothing;
rows with a NULL id neither lose words nor cause removals; rows with equal ids
are judged as one document, each on its own text; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import text_slices
from .common import id_long, id_text, written
from .wordhash import WordHasher, sliding

WINDOW, PHRASE = 50, 8


def anchored_spans(hasher: WordHasher, h: np.ndarray):
    """Phrase hash, span digest (two words), start and end of every span of a document."""
    g = hasher.runs(h, PHRASE)
    width = WINDOW - PHRASE + 1
    low = sliding(g, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    chosen = np.flatnonzero(sliding(np.concatenate([edge, low, edge]), width, np.maximum) == g)
    k = np.searchsorted(chosen, np.arange(len(low)))
    wrong = np.flatnonzero(g[chosen[k]] != low)
    while len(wrong):  # the window's own minimum stands further right
        k[wrong] += 1
        wrong = wrong[g[chosen[k[wrong]]] != low[wrong]]
    anchor = chosen[k]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([first[1:], [len(low)]]) - 1
    start, end = first, last + WINDOW
    return (g[anchor[first]].view(np.int64), hasher.spans(h, start, end).view(np.int64),
            hasher.spans(h, start, end, True).view(np.int64), start, end)


def letters(h: np.ndarray) -> str:
    """One letter per word."""
    return (np.uint32(0x10000) + (h % np.uint64(0xF0000)).astype(np.uint32)).astype("<u4").tobytes().decode("utf-32-le")


def runs_of(first: np.ndarray):
    """Maximal runs of windows with a smaller first document (-1: none): start, end (words), largest first."""
    on = np.concatenate([[False], first >= 0, [False]])
    edge = np.flatnonzero(on[1:] != on[:-1])
    for a, b in zip(edge[::2], edge[1::2]):
        yield int(a), int(b) - 1 + WINDOW, int(first[a:b].max())


class Shard:
    """Passages and documents of one slice; ``locate`` gives the words to drop per document."""

    def __init__(self, hasher: WordHasher):
        self.hasher, self.docs = hasher, []
        self.passages: dict[str, tuple[int, int]] = {}  # letters -> (largest first id, digest)

    def add(self, doc_id: int, h: np.ndarray, first: np.ndarray) -> None:
        text = letters(h)
        for a, b, source in runs_of(first):
            digest = int(self.hasher.spans(h, np.array([a]), np.array([b]))[0])
            key = text[a:b]
            if key not in self.passages or self.passages[key][0] > source:
                self.passages[key] = (source, digest)
        self.docs.append((doc_id, h, text))

    def locate(self) -> list[np.ndarray]:
        automaton = ahocorasick.Automaton()
        for key, (source, digest) in self.passages.items():
            automaton.add_word(key, (len(key), source, digest))
        if self.passages:
            automaton.make_automaton()
        out = []
        for doc_id, h, text in self.docs:
            drop = np.zeros(len(h) + 1, np.int64)
            hits = [(end + 1 - n, end + 1, digest) for end, (n, source, digest) in automaton.iter(text)
                    if source < doc_id] if self.passages else []
            if hits:
                start, end = (np.array(x, np.int64) for x in list(zip(*hits))[:2])
                same = self.hasher.spans(h, start, end) == np.array([x[2] for x in hits], np.uint64)
                np.add.at(drop, start[same], 1)
                np.add.at(drop, end[same], -1)
            out.append(np.cumsum(drop[:-1]) > 0)
        return out


def spans_of(docs: DataFrame) -> DataFrame:
    """(phrase, s1, s2, doc_id), each once per document."""
    def rows(batches):
        hasher = WordHasher()
        for pdf in batches:
            got = []
            for d, t in zip(pdf["doc_id"], pdf["text"]):
                h = hasher.word_hashes(t.encode("utf-8", "surrogatepass")) if t else ()
                if len(h) >= WINDOW:
                    p, a, b, _, _ = anchored_spans(hasher, h)
                    _, one = np.unique(a, return_index=True)
                    got.append((p[one], a[one], b[one], np.full(len(one), d, np.int64)))
            cols = [np.concatenate(c) if got else np.zeros(0, np.int64) for c in (zip(*got) if got else [()] * 4)]
            yield pd.DataFrame(dict(zip(["phrase", "s1", "s2", "doc_id"], cols)))

    return docs.select("doc_id", "text").filter("doc_id IS NOT NULL").mapInPandas(
        rows, "phrase long, s1 long, s2 long, doc_id long")


def marks_of(spans: DataFrame) -> DataFrame:
    """Per document: its spans that are copies (first >= 0) or need a closer look (first = -1)."""
    held = spans.groupBy("phrase", "s1", "s2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    phrases = held.groupBy("phrase").agg(F.count(F.lit(1)).alias("n_spans"), F.min("first").alias("lo"),
                                         F.max("last").alias("hi")).filter("lo <> hi")
    held = written(held.join(phrases, "phrase").filter("first <> last OR n_spans > 1")
                   .select("phrase", "s1", "s2", "first", (F.col("n_spans") > 1).alias("look")), "spans")
    both = spans.join(held, ["phrase", "s1", "s2"]).filter("doc_id <> first OR look")
    mark = F.struct("s1", "s2", F.when(F.col("doc_id") != F.col("first"), F.col("first"))
                    .otherwise(F.lit(-1)).alias("first"))
    lists = both.groupBy("doc_id").agg(F.collect_set(mark).alias("m"))
    return lists.select(F.col("doc_id").alias("id"), F.col("m.s1").alias("s1"), F.col("m.s2").alias("s2"),
                        F.col("m.first").alias("first"))


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def joined(words: list[bytes]) -> str:
    return b" ".join(words).decode("utf-8", "surrogatepass")


RESULT = ["doc_id", "n_words", "n_removed", "kept"]
PENDING = ["text", "at", "first", "w1", "w2"]


def first_pass(docs: DataFrame, marks: DataFrame, write) -> DataFrame:
    """Final rows of documents that need no closer look; the others with their open windows.

    For an open document: ``at``/``first`` are its windows already known as
    copies, ``w1``/``w2`` the digests of the windows still to be looked up.
    """
    def rows(batches):
        hasher = WordHasher()
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            for i, j in text_slices(texts):
                part = pdf.iloc[i:j]
                out, shard, waiting = [], Shard(hasher), []
                for d, t, s1, s2, fs in zip(part["doc_id"], texts[i:j], part["s1"], part["s2"], part["first"]):
                    raw = t.encode("utf-8", "surrogatepass")
                    words = raw.split()
                    if s1 is None or len(words) < WINDOW:
                        out.append((d, len(words), 0, write(words), None, None, None, None, None))
                        continue
                    h = hasher.word_hashes(raw)
                    known = {(a, b): f for a, b, f in zip(s1, s2, fs)}
                    _, a1, a2, start, end = anchored_spans(hasher, h)
                    first = np.full(len(h) - WINDOW + 1, -1, np.int64)
                    look = np.zeros(len(first), bool)
                    for x, y, a, b in zip(a1.tolist(), a2.tolist(), start.tolist(), end.tolist()):
                        f = known.get((x, y))
                        if f is not None:
                            if f >= 0:
                                first[a:b - WINDOW + 1] = f
                            else:
                                look[a:b - WINDOW + 1] = True
                    if look.any():
                        at = np.flatnonzero(look)
                        w = np.unique(np.stack([hasher.spans(h, at, at + WINDOW, s).view(np.int64) for s in (False, True)]),
                                      axis=1)
                        sure = np.flatnonzero(first >= 0)
                        out.append((d, len(words), 0, None, t, sure, first[sure], w[0], w[1]))
                    else:
                        shard.add(int(d), h, first)
                        waiting.append((d, words))
                for (d, words), drop in zip(waiting, shard.locate()):
                    kept = [w for w, x in zip(words, drop) if not x]
                    out.append((d, len(words), len(words) - len(kept), write(kept), None, None, None, None, None))
                yield pd.DataFrame(out, columns=RESULT + PENDING)

    met = docs.select("doc_id", "text").join(marks, docs["doc_id"] == marks["id"], "left").drop("id")
    return id_long(id_text(met).mapInPandas(
        rows, "doc_id string, n_words long, n_removed long, kept string, text string, "
              "at array<long>, first array<long>, w1 array<long>, w2 array<long>"))


def second_pass(pending: DataFrame, found: DataFrame, write) -> DataFrame:
    """Final rows of the documents under closer look; ``found``: their copied windows (f1, f2, source)."""
    def rows(batches):
        hasher = WordHasher()
        for pdf in batches:
            texts = list(pdf["text"])
            for i, j in text_slices(texts):
                part, shard, waiting = pdf.iloc[i:j], Shard(hasher), []
                for d, t, at, fs, f1, f2, src in zip(part["doc_id"], texts[i:j], part["at"], part["first"],
                                                     part["f1"], part["f2"], part["source"]):
                    raw = t.encode("utf-8", "surrogatepass")
                    h = hasher.word_hashes(raw)
                    first = np.full(len(h) - WINDOW + 1, -1, np.int64)
                    first[np.asarray(at, np.int64)] = np.asarray(fs, np.int64)
                    if f1 is not None:
                        known = {(a, b): s for a, b, s in zip(f1, f2, src)}
                        for k, key in enumerate(zip(hasher.runs(h, WINDOW).view(np.int64).tolist(),
                                                    hasher.runs(h, WINDOW, True).view(np.int64).tolist())):
                            if key in known:
                                first[k] = max(first[k], known[key])
                    shard.add(int(d), h, first)
                    waiting.append((d, raw.split()))
                out = []
                for (d, words), drop in zip(waiting, shard.locate()):
                    kept = [w for w, x in zip(words, drop) if not x]
                    out.append((d, len(words), len(words) - len(kept), write(kept)))
                yield pd.DataFrame(out, columns=RESULT)

    met = pending.select("doc_id", "text", "at", "first").join(found, "doc_id", "left")
    return met.mapInPandas(rows, "doc_id long, n_words long, n_removed long, kept string")


def drop_repeats(docs: DataFrame, write=joined) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and ``kept``: the kept words, joined by a space, or their ``digest``."""
    spans = written(spans_of(docs), "anchors")
    once = written(first_pass(docs, marks_of(spans), write), "first-pass")
    pending = once.filter("text IS NOT NULL")
    windows = written(pending.select("doc_id", F.explode(F.arrays_zip("w1", "w2")).alias("w"))
                      .select("doc_id", "w.w1", "w.w2"), "windows")
    source = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("hi"))
    copied = windows.join(source.filter("source <> hi").drop("hi"), ["w1", "w2"]).filter("doc_id <> source")
    found = copied.groupBy("doc_id").agg(F.collect_set(F.struct("w1", "w2", "source")).alias("m"))
    found = found.select("doc_id", F.col("m.w1").alias("f1"), F.col("m.w2").alias("f2"), F.col("m.source").alias("source"))
    return once.filter("text IS NULL").select(*RESULT).unionByName(second_pass(pending, found, write))
