"""J15 F20 D8 — best fuzzy match by a segment index.

Names are normalised and token-sorted.  Two names of lengths n and m match
when their distance is at most k(n, m), a bound the cutoff sets: Levenshtein
``floor((100 - c) * max(n, m) / 100)``, InDel ``floor((100 - c) * (n + m) / 100)``.

* **Index.**  A choice of length m is cut into k + 1 even segments, for each k
  that a partner's length can lead to.  An entry is (m, k, segment number, text).
* **Probes.**  k edits leave at least one of k + 1 segments whole, so a query
  of length n holds it: for each m and segment, at the positions that k edits can
  shift it to.  Edits left and right of the segment share k, which narrows the
  window to ``start - i .. start + i`` and ``start + (n - m) - (k - i) .. start
  + (n - m) + (k - i)`` for segment i.  One equi join of entries and probes
  finds every partner: nothing within the cutoff is lost.
* **Filter.**  Entries and probes carry the length and a 64-bit picture of the
  characters (32 classes, one bit for "at least one", one for "at least two").  An
  inserted or deleted character changes at most one bit, a replaced one two, so
  pictures too far apart drop a pair before anything is shuffled again.
* **Verification.**  Distinct pairs of string numbers fetch their strings, and
  the distance is computed once a pair.

Strings are numbered and written once (shared checkpoint folder); index, probes
and both look-ups read that table.  A segment that very many names hold makes
a long list of entries; AQE splits it in the join, and the filter runs there.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import token_sort
from ..session import ensure_checkpoint_dir
from ..sources import literals as L
from .keys import first_per_key

METRICS = ("levenshtein", "indel")


def _make_lcs():
    # Built inside a closure so that cloudpickle ships the code to the
    # Python workers by value: executors need no installed package for the
    # one Python UDF of the library.
    def lcs_length(a: str, b: str) -> int:
        """Length of the longest common subsequence (bit-parallel, one big-int
        step per character of ``b``)."""
        if not a or not b:
            return 0
        masks: dict = {}
        for i, ch in enumerate(a):
            masks[ch] = masks.get(ch, 0) | (1 << i)
        full = (1 << len(a)) - 1
        v = full
        for ch in b:
            u = v & masks.get(ch, 0)
            v = ((v + u) | (v - u)) & full
        return len(a) - bin(v).count("1")
    return lcs_length


lcs_length = _make_lcs()


def _lcs_udf():
    lcs_fn = lcs_length

    @F.pandas_udf("int")
    def lcs(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([lcs_fn(x, y) for x, y in zip(a, b)], dtype="int32")
    return lcs


def total_length(n: Column, m: Column, metric: str) -> Column:
    """What a score is relative to: the longer length, or both (InDel)."""
    return n + m if metric == "indel" else F.greatest(n, m)


def edit_bound(n: Column, m: Column, cutoff: int, metric: str) -> Column:
    """Most edits two matching names of these lengths are apart."""
    return F.floor(total_length(n, m, metric) * (100 - cutoff) / 100).cast("int")


def partner_lengths(n: Column, cutoff: int, metric: str) -> Column:
    """All lengths a matching name can have, ascending."""
    low, high = (cutoff, 200 - cutoff) if metric == "indel" else (cutoff, 100)
    low = max(low, 1)
    return F.sequence(F.greatest(F.ceil(n * low / high), F.lit(1)).cast("int"), F.floor(n * high / low).cast("int"))


def picture(s: Column) -> Column:
    """Classes of characters that occur once (low 32 bits) and again (high 32 bits)."""
    def add(state: Column, ch: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(ch), F.lit(32)))
        return state.bitwiseOR(F.when(state.bitwiseAND(bit) == 0, bit).otherwise(F.shiftleft(bit, 32)))
    return F.aggregate(F.split(s, ""), F.lit(0).cast("long"), add)


def segment_bounds(m: Column, k: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 0) and length of segment ``i`` of ``k + 1`` of a string of length ``m``."""
    start = F.floor(m * i / (k + 1)).cast("int")
    return start, F.floor(m * (i + 1) / (k + 1)).cast("int") - start


def entry_keys(s: Column, m: Column, cutoff: int, metric: str) -> Column:
    """Hashes of the index entries (length, k, segment number, text) of a string."""
    def segments(k: Column) -> Column:
        def one(i: Column) -> Column:
            start, size = segment_bounds(m, k, i)
            return F.xxhash64(m, k, i, F.substring(s, start + 1, size))
        return F.transform(F.sequence(F.lit(0), k), one)
    bounds = F.array_distinct(F.transform(partner_lengths(m, cutoff, metric), lambda n: edit_bound(n, m, cutoff, metric)))
    return F.array_distinct(F.flatten(F.transform(bounds, segments)))


def probe_keys(s: Column, n: Column, cutoff: int, metric: str) -> Column:
    """Hashes of the entries that a partner of the string can have."""
    def segments(m: Column) -> Column:
        k = edit_bound(n, m, cutoff, metric)

        def one(i: Column) -> Column:
            start, size = segment_bounds(m, k, i)
            low = F.greatest(F.lit(0), start - i, start + (n - m) - (k - i))
            high = F.least(n - size, start + i, start + (n - m) + (k - i))
            at = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
            return F.transform(at, lambda p: F.xxhash64(m, k, i, F.substring(s, p + 1, size)))
        return F.flatten(F.transform(F.sequence(F.lit(0), k), one))
    return F.array_distinct(F.flatten(F.transform(partner_lengths(n, cutoff, metric), segments)))


def numbered_strings(queries: DataFrame, choices: DataFrame) -> DataFrame:
    """(sid, s, n, pic, is_query, is_choice) of the distinct strings of both, written once."""
    ensure_checkpoint_dir(queries.sparkSession)
    both = queries.select("_s", F.lit(True).alias("q"), F.lit(False).alias("c")).unionByName(
        choices.select("_s", F.lit(False).alias("q"), F.lit(True).alias("c")))
    one = both.groupBy("_s").agg(F.max("q").alias("is_query"), F.max("c").alias("is_choice"))
    return one.select(F.monotonically_increasing_id().alias("sid"), F.col("_s").alias("s"), F.length("_s").alias("n"),
                      picture(F.col("_s")).alias("pic"), "is_query", "is_choice").checkpoint(eager=True)


def candidate_pairs(strings: DataFrame, cutoff: int, metric: str) -> DataFrame:
    """(qid, cid): distinct pairs that share a segment and pass the length and character filters."""
    s, n = F.col("s"), F.col("n")
    entries = strings.filter("is_choice").select(
        F.col("sid").alias("cid"), n.alias("m"), F.col("pic").alias("cpic"), F.explode(entry_keys(s, n, cutoff, metric)).alias("key"))
    probes = strings.filter("is_query").select(
        F.col("sid").alias("qid"), "n", F.col("pic").alias("qpic"), F.explode(probe_keys(s, n, cutoff, metric)).alias("key"))
    edits = edit_bound(F.col("n"), F.col("m"), cutoff, metric)
    apart = F.bit_count(F.col("qpic").bitwiseXOR(F.col("cpic")))
    met = probes.join(entries, "key").filter(
        (F.abs(F.col("n") - F.col("m")) <= edits) & (apart <= (edits if metric == "indel" else 2 * edits)))
    return met.select("qid", "cid").distinct()


def fuzzy_best(queries: DataFrame, choices: DataFrame, cutoff: int = L.FUZZY_CUTOFF,
               qid: str = "qid", qtext: str = "query", ctext: str = "name",
               metric: str = "levenshtein") -> DataFrame:
    """Best choice per query with token-sorted score >= cutoff.

    ``metric="levenshtein"``: score = 100 * (L - lev) / L, L the longer
    length (native ``levenshtein``).  ``metric="indel"``: the ratio of the
    original matcher, 100 * 2 * LCS / (l1 + l2); the LCS length runs in an
    Arrow-batched pandas UDF on the candidate pairs only.
    Returns (qid, name, score rounded to 4); best by score, then name.
    Queries without a match are absent.
    """
    q = queries.select(qid, token_sort(F.col(qtext)).alias("_s")).filter(F.length("_s") > 0)
    c = choices.select(F.col(ctext).alias("_name")).filter(F.col("_name").isNotNull()).distinct()
    c = c.select("_name", token_sort(F.col("_name")).alias("_s")).filter(F.length("_s") > 0)
    strings = numbered_strings(q, c)
    pairs = candidate_pairs(strings, cutoff, metric)
    pairs = (pairs.join(strings.select(F.col("sid").alias("qid"), F.col("s").alias("_qs")), "qid")
             .join(strings.select(F.col("sid").alias("cid"), F.col("s").alias("_cs")), "cid"))
    total = total_length(F.length("_qs"), F.length("_cs"), metric)
    if metric == "indel":
        dist = total - 2 * _lcs_udf()(F.col("_qs"), F.col("_cs"))
    else:
        dist = F.levenshtein("_qs", "_cs")
    pairs = pairs.select("_qs", "_cs", dist.alias("_dist"), total.alias("_L"))
    pairs = pairs.filter((F.col("_L") - F.col("_dist")) * 100 >= cutoff * F.col("_L"))
    hits = (q.join(pairs.withColumnRenamed("_qs", "_s"), "_s")
            .join(c.withColumnRenamed("_s", "_cs"), "_cs")
            .withColumn("_ratio", F.col("_dist") / F.col("_L")))
    best = first_per_key(hits, qid, [F.col("_ratio").asc(), F.col("_name").asc()])
    return best.select(qid, F.col("_name").alias(ctext),
                       F.round(100.0 * (F.col("_L") - F.col("_dist")) / F.col("_L"), 4).alias("score"))
