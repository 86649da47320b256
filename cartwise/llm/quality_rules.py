"""Quality rules (operator 3): risk-controlled thresholds.

Fixed base rules (too few words, too much repetition) come first.  Beyond them,
four measures of a text (repeated words, symbols, duplicate lines, long words)
each have a grid of cutoffs, set before any label is seen.  On a labelled
holdout, a cutoff's false rejections are the documents of quality 1 that pass
the base rules and that the cutoff rejects.  For every stratum and rule, the
lowest cutoff is taken whose exact (Clopper-Pearson) upper bound on the rate of
false rejection is at most ``risk``, at confidence 1 - ``error`` shared out
over all strata, rules and cutoffs tested (Bonferroni).  A rule without such a
cutoff stays off in that stratum; a stratum without labels only has the base rules.

The bound is the binomial tail itself: k of n rejections are certified when
P(Bin(n, risk) <= k) <= error / tests.  The largest such k is found per
stratum by summing the tail in logarithms.

Everything is DataFrame functions: words are split once per row, three-word
windows are sorted inside the row, nothing is exploded.  The thresholds table
has one row per stratum that can certify anything; such a stratum holds at
least ln(error / tests) / ln(1 - risk) labelled documents.  It is joined by stratum
and salt, so a hot stratum's rows are spread; Spark broadcasts it where it is small.

Results for odd input: NULL and empty texts have no words and fail the base
rules; a NULL stratum is a stratum of its own; repeated rows get equal
verdicts; an empty table gives an empty result; without labels only the base
rules act.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, full_text, written

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MEASURES = {  # name: (numerator per cent, grid of cutoffs in per cent, lowest first)
    "repeat": [5, 10, 15, 20, 25, 30, 35, 40, 45],
    "symbol": [1, 2, 3, 4, 5, 7, 10, 15, 20, 30],
    "dup_line": [5, 10, 15, 20, 25, 30, 40, 50, 60, 75],
    "long_word": [8, 9, 10, 11, 12, 14, 16, 20, 25],
}


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the counts of every row.

    Words in repeated three-word windows: windows are (text, position)
    entries sorted by text; an entry equal to a neighbour marks its position.
    Marked positions, sorted again, each add the words that the next one does
    not cover.  Each step is its own projection, so that no array is built twice.
    """
    text = full_text(docs)
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    df = docs.select(
        *keep, F.filter(F.split(text, SPACES), lambda x: x != "").alias("w"), lines.alias("l"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    df = df.select(*keep, "word_chars", "n_symbols", "w", F.size("w").cast("long").alias("n_words"),
                   F.size("l").cast("long").alias("n_lines"),
                   (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"))
    counted = [*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines"]
    most = F.greatest(F.col("n_words").cast("int"), F.lit(1))
    two = F.zip_with("w", F.slice("w", 2, most), lambda a, b: F.concat(a, F.lit(" "), b))
    df = df.select(*counted, "w", two.alias("two"))
    three = F.zip_with("two", F.slice("w", 3, most), lambda ab, c: F.concat(ab, F.lit(" "), c))
    df = df.select(*counted, F.sort_array(F.filter(
        F.transform(three, lambda x, i: F.struct(x.alias("t"), i.alias("p"))),
        lambda e: e["t"].isNotNull())).alias("e"))
    none = F.array(F.struct(F.lit(None).cast("string").alias("t"), F.lit(-1).alias("p")))
    df = df.select(*counted, F.zip_with(
        F.zip_with("e", F.concat(none, "e"), lambda e, b: F.struct(
            e["t"].alias("t"), e["p"].alias("p"), F.coalesce(e["t"] == b["t"], F.lit(False)).alias("same"))),
        F.slice("e", 2, most),
        lambda e, a: F.when(e["same"] | F.coalesce(e["t"] == a["t"], F.lit(False)), e["p"])).alias("m"))
    df = df.select(*counted, F.sort_array(F.filter("m", lambda p: p.isNotNull())).alias("m"))
    gaps = F.zip_with("m", F.slice("m", 2, most), lambda p, q: F.least(F.lit(3), F.coalesce(q - p, F.lit(3))))
    return df.select(*counted, F.aggregate(gaps, F.lit(0), lambda s, g: s + g).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def exceeds(rule: str, cutoff) -> Column:
    """Whether a text is above ``cutoff`` per cent (long_word: characters a word)."""
    cut = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    if rule == "repeat":
        return 100 * F.col("n_repeat_words") > cut * F.col("n_words")
    if rule == "symbol":
        return 100 * F.col("n_symbols") > cut * F.col("word_chars")
    if rule == "dup_line":
        return 100 * F.col("n_dup_lines") > cut * F.col("n_lines")
    return F.col("word_chars") > cut * F.col("n_words")


def allowed_rejections(n: Column, risk: float, log_level: Column) -> Column:
    """Largest k with ln P(Bin(n, risk) <= k) <= log_level, or -1."""
    odds = math.log(risk) - math.log1p(-risk)
    start = F.struct((n * F.lit(math.log1p(-risk))).cast("double").alias("lp"),
                     (n * F.lit(math.log1p(-risk))).cast("double").alias("tail"), F.lit(-1).cast("long").alias("k"))

    def step(s, j):  # j = 0, 1, ..: tail is ln P(X <= j)
        term = s["lp"] + F.log((n - j) / (j + 1)) + odds
        top = F.greatest(s["tail"], term)
        return F.struct(term.alias("lp"),
                        (top + F.log(F.exp(s["tail"] - top) + F.exp(term - top))).alias("tail"),
                        F.when(s["tail"] <= log_level, j).otherwise(s["k"]).alias("k"))

    # past the mean n * risk the tail is above one half, so no level can be met there
    reach = F.greatest(F.least(F.ceil(n * risk), n - 1), F.lit(0)).cast("long")
    return F.aggregate(F.sequence(F.lit(0).cast("long"), reach), start, step)["k"]


def thresholds(holdout: DataFrame, risk: float, error: float) -> DataFrame:
    """(stratum, cut_<rule>..): certified cutoffs, NULL where none is.

    ``holdout``: measured rows of good documents that pass the base rules.
    ``risk`` is shared out over the rules, so a stratum's false rejections by
    all of them together stay within it.
    """
    counts = holdout.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(exceeds(r, c).cast("long")).alias(f"{r}_{c}") for r, grid in MEASURES.items() for c in grid])
    counts = written(counts, "holdout")
    tests = max(1, counts.count()) * sum(len(g) for g in MEASURES.values())
    allowed = counts.withColumn("k", allowed_rejections(
        F.col("n"), risk / len(MEASURES), F.lit(math.log(error / tests))))
    cuts = [F.coalesce(*[F.when(F.col(f"{r}_{c}") <= F.col("k"), F.lit(c)) for c in grid]).alias(f"cut_{r}")
            for r, grid in MEASURES.items()]
    return allowed.filter("k >= 0").select("stratum", *cuts)


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02,
                  error: float = 0.05, salts: int = 32) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, kept and the verdict of each rule."""
    rows = docs.select("doc_id", "text", F.col(stratum).alias("stratum"), F.xxhash64("text").alias("trial"))
    rows = written(measured(rows, ["doc_id", "stratum", "trial"]), "measured")
    good = labels.filter("quality = 1").select("doc_id").distinct()
    # the bound counts independent trials: a label is one, however often its document is repeated
    holdout = rows.filter(~base_failed()).join(good, "doc_id", "left_semi")
    holdout = holdout.groupBy("doc_id").agg(F.min(F.struct("trial", "stratum", *COUNTS)).alias("row")).select("row.*")
    cuts = thresholds(holdout, risk, error)
    # a hot stratum's rows meet copies of its cutoffs in as many tasks
    cuts = cuts.withColumnRenamed("stratum", "s").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(salts)).cast("int")
    out = rows.join(cuts, rows["stratum"].eqNullSafe(cuts["s"]) & (salt == cuts["salt"]), "left")
    out = out.withColumn("base_failed", base_failed())
    hits = [F.coalesce(exceeds(r, F.col(f"cut_{r}")), F.lit(False)).alias(f"hit_{r}") for r in MEASURES]
    out = out.select("doc_id", *COUNTS, "base_failed", *hits)
    return out.select("doc_id", *COUNTS[:5], "base_failed",
                      (~F.col("base_failed") & ~(F.greatest(*[F.col(f"hit_{r}") for r in MEASURES]))).alias("kept"),
                      *[f"hit_{r}" for r in MEASURES])
