"""Language ID (operator 7): error-correcting output codes.

Every language has a codeword of +1 / -1 bits.  For each bit, a binary classifier
tells the languages with +1 from those with -1 by character n-grams (one, two
and three characters of the lower-cased text, hashed): the log ratio of the two
sides' smoothed n-gram frequencies, averaged over the n-grams of a text.  A
text's language is the codeword with the smallest loss, summed over bits as
weight * log(1 + exp(-bit * margin)), a bit weighing as much as its two sides
differ; a text whose two best codewords are closer than ``min_gap`` is flagged
ambiguous.

n-gram counts are taken over all training rows, whole texts, by Spark: a task
adds up its counts per language, Spark sums them, and from the sums each n-gram's
frequencies on both sides of every bit.  The driver holds the languages' names and
codewords and n-grams x bits weights; bits grow with the logarithm of the languages,
of which there may be any number.

Results for odd input: a NULL text, an empty one and one without a letter are
``und`` with score 0; a NULL language is not learnt from; with one language
learnt all other texts get it, with none all are ``und``; repeated rows get
equal answers; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import id_remainder, quoted, written

FOLDS, HELD = 4, 2
DIM = 1 << 13
UNKNOWN = "und"


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the hashed 1-, 2- and 3-grams of the lower-cased text."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    c = np.where((c == 10) | (c == 9) | (c == 13), np.uint64(32), c)
    one, k = c * np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - DIM.bit_length() + 1)
    grams = [one]
    if len(c) > 1:
        two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + one[1:]
        grams.append(two * np.uint64(0x94D049BB133111EB))
        if len(c) > 2:
            three = (two[:-1] ^ (two[:-1] >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + one[2:]
            grams.append(three * np.uint64(0xA0761D6478BD642F))
    return np.bincount(np.concatenate([(g >> k).astype(np.int64) for g in grams]), minlength=DIM)


def has_letter(text) -> bool:
    return isinstance(text, str) and any(map(str.isalpha, text))


def codewords(n: int) -> np.ndarray:
    """n rows of +1 / -1: all splits for up to 5 languages, else well-separated random ones."""
    if n <= 1:
        return np.ones((n, 0))
    if n <= 5:
        splits = range(1, 1 << (n - 1))  # the last language is always -1
        return np.array([[1.0 if s >> i & 1 else -1.0 for s in splits] for i in range(n)])
    bits = max(15, 10 * int(np.ceil(np.log2(n))))
    rng, best, apart = np.random.default_rng(7), None, -1
    for _ in range(50 if n <= 200 else 2):  # long random codewords are well apart as they are
        m = rng.choice([-1.0, 1.0], size=(n, bits))
        m = m[:, np.abs(m.sum(0)) < n]
        d = ((m.shape[1] - m @ m.T) / 2 + np.eye(n) * bits).min()
        if d > apart:
            best, apart = m, d
    return best


class CodeModel:
    """Codewords, one n-gram weight vector per bit, and the bit weights.

    ``plus`` and ``minus``: per n-gram and bit the mean smoothed frequency over
    the languages of either side.
    """

    def __init__(self, languages: list[str], code: np.ndarray, plus: np.ndarray, minus: np.ndarray):
        self.languages, self.code = languages, code
        self.weights = np.log(plus / minus)
        self.bit_weight = ((plus - minus) * self.weights).sum(0) / 2  # mean margin of either side
        # margins in units of half the mean one: texts of every length share a scale
        self.scale = 4 / np.maximum(self.bit_weight, 1e-9)
        if code.shape[1]:
            self.bit_weight = self.bit_weight / max(self.bit_weight.sum(), 1e-9)

    def losses(self, counts: np.ndarray) -> np.ndarray:
        """Loss per language for rows of n-gram counts."""
        margin = counts @ self.weights / np.maximum(counts.sum(1, keepdims=True), 1) * self.scale
        hit, miss = np.logaddexp(0, -margin) * self.bit_weight, np.logaddexp(0, margin) * self.bit_weight
        return hit @ (self.code > 0).T + miss @ (self.code < 0).T


def fit(docs: DataFrame, held: int = 256) -> CodeModel | None:
    """The model of all languages of ``docs``, however many: their n-gram counts stay in Spark.

    A task holds at most ``held`` languages' counts at once.  The driver gets the
    languages with their sizes, and per n-gram and bit the sums over the languages of either side.
    """
    rows = docs.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")

    def add_up(batches):
        sums: dict[str, np.ndarray] = {}

        def counted():
            for lang, c in sums.items():
                at = np.flatnonzero(c)
                yield pd.DataFrame({"lang": lang, "gram": at, "n": c[at]})
            sums.clear()

        for pdf in batches:
            for text, lang in zip(pdf["text"], pdf["lang"]):
                if text:
                    c = ngram_counts(text)
                    sums[lang] = sums[lang] + c if lang in sums else c
                    if len(sums) > held:
                        yield from counted()
        yield from counted()

    grams = written(rows.mapInPandas(add_up, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    sizes = sorted(tuple(r) for r in grams.groupBy("lang").agg(F.sum("n")).collect())
    if not sizes:
        return None
    languages, code = [x for x, _ in sizes], codewords(len(sizes))
    bits = code.shape[1]
    if not bits:
        return CodeModel(languages, code, np.ones((DIM, 0)), np.ones((DIM, 0)))
    place, share = {x: i for i, x in enumerate(languages)}, 1 / (np.array([n for _, n in sizes]) + 0.5 * DIM)

    def by_bit(batches):
        total = np.zeros((DIM, 2 * bits))
        for pdf in batches:
            at = pdf["lang"].map(place).to_numpy()
            for k in range(0, len(at), 4096):
                i = at[k:k + 4096]
                side = np.hstack([code[i] > 0, code[i] < 0]) * (pdf["n"].to_numpy()[k:k + 4096] * share[i])[:, None]
                np.add.at(total, pdf["gram"].to_numpy()[k:k + 4096], side)
        at = np.flatnonzero(total.any(1))
        yield pd.DataFrame({"gram": at, "v": list(total[at])})

    sums = grams.mapInPandas(by_bit, "gram long, v array<double>").groupBy("gram").agg(
        F.array(*[F.sum(F.col("v")[j]) for j in range(2 * bits)]).alias("v")).toPandas()
    sides = np.hstack([code > 0, code < 0])
    freq = np.tile(0.5 * (sides * share[:, None]).sum(0), (DIM, 1))
    freq[sums["gram"]] += np.stack(sums["v"])
    freq /= sides.sum(0)
    return CodeModel(languages, code, freq[:, :bits], freq[:, bits:])


def predict(docs: DataFrame, model: CodeModel | None, keep: list[str], min_gap: float = 0.05) -> DataFrame:
    """k0, k1, .. (the columns ``keep``) and lang_pred, score, ambiguous of every row."""
    def label(text):
        if model is None or not has_letter(text):
            return UNKNOWN, 0.0, True
        if len(model.languages) == 1:
            return model.languages[0], 1.0, False
        loss = model.losses(ngram_counts(text)[None, :].astype(float))[0]
        order = np.argsort(loss, kind="stable")
        p = np.exp(loss[order[0]] - loss) if len(loss) else np.ones(1)
        return model.languages[order[0]], float(1 / p.sum()), bool(loss[order[1]] - loss[order[0]] < min_gap)

    def answer(batches):
        for b in batches:
            got = [label(t) for t in b.column(len(keep)).to_pylist()]
            cols = [pa.array([g[i] for g in got], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], *cols], names=kinds.names)

    kinds = StructType([StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)])
    kinds = kinds.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    return docs.select(*[quoted(c).alias(f"k{i}") for i, c in enumerate(keep)], "text").mapInArrow(answer, kinds)


def languages_of(docs: DataFrame, min_gap: float = 0.05) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, ambiguous; learnt from the other folds' rows."""
    held = id_remainder(F.col("doc_id"), FOLDS) == HELD
    model = fit(docs.filter(~held))
    out = predict(docs, model, ["doc_id"], min_gap)
    out = out.withColumnRenamed("k0", "doc_id")
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


def known_language(docs: DataFrame, min_gap: float = 0.05) -> DataFrame:
    """The documents whose language is told: not ``und`` and not ambiguous; all columns kept."""
    held = id_remainder(F.col("doc_id"), FOLDS) == HELD
    model = fit(docs.filter(~held))
    out = predict(docs, model, docs.columns, min_gap)
    return out.filter(f"lang_pred <> '{UNKNOWN}' AND NOT ambiguous").select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
