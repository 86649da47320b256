"""BPE encoding and decoding (operator 1): minimal acyclic transducer lexicon.

Encoding a text: special tokens are cut out as they stand; the rest is
normalised (NFC, white space to a space, lower case) and split into words;
a word's ids come from the lexicon, and words it lacks are merged exactly, lowest
rank first.  The lexicon is compiled from the most frequent words of the whole
corpus (Spark counts them; ``size`` bounds what reaches the driver), kept in
``spark.checkpoint.dir``, shipped by Spark and memory-mapped by every worker.
It only saves work: results do not depend on which words are in it.  A text
with code points that Python's Unicode tables do not know is normalised and split by the
vocabulary's own library, whose tables are other ones.

The vocabulary file is in the JSON format of the tokenizers library and must
use the scheme above: byte-level alphabet, an end-of-word suffix, no decoder
(tokens are then joined by a space).

Results for odd input: NULL and empty texts have no ids and decode to the empty
string; repeated rows get equal answers; a NULL id is kept; an empty table
gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
import unicodedata
import uuid
from array import array
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from tokenizers import Tokenizer

from ..session import ensure_checkpoint_dir
from .common import quoted, written
from .lexicon import Lexicon, compile_lexicon

# the vocabulary's word pattern; \x1c-\x1f are white space to Python, not to the vocabulary
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|(?:[^\s\p{L}\p{N}]|[\x1c-\x1f])+")
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\r\x0b\x0ca-z0-9]+")
ODD_SPACE = re.compile("[\x1c-\x1f]")
BLANK = re.compile(r"[^\S\x1c-\x1f]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and special tokens of a vocabulary file."""

    LONG, NONE = 256, 1 << 62

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("decoder") or not model.get("end_of_word_suffix"):
            raise ValueError("the vocabulary must be BPE with a word-end suffix and without a decoder")
        self.suffix = model["end_of_word_suffix"]
        self.ids = model["vocab"]
        ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        # (left id, right id) -> rank and merged id, packed
        self.pairs = {(self.ids[a] << 32) | self.ids[b]: (r << 32) | self.ids[a + b] for (a, b), r in ranks.items()
                      if a in self.ids and b in self.ids and a + b in self.ids}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.letters = byte_letters()
        self.tokens = [""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def merge(self, word: str) -> list[int]:
        """Exact merging of one word: always the pair of lowest rank, the leftmost of equal ones."""
        letters = [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        letters[-1] += self.suffix
        parts = [self.ids[p] for p in letters if p in self.ids]
        if len(parts) > self.LONG:
            return self.merge_long(parts)
        pairs, none = self.pairs, self.NONE
        ranks = [pairs.get((a << 32) | b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i:i + 2] = [best & 0xFFFFFFFF]
            del ranks[i]
            if i:
                ranks[i - 1] = pairs.get((parts[i - 1] << 32) | parts[i], none)
            if i < len(ranks):
                ranks[i] = pairs.get((parts[i] << 32) | parts[i + 1], none)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same with a heap over a linked list: n log n for words of any length."""
        after, before = [*range(1, len(parts)), -1], [-1, *range(len(parts) - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (r := self.pairs.get((parts[i] << 32) | parts[j])) is not None:
                heapq.heappush(heap, (r >> 32, i, parts[i], parts[j], r & 0xFFFFFFFF))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i] if parts[i] == a else -1
            if j < 0 or parts[j] != b:
                continue  # one of the two has changed since
            parts[i], parts[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p >= 0]


class Newer:
    """The vocabulary's own normaliser and word splitter, for code points where Python's tables may differ.

    Python and the tokenizers library carry different Unicode versions; texts come
    out alike but for code points that Python does not know and the order of combining
    marks, so only texts with one (outside the first marks, U+0300 on) take this way.
    """

    # assigned long ago, no combining marks: most texts need no closer look
    OTHER = re.compile("[^\x00-\u0233\u1e00-\u1eff\u2010-\u2027\u2030-\u205e\u20a0-\u20b5]")
    seen: dict[str, bool] = {}

    def __init__(self, spec: str):
        self.spec, self._library = spec, None

    @classmethod
    def differs(cls, c: str) -> bool:
        if c not in cls.seen:
            cls.seen[c] = unicodedata.category(c) == "Cn" or (
                unicodedata.combining(c) != 0 and not 0x300 <= ord(c) <= 0x344)
        return cls.seen[c]

    @classmethod
    def in_text(cls, text: str) -> bool:
        if text.isascii():
            return False
        try:
            text.encode("latin-1")  # quicker than any search, and enough for many texts
        except UnicodeEncodeError:
            return cls.OTHER.search(text) is not None and any(map(cls.differs, set(text)))
        return False

    @property
    def library(self) -> Tokenizer:
        if self._library is None:
            self._library = Tokenizer.from_str(self.spec)
        return self._library

    def chunks_of(self, text: str) -> list[str]:
        normaliser = self.library.normalizer
        return [c for c in (normaliser.normalize_str(text) if normaliser else text).split(" ") if c]

    def words_of(self, chunk: str) -> list[str]:
        return [chunk[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(chunk)]


def normalised(text: str) -> str:
    """NFC and lower case, letter by letter (no final-sigma rule)."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    return "".join(c.lower() for c in text) if "Σ" in text else text.lower()


def chunks_of(text: str) -> list[str]:
    """White-space free chunks; words never reach across white space."""
    return BLANK.split(text) if ODD_SPACE.search(text) else text.split()


def words_of(chunk: str) -> list[str]:
    return ASCII_PIECES.findall(chunk) if chunk.isascii() else PIECES.findall(chunk)


class Encoder:
    """Encodes batches of texts; remembers at most ``remember`` chunks."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None, newer: Newer | None = None, remember: int = 500_000):
        self.vocabulary, self.lexicon, self.newer, self.remember = vocabulary, lexicon, newer, remember
        self.known: dict[str, bytes] = {}

    def chunks_of(self, text: str) -> list[str]:
        return self.newer.chunks_of(text) if self.newer and Newer.in_text(text) else chunks_of(normalised(text))

    def words_of(self, chunk: str) -> list[str]:
        return self.newer.words_of(chunk) if self.newer and Newer.in_text(chunk) else words_of(chunk)

    def learn(self, chunks) -> None:
        parts = {c: self.words_of(c) for c in chunks}
        words = list({w for ws in parts.values() for w in ws})
        found = self.lexicon.lookup([w.encode("utf-8", "surrogatepass") for w in words]).tolist() if self.lexicon else [-1] * len(words)
        ids = {}
        for w, r in zip(words, found):
            ids[w] = self.lexicon.output(r) if r >= 0 else array("I", self.vocabulary.merge(w)).tobytes()
        for c, ws in parts.items():
            self.known[c] = b"".join([ids[w] for w in ws])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit words."""
        v = self.vocabulary
        cut = [v.cut.split(t) if v.cut and "<" in t else [t] for t in texts]
        pieces = [[p if i % 2 else self.chunks_of(p) for i, p in enumerate(ps)] for ps in cut]
        missing = {c for ps in pieces for p in ps[::2] for c in p if c not in self.known}
        if len(self.known) + len(missing) > self.remember:
            self.known = {}
            missing = {c for ps in pieces for p in ps[::2] for c in p}
        self.learn(missing)
        known = self.known
        return [b"".join([np.array([v.special[p]], "<u4").tobytes() if i % 2 else b"".join([known[c] for c in p])
                          for i, p in enumerate(ps)]) for ps in pieces]

    def decode(self, ids: bytes) -> str:
        tokens = self.vocabulary.tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def text_slices(texts: list[str], size: int = 1 << 22):
    """Consecutive ranges of about ``size`` characters: bounds what is held at once."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def frequent_words(docs: DataFrame, size: int, longest: int = 64, flush: int = 200_000) -> list[str]:
    """About ``size`` most frequent words of at most ``longest`` bytes; tasks add up their own counts first.

    Classes of counts (sixteenths of a doubling) are taken from the top; of the class that
    no longer fits whole, the share that does goes by hash.  The driver gets one row per class
    and the words chosen, at every number of partitions.
    """
    def counted(batches):
        chunks: Counter = Counter()

        def emit():
            words: Counter = Counter()
            for c, n in chunks.items():
                for w in words_of(c):
                    words[w] += n
            chunks.clear()
            return pd.DataFrame({"word": [w.encode("utf-8", "surrogatepass") for w in words], "n": list(words.values())})

        for pdf in batches:
            for t in pdf["text"]:
                if t:
                    chunks.update(chunks_of(normalised(t)))
                    if len(chunks) > flush:
                        yield emit()
        yield emit()

    counts = docs.select("text").mapInPandas(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    level = F.floor(F.log2("n") * 16).cast("int")
    ranked = written(counts.filter((F.col("n") > 1) & (F.octet_length("word") <= longest))
                     .select("word", level.alias("level")), "words")
    left, lowest, share = size, 0, 1.0
    for lowest, n in ranked.groupBy("level").count().orderBy(F.col("level").desc()).collect():
        share = min(1.0, left / n)
        left -= n
        if left <= 0:
            break
    place = F.pmod(F.xxhash64("word"), F.lit(1 << 30))
    top = ranked.filter((F.col("level") > lowest) | (F.col("level") == lowest) & (place < int(share * (1 << 30))))
    return sorted(bytes(r["word"]).decode("utf-8", "surrogatepass") for r in top.select("word").collect())


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, size: int = 100_000) -> str:
    """Compile the frequent words, store the file in the shared folder; its name for the workers."""
    spark = docs.sparkSession
    outputs = {w.encode("utf-8", "surrogatepass"): vocabulary.merge(w) for w in frequent_words(docs, size)}
    data = compile_lexicon(outputs)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}")
    fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(at)
    out.write(bytearray(data))
    out.close()
    fs.deleteOnExit(at)
    sc.addFile(at.toString())
    return name


def encode_documents(docs: DataFrame, vocabulary_path: str, keep: list[str], decode: bool = False,
                     size: int = 100_000) -> DataFrame:
    """``keep``, n_tokens and ``ids`` (little-endian 32-bit words) of every row, with ``decode`` also the text of the ids."""
    with open(vocabulary_path, encoding="utf-8") as f:
        text = f.read()
    spec = docs.sparkSession.sparkContext.broadcast(text)  # one fixed vocabulary file
    name = build_lexicon(docs, Vocabulary(json.loads(text)), size)

    def rows(batches):
        coder = Encoder(Vocabulary(json.loads(spec.value)), Lexicon.open(SparkFiles.get(name)), Newer(spec.value))
        gc.freeze()  # the tables live as long as the task: no cycles to look for in them
        gc.set_threshold(200_000, 50, 1000)
        for b in batches:
            texts = [t or "" for t in b.column(len(keep)).to_pylist()]
            for i, j in text_slices(texts):
                ids = coder.encode(texts[i:j])
                cols = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if decode:
                    cols.append(pa.array([coder.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays([*[c.slice(i, j - i) for c in b.columns[:len(keep)]], *cols],
                                                 names=kinds.names)

    kinds = StructType([StructField(c, docs.schema[c].dataType) for c in keep])  # Arrow, as pandas rounds ids beside a NULL
    kinds = kinds.add("n_tokens", "long").add("ids", "binary")
    if decode:
        kinds = kinds.add("decoded", "string")
    return docs.select(*[quoted(c) for c in keep], F.col("text").alias("_text")).mapInArrow(rows, kinds)
