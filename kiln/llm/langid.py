"""Language identification by known words first, then character n-grams.

Learning counts words by language over labelled documents, a bounded,
hash-chosen sample that gives each language the same share (of
``max_documents``).  Each language's most frequent words and character n-grams
of those documents' words (with a mark at either end of a word) are kept, the
same number for each (of ``max_words`` and ``max_grams``; equal counts go by
the key), with their counts in all languages, and turned into smoothed
log-frequencies by language.  These three bounds are features of the
classifier; they keep the broadcast model at a fixed size.

Scoring reads every word of every text.  A known word adds its
log-frequencies.  An unknown word backs off: its n-grams of the greatest
length are looked up, then of the next shorter length, until some are known,
and their mean log-frequencies are added.  The language with the greatest sum
wins (ties: the smallest name).  ``score`` is the winner's share for the
text's average word: the softmax of the mean log-frequencies.

Defined results: a null text, or one without a letter, is ``und`` with score
0, and so is any text if nothing could be learned; a text with letters of
which nothing is known to the model gets the language with the most labelled
documents, with score 0; labels that are null are not learned; words of any
length are learned, beyond ``LONGEST_KEY`` characters by their digest;
repeated rows repeat their results; an empty table gives no rows; columns
other than the named ones are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from kiln.llm.memo import LONGEST_KEY, slices, tidied, tidy
from kiln.llm.rows import TEXTS_A_BATCH
from kiln.session import materialize, rows_a_batch

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
#: Lengths of character n-grams.
LONGEST = 5


def _words(text: str) -> Iterator[list[str]]:
    for part in slices(text):
        yield _WORD.findall(part.lower())


def _grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _key(word: str) -> str:
    """A word as it is looked up; no word begins with the mark."""
    return word if len(word) <= LONGEST_KEY else "#" + hashlib.md5(word.encode()).hexdigest()


@dataclass
class Model:
    """Log-frequencies (a row for each word or n-gram, a column a language)."""

    languages: list[str]
    words: dict[str, int]
    word_rows: np.ndarray
    grams: dict[str, int]
    gram_rows: np.ndarray
    #: the language of most labelled documents
    usual: str = UNKNOWN

    def backed_off(self, word: str) -> np.ndarray | None:
        for n in range(LONGEST, 0, -1):
            if known := [self.grams[g] for g in _grams(word, n) if g in self.grams]:
                return self.gram_rows[known].mean(0)
        return None


class Scorer(dict):
    """Sums of log-frequencies.  Maps a word to its row of ``_rows``; unknown
    words are scored when first met and forgotten when the rows are full."""

    def __init__(self, model: Model, limit: int = 100_000, part: int = 50_000):
        super().__init__()
        self._model, self._limit, self._part = model, max(limit, part), part
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.update({w: i + 1 for w, i in self._model.words.items()})
        self._next = len(self) + 1
        # row 0 is for words of which nothing is known
        self._rows = np.zeros((self._next + self._limit, len(self._model.languages)))
        self._rows[1:self._next] = self._model.word_rows

    def __missing__(self, word: str) -> int:
        if len(word) > LONGEST_KEY and (known := self.get(_key(word))) is not None:
            return known
        found, i = self._model.backed_off(word) if any(map(str.isalpha, word)) else None, 0
        if found is not None:
            i = self._next
            self._next += 1
            self._rows[i] = found
        if len(word) <= LONGEST_KEY:
            self[word] = i
        return i

    def score(self, text: str) -> tuple[str, float]:
        total, n, letters = np.zeros(len(self._model.languages)), 0, False
        for words in _words(text) if self._model.languages else ():
            for lo in range(0, len(words), self._part):
                part = words[lo:lo + self._part]
                letters = letters or any(c.isalpha() for word in part for c in word)
                if max(self._next, len(self)) + len(part) > len(self._rows):
                    self._forget()
                rows = np.fromiter(map(self.__getitem__, part), np.int64, len(part))
                total += self._rows[rows].sum(0)
                n += np.count_nonzero(rows)
        if not n:
            return (self._model.usual if letters else UNKNOWN), 0.0
        mean = total / n
        share = np.exp(mean - mean.max())
        best = int(np.argmax(total))
        return self._model.languages[best], float(share[best] / share.sum())


def key_counts(labelled: DataFrame) -> DataFrame:
    """``lang, key, n, gram`` from ``text, lang``: words, and the n-grams of
    words too long to be keys; counted in each task first."""

    @tidied
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, bool], Counter] = {}

        def flush():
            for (lang, gram), c in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64()), pa.array([gram] * len(c), pa.bool_())],
                    ["lang", "key", "n", "gram"])
            counts.clear()

        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                    for words in _words(text or ""):
                        counts.setdefault((lang, False), Counter()).update(map(_key, words))
                        for word in words:
                            if len(word) > LONGEST_KEY:
                                for n in range(1, LONGEST + 1):
                                    counts.setdefault((lang, True), Counter()).update(g for g in _grams(word, n) if g not in ("^", "$"))
                    if sum(map(len, counts.values())) > 100_000:
                        yield from flush()
        yield from flush()

    return (labelled.select("text", "lang").mapInArrow(counted, "lang string, key string, n long, gram boolean")
            .groupBy("lang", "key", "gram").agg(F.sum("n").alias("n")))


#: Parts in which the most frequent keys of a language are looked for first.
SALTS = 64


def _frequencies(counts: DataFrame, languages: list[str], most: int) -> tuple[dict[str, int], np.ndarray]:
    """Of ``lang, key, n`` (written) each language's most frequent keys, an
    equal share of ``most``, and their smoothed log-frequencies; only they
    reach the driver."""
    if not languages:
        return {}, np.zeros((0, 0))
    share, order = max(1, most // len(languages)), [F.col("n").desc(), F.col("key").asc()]
    salted = counts.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
    best = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("place") <= share)
    best = best.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= share)
    column = (F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1).cast("string")
    names = [str(i) for i in range(len(languages))]
    kept = counts.join(best.select("key").distinct(), "key", "left_semi")
    by_key = kept.select("key", "n", column.alias("column")).groupBy("key").pivot("column", names).agg(F.sum("n")).fillna(0)
    found = by_key.orderBy("key").toArrow()
    table = np.stack([found.column(c).to_numpy() for c in names], 1).astype(np.float64)
    return {k: i for i, k in enumerate(found.column("key").to_pylist())}, np.log((table + 0.5) / (table.sum(0) + 0.5 * len(table)))


def learn(labelled: DataFrame, max_documents: int = 50_000, max_words: int = 50_000, max_grams: int = 50_000) -> Model:
    """A model from ``doc_id, text, lang``; of a language with more than its
    share of ``max_documents`` labelled rows about that many are taken by a
    hash of the row."""
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    languages = sorted(rows)
    share = max(1, max_documents // max(1, len(languages)))
    for lang in languages:
        if rows[lang] > share:
            some = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int((1 << 30) * share / rows[lang])
            labelled = labelled.filter((F.col("lang") != lang) | some)
    with rows_a_batch(labelled.sparkSession, TEXTS_A_BATCH):
        counts = materialize(key_counts(labelled), "word-counts")
    marked = F.concat(F.lit("^"), "key", F.lit("$"))
    length = F.length(marked)
    grams = [F.transform(F.sequence(F.lit(1), length - n + 1), lambda i, n=n: F.substring(marked, i, F.lit(n))) for n in range(1, LONGEST + 1)]
    grams = [F.when(length >= n, g).otherwise(F.array().cast("array<string>")) for n, g in enumerate(grams, 1)]
    of_words = counts.filter("NOT gram AND key NOT LIKE '#%'").select("lang", "n", F.explode(F.flatten(F.array(*grams))).alias("key")).filter(~F.col("key").isin("^", "$"))
    gram_counts = materialize(of_words.unionByName(counts.filter("gram").select("lang", "n", "key")).groupBy("lang", "key").agg(F.sum("n").alias("n")), "gram-counts")
    usual = min(languages, key=lambda lang: (-rows[lang], lang), default=UNKNOWN)
    return Model(languages, *_frequencies(counts.filter("NOT gram").select("lang", "key", "n"), languages, max_words), *_frequencies(gram_counts, languages, max_grams), usual)


def predict(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key, lang_pred, score`` of each row's ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_words and max_grams

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = [scorer.score(t) if t else (UNKNOWN, 0.0) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], [key, "lang_pred", "score"])

    given = docs.select(key, "text")
    return given.mapInArrow(predicted, StructType([given.schema[key], StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def in_known_language(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """``docs`` (with ``doc_id, text, lang``) without the rows that have no
    letter or whose language is unclear (score under ``least``).  Where no row
    has a ``lang`` nothing can be learned and nothing is rejected.  Only the
    texts go to Python; the rows wait for its answer where they are."""
    model = learn(docs.select("doc_id", "text", "lang"))
    if not model.languages:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_words and max_grams

    @F.arrow_udf("boolean")
    def clear(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tidy()
        scorer = Scorer(shared.value)
        try:
            for texts in batches:
                found = [scorer.score(t.as_py()) if t.is_valid else (UNKNOWN, 0.0) for t in texts]
                yield pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_())
        finally:
            scorer = None
            tidy()

    return docs.filter(clear(F.col("text")))


def fold(of: int) -> Column:
    """crc32 of ``doc_id`` as text, modulo ``of``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of, F.lit(0))
