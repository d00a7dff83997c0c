"""Ranked lexical search, term at a time with limited accumulators.

Terms are the runs of ASCII letters and digits and of all characters beyond
ASCII, A-Z lower-cased.  With N documents that hold a term, L terms in all, n
in a document, df documents that hold a term and tf of it in a document::

    w = floor(1000 ln((2 N + 2) / (2 df + 1)))       m = 50 + (50 n N) div L
    score = sum over the item's distinct terms of w ((10^9 tf) div (1000 tf + 20 m))

1. The items' distinct terms are the vocabulary; documents are read once and
   give their length and their counts of vocabulary terms.  Items come in
   blocks of about ``pairs`` distinct (item, term) pairs, so what reaches the
   tasks is bounded; a larger set of items takes more passes.
2. N, L and df are summed over all documents.
3. A task indexes its documents part by part and answers every item of the
   block term by term, rarest first.  A document gets an accumulator when a
   term meets it first, until the bounds of the remaining terms (weight times
   greatest impact in the part) add up to less than the k-th best score so
   far: no document without an accumulator can be among the best any more.
   From then on only those that have one are updated, to their exact scores.
   The k-th best goes from part to part.  k rows an item leave a task.
4. The best k of all tasks, first by item and part of the documents, then by
   item.

Defined results: a null text has no terms; rows of one ``item_id``, null too,
are one item of all their terms; every document row counts, repeated ones as
often as they come; scores are above 0, equal ones go by ascending
``doc_id``, a null one last; an empty table, on either side, gives no rows;
other columns are neither read nor returned.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType

from kiln.session import materialize

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of a term as they are, lower-cased; all others as a blank.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())
#: Documents and postings indexed together, bytes of a text cut at a time.
PART_DOCUMENTS, PART_POSTINGS, PART_BYTES = 1 << 14, 1 << 22, 1 << 20


def terms_of(text: Column) -> Column:
    """The terms of a short text as an array."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))


def _counted(data: bytes) -> tuple[int, Counter]:
    """The number of terms of a text and of each."""
    data = data.translate(_TABLE)
    counts: Counter = Counter()
    n = at = 0
    while at < len(data):
        end = data.find(b" ", at + PART_BYTES)
        end = len(data) if end < 0 else end
        terms = data[at:end].split()
        n += len(terms)
        counts.update(terms)
        at = end
    return n, counts


def _postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, times`` of every document that has a term; ``terms``
    and ``times`` hold those of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)  # of a block's size
    ids = docs.schema["doc_id"]
    kind = StructType([ids, *StructType.fromDDL("n long, terms array<int>, times array<int>").fields])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                at, sizes, terms, times = [], [], [], []
                for i, text in enumerate(part.column("text")):
                    n, counts = _counted(text.as_buffer().to_pybytes()) if text.is_valid else (0, Counter())
                    if n:
                        mine = counts.keys() & known.keys()
                        at.append(i)
                        sizes.append(n)
                        terms.append([known[t] for t in mine])
                        times.append([counts[t] for t in mine])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(at, pa.int32())), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))],
                    ["doc_id", "n", "terms", "times"])

    return docs.select("doc_id", "text").mapInArrow(count, kind)


class _Best:
    """The best ``k`` (score, document) pairs of an item so far."""

    def __init__(self, k: int):
        self._k = k
        self.scores = np.zeros(0, np.int64)
        self.documents = np.zeros(0, np.int64)
        self.absent = np.zeros(0, bool)

    @property
    def least(self) -> int:
        """A score below this is not among the best."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self._k else 1

    def add(self, scores: np.ndarray, documents: np.ndarray, absent: np.ndarray) -> None:
        scores = np.concatenate((self.scores, scores))
        documents, absent = np.concatenate((self.documents, documents)), np.concatenate((self.absent, absent))
        best = np.lexsort((documents, absent, -scores))[:self._k]
        self.scores, self.documents, self.absent = scores[best], documents[best], absent[best]


class Part:
    """An index of some documents: postings by term."""

    def __init__(self, documents: np.ndarray, absent: np.ndarray, m: np.ndarray, sizes: np.ndarray, terms: np.ndarray, times: np.ndarray):
        self.documents, self.absent = documents, absent
        at = np.repeat(np.arange(len(sizes)), sizes)
        times = times.astype(np.int64)
        impact = (1_000_000_000 * times) // (1000 * times + 20 * m[at])
        order = np.argsort(terms, kind="stable")
        terms = terms[order]
        self._at, self._impact = at[order], impact[order]
        first = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])[:len(terms)])
        greatest = np.maximum.reduceat(self._impact, first) if len(first) else first
        ends = np.append(first[1:], len(terms))
        self._places = {t: (b, e, g) for t, b, e, g in zip(terms[first].tolist(), first.tolist(), ends.tolist(), greatest.tolist())}

    def search(self, query: list[tuple[int, int]], best: _Best, k: int) -> int:
        """Adds the part's documents to the best of a query, (term, weight)
        rarest first; the number of accumulators made."""
        found = [(*self._places[t], w) for t, w in query if t in self._places]
        bounds = [w * greatest for _, _, greatest, w in found]
        rest, seen = sum(bounds), 0
        scores = np.zeros(len(self.documents), np.int64)
        creating = True
        for (begin, end, _, weight), bound in zip(found, bounds):
            if creating:
                enough = best.least
                if rest < seen and len(scores) >= k:
                    enough = max(enough, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                creating = rest >= enough
                if not creating and not seen:
                    return 0
            at, gain = self._at[begin:end], weight * self._impact[begin:end]
            if not creating:
                alive = scores[at] > 0
                at, gain = at[alive], gain[alive]
            scores[at] += gain
            rest -= bound
            seen += bound
        made = np.flatnonzero(scores)
        top = made[scores[made] >= best.least]
        if len(top) > k:
            top = top[scores[top] >= np.partition(scores[top], len(top) - k)[len(top) - k]]
        if len(top):
            best.add(scores[top], self.documents[top], self.absent[top])
        return len(made)


def normalised(n: np.ndarray, n_documents: int, n_terms: int) -> np.ndarray:
    """``50 + (50 n N) div L``, exact also where the product has over 64 bits."""
    if len(n) and 50 * int(n.max()) * n_documents >= 2 ** 63:
        n = n.astype(object)
    return (50 + (50 * n * n_documents) // n_terms).astype(np.int64)


def _parts(batches: Iterator[pa.RecordBatch], n_documents: int, n_terms: int) -> Iterator[Part]:
    def part(held: list[pa.RecordBatch]) -> Part:
        ids, n, terms, times = (pa.concat_arrays([h.column(c) for h in held]) for c in ("doc_id", "n", "terms", "times"))
        return Part(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), normalised(n.to_numpy(), n_documents, n_terms),
                    pc.list_value_length(terms).to_numpy(), terms.flatten().to_numpy(), times.flatten().to_numpy())

    held, rows, postings = [], 0, 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            held.append(batch.slice(lo, 1024))
            rows += held[-1].num_rows
            postings += len(held[-1].column("terms").flatten())
            if rows >= PART_DOCUMENTS or postings >= PART_POSTINGS:
                yield part(held)
                held, rows, postings = [], 0, 0
    if held:
        yield part(held)


def _searched(postings: DataFrame, items: pa.ChunkedArray, queries: list[list[tuple[int, int]]], n_documents: int, n_terms: int, k: int, item: StructField) -> DataFrame:
    """``item_id, doc_id, score``: each task's best of each item."""
    shared = postings.sparkSession.sparkContext.broadcast((items, queries))  # of a block's size

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, queries = shared.value
        best = [_Best(k) for _ in queries]
        for part in _parts(batches, n_documents, n_terms):
            for query, own in zip(queries, best):
                part.search(query, own, k)
        for lo in range(0, len(best), 256):
            own = best[lo:lo + 256]
            at = np.repeat(np.arange(lo, lo + len(own)), [len(b.scores) for b in own])
            documents = pa.array(np.concatenate([b.documents for b in own]), mask=np.concatenate([b.absent for b in own]))
            yield pa.RecordBatch.from_arrays([items.take(pa.array(at)).combine_chunks(), documents, pa.array(np.concatenate([b.scores for b in own]))], ["item_id", "doc_id", "score"])

    return postings.mapInArrow(search, StructType([item, *StructType.fromDDL("doc_id long, score long").fields]))


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def _block(docs: DataFrame, items: pa.Table, k: int, item: StructField) -> DataFrame | None:
    vocabulary = sorted({t for terms in items.column("terms").to_pylist() for t in terms})
    numbers = {t.encode(): i for i, t in enumerate(vocabulary)}
    postings = materialize(_postings(docs, numbers), "term-counts")
    n_documents, n_terms = postings.agg(F.count("*"), F.sum("n")).first()
    if not n_documents:
        return None
    df = {r["term"]: r["df"] for r in postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
    of_term = {t: (df[numbers[t.encode()]], t) for t in vocabulary if numbers[t.encode()] in df}
    queries = []
    for terms in items.column("terms").to_pylist():
        rarest = sorted(of_term[t] for t in terms if t in of_term)
        queries.append([(numbers[t.encode()], w) for n, t in rarest if (w := weight(n_documents, n)) > 0])
    return _searched(postings, items.column("item_id"), queries, n_documents, n_terms, k, item)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, pairs: int = 1_000_000) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents (``doc_id,
    text``) of each item (``item_id, text``)."""
    distinct = items.select("item_id", F.explode(terms_of(F.col("text"))).alias("term")).distinct()
    grouped = materialize(distinct.groupBy("item_id").agg(F.collect_list("term").alias("terms")), "item-terms")
    n = grouped.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-n // pairs)
    found = []
    for b in range(blocks):
        table = grouped.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow()
        if len(table) and (part := _block(docs, table, k, items.schema["item_id"])) is not None:
            found.append(part)
    if not found:
        return docs.sparkSession.createDataFrame([], StructType([items.schema["item_id"], *StructType.fromDDL("rank int, doc_id long, score long").fields]))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = reduce(DataFrame.unionByName, found).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order))).filter(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
