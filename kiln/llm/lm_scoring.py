"""Stupid-backoff scores of documents under n-gram counts of the corpus.

Words are as in ``shingles``; n-grams of one to ``ORDER`` words are 64-bit
hashes.  Every document is scored against the counts of all the others: its
own occurrences are taken off first, else each of its n-grams would be known.
For a word after its context, with counts c' so reduced::

    S(w | u v) = c'(u v w) / c'(u v)          if c'(u v w) > 0
                 0.4 * S(w | v)               otherwise
    S(w)       = c'(w) / N'                   if c'(w) > 0, else 0.4 / N'

At a document's start the context is as long as there are words before it.
Logarithms are rounded to a millionth each and added as integers, so that a
score does not depend on the order of addition.

The count tables are partitioned by hash: a bucket holds a range of the hash
values of one order.  To move little, n-grams are exploded and counted by
block (some ``block_bytes`` of text of one input partition) and a row holds a
block's sorted, delta-coded hashes of one bucket.  Each bucket adds up its
rows, a merge of sorted tables, and joins the totals back to the rows, as the
difference to the block's own counts, which is mostly zero.  Blocks then meet
their differences and sum up the logarithms of each document.  A common
n-gram is one entry a block, whatever its count.  The number of buckets grows
with the corpus; once a block has fewer n-grams than there are buckets, a row
holds about one n-gram and the exchange is that of a plain table of n-grams.

Blocks are cut in two scans of the input that must agree.  An input that comes
from a shuffle, whose partitions Spark may merge differently each time, is
written first; and every block's count rows carry a mark of its words, which
must be that of the texts they meet, else the job fails.

Defined results: a document without words (empty or null text) has
``n_words`` 0 and score 0; repeated rows are each scored against the others,
so they know each other's n-grams; an empty table gives no rows; columns
other than ``doc_id`` and ``text`` are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from kiln.llm.shingles import _PLACE, byte_chunks, mix, words_of
from kiln.session import materialize

ORDER, BACKOFF = 3, 0.4
#: Entries of the count tables that a bucket is made for, and words a byte.
BUCKET_ENTRIES, WORDS_A_BYTE = 1_500_000, 0.17


def _micro(x: np.ndarray) -> np.ndarray:
    return np.rint(1e6 * np.log(x)).astype(np.int64)


class _Words:
    """The words of a block's documents, in order."""

    def __init__(self, columns: list[pa.Array]):
        words, sizes = [], []
        for texts in columns:
            for _, data, offsets in byte_chunks(texts):
                found, at = words_of(data, offsets)
                words.append(found)
                sizes.append(np.diff(at))
        self.words = np.concatenate([np.zeros(0, np.uint64), *words])
        self.sizes = np.concatenate([np.zeros(0, np.int64), *sizes]).astype(np.int64)
        self.document = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        # words before it in its document, as far as they matter
        self.before = np.full(len(self.words), ORDER - 1, np.int8)
        begins = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        for j in range(ORDER - 2, -1, -1):
            at = begins[self.sizes[self.sizes > 0] > j] + j
            self.before[at] = j

    def mark(self) -> int:
        """A number that other texts or another order of them would change."""
        places = np.arange(1, len(self.words) + 1, dtype=np.uint64)
        sizes = mix(self.sizes.astype(np.uint64) + np.arange(len(self.sizes), dtype=np.uint64) * _PLACE[0])
        return int((mix(self.words ^ places).sum(dtype=np.uint64) ^ sizes.sum(dtype=np.uint64)).view(np.int64))

    def ends(self, k: int) -> np.ndarray:
        """The places of the words that end a k-gram."""
        return np.flatnonzero(self.before >= k - 1)

    def grams(self, k: int) -> np.ndarray:
        """The k-grams that end at ``ends(k)``."""
        n = len(self.words) - k + 1
        if n < 1:
            return np.zeros(0, np.uint64)
        total = self.words[:n] * _PLACE[0]
        for j in range(1, k):
            total += self.words[j:n + j] * _PLACE[j]
        total += np.uint64(k)
        return mix(total[self.before[k - 1:] >= k - 1])


def _zipped(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unzipped(data: bytes | pa.Buffer) -> pa.Buffer:
    view = memoryview(data)
    return pa.decompress(pa.py_buffer(view[8:]), int.from_bytes(view[:8], "little"), "zstd")


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as the first one and the differences, byte plane by byte
    plane: the low planes are noise, the highest is a few different bytes."""
    steps = np.diff(keys).astype("<u8")
    width = max(1, (int(steps.max() if len(steps) else 0).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width].T)
    high = _zipped(planes[-1].tobytes())
    return keys[:1].astype("<u8").tobytes() + bytes([width]) + len(high).to_bytes(4, "little") + high + planes[:-1].tobytes()


def _unpacked(data: bytes | pa.Buffer) -> np.ndarray:
    data = memoryview(data)
    width, end = data[8], 13 + int.from_bytes(data[9:13], "little")
    high = np.frombuffer(_unzipped(data[13:end]), np.uint8)
    steps = np.zeros((len(high) + 1, 8), np.uint8)
    steps[1:, width - 1] = high
    steps[1:, :width - 1] = np.frombuffer(data, np.uint8, offset=end).reshape(width - 1, -1).T if width > 1 else 0
    steps = steps.reshape(-1).view("<u8").copy()
    steps[0] = np.frombuffer(data, "<u8", 1)[0]
    return np.cumsum(steps, dtype=np.uint64)


def _counts(n: np.ndarray) -> bytes:
    """64-bit counts by byte plane; the upper planes are zeros."""
    return _zipped(np.ascontiguousarray(n.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _uncounted(data: bytes | pa.Buffer) -> np.ndarray:
    planes = np.frombuffer(_unzipped(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").reshape(-1)


def _edges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where the buckets of sorted keys begin and end."""
    if not bits:
        return np.array([0, len(keys)])
    return np.append(np.searchsorted(keys, np.arange(2 ** bits, dtype=np.uint64) << np.uint64(64 - bits)), len(keys))


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """The partition's rows in blocks; cut in the same places each time."""
    held, size, number = [], 0, TaskContext.get().partitionId() << 32
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            part = batch.slice(lo, 64)
            held.append(part)
            size += part.column("text").nbytes
            if size >= block_bytes:
                yield number, held
                held, size, number = [], 0, number + 1
    if held:
        yield number, held


def _tables(docs: DataFrame, bits: int, block_bytes: int) -> DataFrame:
    """``bucket, block, mark, grams, counts``: each block's part of each bucket."""
    def counted(batches):
        for block, held in _blocks(batches, block_bytes):
            words = _Words([h.column("text") for h in held])
            mark = words.mark()
            for k in range(1, ORDER + 1):
                keys = words.grams(k)
                keys.sort()
                last = np.flatnonzero(np.append(keys[1:] != keys[:-1], True)) if len(keys) else np.zeros(0, np.int64)
                keys, n = keys[last], np.diff(last, prepend=-1)
                edges = _edges(keys, bits)
                some = np.flatnonzero(np.diff(edges))
                for lo in range(0, len(some), 64):
                    own = some[lo:lo + 64].tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([(k - 1 << bits) + b for b in own], pa.int64()), pa.array([block] * len(own), pa.int64()), pa.array([mark] * len(own), pa.int64()),
                         pa.array([_packed(keys[edges[b]:edges[b + 1]]) for b in own], pa.binary()), pa.array([_counts(n[edges[b]:edges[b + 1]]) for b in own], pa.binary())],
                        ["bucket", "block", "mark", "grams", "counts"])

    return docs.mapInArrow(counted, "bucket long, block long, mark long, grams binary, counts binary")


def _totals(table: pa.Table) -> pa.Table:
    """A bucket's rows with ``others``: the counts in all other blocks."""
    keys = [_unpacked(x.as_buffer()) for x in table.column("grams")]
    counts = [_uncounted(x.as_buffer()) for x in table.column("counts")]
    merged, at = np.unique(np.concatenate(keys), return_inverse=True)
    own = np.concatenate(counts)
    total = np.zeros(len(merged), np.int64)
    np.add.at(total, at, own)
    others = np.split(total[at] - own, np.cumsum([len(k) for k in keys])[:-1])
    kept = [i for i, o in enumerate(others) if o.any()]
    of_kept = {c: table.column(c).take(pa.array(kept, pa.int64())) for c in ("block", "mark", "bucket")}
    return pa.table({**of_kept,
                     "others": pa.array([_counts(others[i]) for i in kept], pa.binary())})


def _texts(docs: DataFrame, block_bytes: int) -> DataFrame:
    """``block, rows``: the documents of each block as compressed Arrow data."""
    def packed(batches):
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=7))
        for block, held in _blocks(batches, block_bytes):
            for lo in range(0, len(held), 16):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, held[0].schema, options=options) as out:
                    for part in held[lo:lo + 16]:
                        out.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "rows"])

    return docs.mapInArrow(packed, "block long, rows binary")


def _scored(texts: pa.Table, others: pa.Table, bits: int) -> pa.Table:
    held = [b for x in texts.column("rows") for b in pa.ipc.open_stream(x.as_buffer())]
    words = _Words([h.column("text") for h in held])
    if others.num_rows and set(others.column("mark").to_pylist()) != {words.mark()}:
        raise RuntimeError("two scans of the documents gave different blocks; write the documents before scoring them")
    known = {b: x.as_buffer() for b, x in zip(others.column("bucket").to_pylist(), others.column("others"))}
    n = len(words.words)
    # by order, of the n-gram that ends at each word, without its document's own
    counts = [np.zeros(n, np.int64) for _ in range(ORDER)]
    used = np.zeros(n, np.int8)
    for k in range(1, ORDER + 1):
        ends, keys = words.ends(k), words.grams(k)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        ends = ends[order]
        new = np.append(True, keys[1:] != keys[:-1])[:len(keys)]
        first = np.flatnonzero(new)
        edges = _edges(keys[first], bits)
        del keys, order
        number = np.diff(np.append(first, len(new)))
        total = number.copy()
        for b in np.flatnonzero(np.diff(edges)).tolist():
            if (found := known.get((k - 1 << bits) + b)) is not None:
                total[edges[b]:edges[b + 1]] += _uncounted(found)
        document = words.document[ends]
        new[1:] |= document[1:] != document[:-1]
        run = np.flatnonzero(new)
        own = np.diff(np.append(run, len(new)))
        counts[k - 1][ends] = np.repeat(total, number) - np.repeat(own, own)
        used[counts[k - 1] > 0] = k
    missed = np.minimum(words.before + 1, ORDER) - used
    score = np.zeros(n, np.int64)
    for k in range(2, ORDER + 1):
        at = np.flatnonzero(used == k)
        score[at] = _micro(BACKOFF ** missed[at].astype(np.float64) * (counts[k - 1][at] / counts[k - 2][at - 1]))
    low = np.flatnonzero(used < 2)
    score[low] = _micro(BACKOFF ** missed[low].astype(np.float64) * np.where(used[low] == 1, counts[0][low], 1))
    sums = [np.bincount(words.document, x, len(words.sizes)).astype(np.int64) for x in (score, *(used == k for k in range(ORDER, -1, -1)))]
    return pa.table([pa.concat_arrays([h.column("doc_id") for h in held]), pa.array(words.sizes), *map(pa.array, sums)],
                    names=["doc_id", "n_words", "micro", "n_trigrams", "n_bigrams", "n_unigrams", "n_unknown"])


def backoff_scores(docs: DataFrame, block_bytes: int = 12 << 20) -> DataFrame:
    """``doc_id, n_words, n_trigrams, n_bigrams, n_unigrams, n_unknown`` (the
    words scored at each order), ``score_micro`` (the sum of the logarithms in
    millionths) and ``score`` (their mean a word)."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if "Exchange" in texts._jdf.queryExecution().executedPlan().toString():
        texts = materialize(texts, "scored-texts")
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    entries = max(1.0, n_bytes * WORDS_A_BYTE * ORDER / 2 / BUCKET_ENTRIES)
    bits = max(0, int(np.ceil(np.log2(entries))))
    totals = _tables(texts, bits, block_bytes).groupBy("bucket").applyInArrow(_totals, "block long, mark long, bucket long, others binary")

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        return _scored(left, right, bits)

    found = materialize(_texts(texts, block_bytes).groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        scored, "doc_id long, n_words long, micro long, n_trigrams long, n_bigrams long, n_unigrams long, n_unknown long"), "backoff-sums")
    n = found.agg(F.sum("n_words")).first()[0] or 0
    rest = F.rint(1e6 * F.log(F.greatest(F.lit(n) - F.col("n_words"), F.lit(1)).cast("double"))).cast("long")
    micro = F.col("micro") - (F.col("n_unigrams") + F.col("n_unknown")) * rest
    return found.select("doc_id", "n_words", "n_trigrams", "n_bigrams", "n_unigrams", "n_unknown", micro.alias("score_micro"),
                        F.when(F.col("n_words") > 0, micro.cast("double") / (F.col("n_words") * 1e6)).otherwise(0.0).alias("score"))
