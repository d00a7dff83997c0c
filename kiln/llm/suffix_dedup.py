"""Repeated passages across a collection, found column by column.

A window is any ``length`` bytes of a text; a byte goes if a window that
covers it also starts anywhere else.  Matches are exact and are judged on the
input.

The collection's suffixes are sorted as in a column-wise multi-document
construction: each round inserts one symbol of every string, the order of the
suffixes of the column before is refined by the new symbols (which are that
column's Burrows-Wheeler transform), and the common prefixes are carried
along; a window is repeated if its suffix shares ``length`` symbols with a
neighbour.  Three things make that fit a cluster:

* A round a byte would be as many rounds as the longest text has bytes.  So
  texts are cut at anchors: the anchor of a window is its least gram of
  ``GRAM`` bytes by a hash, the leftmost on ties.  Neighbouring windows with
  one anchor make a segment, of bounded length.  Equal windows have equal
  anchors at equal places, so only segments of the same gram need to meet,
  and no window repeats within a segment.
* As equal windows lie at the same distance from their anchor, strings are
  aligned at it and only suffixes of the same column are ever compared: the
  transform is kept a column at a time and a round costs as much as there are
  strings, not as there are symbols so far.  Files written and read in
  sequence are Spark's own: the table of segments and the shuffles.
* Segments of a gram that occurs once go at once, and equal segments are one
  string with a count.  Only strings that differ but share a gram are read
  from the texts and sorted.  Where more than ``MANY`` different strings share
  a gram, their windows are grouped by digest instead, so that no gram, line
  or passage, however common, is held by one task.

Defined results: a null text counts as empty; texts shorter than ``length``
bytes are left alone; repeated rows are repeats of each other; a null
``doc_id`` is carried along; an empty table gives no rows; other columns are
neither read nor returned by ``repeated_spans`` and are carried through
unchanged by ``cut_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from kiln.llm.memo import tidied
from kiln.llm.rows import TEXTS_A_BATCH
from kiln.llm.shingles import _BASE, _BYTE, byte_chunks, mix
from kiln.session import materialize, rows_a_batch

GRAM = 48
MANY = 4096
#: Bytes of strings sorted together.
COLLECTION_BYTES = 8 << 20
_INVERSE = np.uint64(pow(int(_BASE), -1, 2 ** 64))
_PLACES = np.uint64((1 << 22) - 1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Segmenter:
    """Cuts texts into segments; powers are kept for the next chunk."""

    def __init__(self, length: int, gram: int = GRAM):
        self._length, self._gram = length, min(gram, length)
        self._up = self._down = np.ones(1, np.uint64)

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...] | None:
        """For each segment its text (index), first window, windows, distance
        of the anchor from its first byte, gram and content hashes."""
        n, length, gram = len(data), self._length, self._gram
        if n < length:
            return None
        if len(self._up) <= n:
            self._up, self._down = _powers(_BASE, 2 * n), _powers(_INVERSE, 2 * n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * self._up[:n], out=sums[1:])
        grams = mix((sums[gram:] - sums[:-gram]) * self._down[:n - gram + 1])
        least = (grams & ~_PLACES) | np.arange(len(grams), dtype=np.uint64)
        span, wide = 1, length - gram + 1
        while 2 * span <= wide:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < wide:
            least = np.minimum(least[:len(least) - (wide - span)], least[wide - span:])
        anchor = (least & _PLACES).astype(np.int64)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        window = np.flatnonzero(text[:n - length + 1] == text[length - 1:])
        if not len(window):
            return None
        anchor, text = anchor[window], text[window]
        first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1) | (text[1:] != text[:-1]))))
        begin, count = window[first], np.diff(np.append(first, len(window)))
        content = mix((sums[begin + count + length - 1] - sums[begin]) * self._down[begin] + count.astype(np.uint64) * _BASE)
        return text[first], begin - offsets[text[first]], count, anchor[first] - begin, grams[anchor[first]], content

    def of(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
        """As ``cut`` for a batch, with the row in place of the text.  A very
        long text is cut in overlapping parts: each window lies in one."""
        limit = 1 << 20
        for row, data, offsets in byte_chunks(texts, limit):
            if len(offsets) == 2 and len(data) > limit:
                for lo in range(0, len(data) - self._length + 1, limit):
                    part = data[lo:lo + limit + self._length - 1]
                    if found := self.cut(part, np.array([0, len(part)])):
                        yield found[0] + row, found[1] + lo, *found[2:]
            elif found := self.cut(data, offsets):
                yield found[0] + row, *found[1:]


def _segments(texts: DataFrame, length: int) -> DataFrame:
    @tidied
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = _Segmenter(length)
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for at, start, windows, before, gram, content in segmenter.of(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[at]), *(pa.array(x.astype(np.int32)) for x in (start, windows, before)), *(pa.array(x.view(np.int64)) for x in (gram, content))],
                    ["row", "start", "windows", "before", "gram", "content"])

    return texts.mapInArrow(cut, "row long, start int, windows int, before int, gram long, content long")


def shared_windows(strings: list[bytes], before: np.ndarray, length: int) -> list[np.ndarray]:
    """For each string the places whose window of ``length`` bytes another
    string has at the same distance from its anchor (``before``)."""
    m = len(strings)
    sizes = np.array([len(s) for s in strings])
    data = np.frombuffer(b"".join(strings), np.uint8)
    base = np.concatenate(([0], np.cumsum(sizes)[:-1])) + before  # of the anchor
    left, right = -before, sizes - before  # columns of each string
    entering = np.argsort(-right, kind="stable")
    entered = 0
    order, common = np.zeros(0, np.int64), np.zeros(0, np.int64)
    found: list[tuple[np.ndarray, int]] = []
    for column in range(int(right.max()) - 1, int(left.min()) - 1, -1):
        # strings that end here come in as empty suffixes, in front
        upto = entered
        while upto < m and right[entering[upto]] > column:
            upto += 1
        if upto > entered:
            order = np.concatenate((entering[entered:upto], order))
            common = np.concatenate((np.zeros(upto - entered, np.int64), common))
            entered = upto
        live = left[order] <= column
        if not live.all():
            # a string that begins later leaves; its neighbours share what both shared with it
            kept = np.flatnonzero(live)
            if not len(kept):
                order, common = order[:0], common[:0]
                continue
            common = np.minimum.reduceat(common[:kept[-1] + 1], np.concatenate(([0], kept[:-1] + 1)))
            order = order[kept]
        symbols = data[base[order] + column]
        new = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[new]
        same = np.concatenate(([False], sorted_symbols[1:] == sorted_symbols[:-1]))
        shared = np.zeros(len(new), np.int64)
        if same.any():
            at = np.flatnonzero(same)
            # one more than the least common prefix between the two in the order before
            ends = np.stack((new[at - 1] + 1, new[at] + 1), 1).reshape(-1)
            shared[at] = 1 + np.minimum.reduceat(np.append(common, 0), ends)[::2]
        order, common = order[new], shared
        long_ = common >= length
        if long_.any():
            hit = long_.copy()
            hit[:-1] |= long_[1:]
            found.append((order[hit], column))
    if not found:
        return [np.zeros(0, np.int64)] * m
    who = np.concatenate([f[0] for f in found])
    where = np.concatenate([np.full(len(f[0]), f[1]) for f in found]) + before[who]
    by = np.lexsort((where, who))
    return np.split(where[by], np.searchsorted(who[by], np.arange(1, m)))


def _runs(places: np.ndarray) -> list[tuple[int, int]]:
    """(first, number) of runs of consecutive places."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) != 1)
    begins, ends = places[np.append(0, cut + 1)], places[np.append(cut, len(places) - 1)]
    return [(int(b), int(e - b + 1)) for b, e in zip(begins, ends)]


_VERDICT = "gram long, content long, marks array<struct<first:int,number:int>>"


def _sorted_columns(strings: DataFrame, length: int) -> DataFrame:
    """Marks of the strings that occur once, from collections of whole grams."""
    @tidied
    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            runs = shared_windows([h[4] for h in held], np.array([h[3] for h in held]), length)
            rows = [(h[0], h[1], _runs(places)) for h, places in zip(held, runs) if h[2] == 1 and len(places)]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([[{"first": f, "number": n} for f, n in r[2]] for r in rows], pa.list_(pa.struct([("first", pa.int32()), ("number", pa.int32())])))],
                ["gram", "content", "marks"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "content", "copies", "before", "bytes"))):
                if size > COLLECTION_BYTES and row[0] != held[-1][0]:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield flush()

    return strings.repartition("gram").sortWithinPartitions("gram").mapInArrow(marked, _VERDICT)


def _by_digest(strings: DataFrame, length: int) -> DataFrame:
    """The same marks for strings of very common grams, window by window."""
    window = strings.select("gram", "content", "copies", "before", "bytes", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("first"))
    window = window.select("gram", "content", "copies", "first", (F.col("before") - F.col("first")).alias("place"),
                           F.md5(F.substring("bytes", F.col("first") + 1, F.lit(length))).alias("digest"))
    shared = window.groupBy("gram", "place", "digest").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    found = window.filter("copies = 1").join(shared, ["gram", "place", "digest"], "left_semi")
    return found.select("gram", "content", F.array(F.struct("first", F.lit(1).alias("number"))).alias("marks"))


def _verdicts(texts: DataFrame, segments: DataFrame, length: int, many: int) -> DataFrame:
    """``gram, content, marks``: the repeated windows of each distinct string."""
    strings = segments.groupBy("gram", "content").agg(F.count("*").alias("copies"), F.min(F.struct("row", "start", "windows", "before")).alias("at"))
    per_gram = strings.groupBy("gram").agg(F.count("*").alias("strings")).filter("strings > 1")
    wanted = strings.join(per_gram, "gram").select("at.*", "gram", "content", "copies", "strings")
    wanted = wanted.groupBy("row").agg(F.collect_list(F.struct("start", "windows", "before", "gram", "content", "copies", "strings")).alias("wanted"))

    @tidied
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["windows", "before", "gram", "content", "copies", "strings"]
        kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4]
        for batch in batches:
            out = []
            for text, wanted_here in zip(batch.column("text"), batch.column("wanted").to_pylist()):
                data = text.as_buffer()
                out += [(*(w[c] for c in names), data.slice(w["start"], w["windows"] + length - 1).to_pybytes()) for w in wanted_here]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), [*kinds, pa.binary()])], [*names, "bytes"])

    # ``doc`` comes along unread, so that this exchange is the one that is used again
    bytes_ = texts.join(wanted, "row").select("text", "wanted", "doc").mapInArrow(
        read, "windows int, before int, gram long, content long, copies long, strings long, bytes binary")
    whole = strings.filter("copies > 1").select("gram", "content", F.array(F.struct(F.lit(0).alias("first"), F.col("at.windows").alias("number"))).alias("marks"))
    return (whole.unionByName(_sorted_columns(bytes_.filter(f"strings <= {many}"), length))
            .unionByName(_by_digest(bytes_.filter(f"strings > {many}"), length)))


def merged(spans: list, length: int) -> list[tuple[int, int]]:
    """(begin, end) of the maximal runs of bytes that windows cover, from
    (first window, number of windows)."""
    out: list[list[int]] = []
    for first, number in sorted((s["first"], s["number"]) for s in spans):
        end = first + number + length - 1
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [(b, e) for b, e in out]


def _with_spans(docs: DataFrame, length: int, many: int, carry: dict[str, Column]) -> DataFrame:
    """``text`` (bytes), ``doc`` (a struct of ``carry``) and ``spans``, null if
    nothing is repeated."""
    # written with their numbers: a second scan may be split otherwise and number the rows anew
    texts = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce("text", F.lit("")).cast("binary").alias("text"),
                                    F.struct(*[c.alias(name) for name, c in carry.items()]).alias("doc")), "numbered-texts")
    cut = _segments(texts.select("row", "text"), length)
    # written, so that the join below has two plain exchanges and Spark can
    # split the partition of a gram that a third of all segments have
    with rows_a_batch(docs.sparkSession, TEXTS_A_BATCH):
        repeated = materialize(cut.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "repeated-grams")
        segments = materialize(cut.hint("merge").join(repeated, "gram"), "repeated-segments")
    # one exchange of the texts by row serves both joins; an inner join asks
    # for rows that are not null, so both get that filter here
    by_row = texts.filter("row IS NOT NULL").repartition("row")
    spans = segments.join(_verdicts(by_row, segments, length, many), ["gram", "content"]).select("row", "start", F.explode("marks").alias("mark"))
    spans = spans.groupBy("row").agg(F.collect_list(F.struct((F.col("start") + F.col("mark.first")).alias("first"), F.col("mark.number").alias("number"))).alias("spans"))
    return by_row.join(spans, "row", "left").select("text", "doc", "spans")


def repeated_spans(docs: DataFrame, length: int = 200, many: int = MANY) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row: the maximal runs of
    removed bytes as ``struct<begin,end>`` and the remaining bytes."""
    return _finished(docs, length, many, {"doc_id": F.col("doc_id")}, "spans").select("doc.doc_id", "n_bytes", "spans", "kept")


def repeat_digests(docs: DataFrame, length: int = 200, many: int = MANY) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    found = _finished(docs, length, many, {"doc_id": F.col("doc_id")}, "digests")
    return found.select("doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


_KINDS = {"spans": "n_bytes long, spans array<struct<begin:long,end:long>>, kept binary",
          "digests": "n_bytes long, n_removed long, n_spans long, kept_sha256 string",
          "texts": "n_spans int, left string"}


def _finished(docs: DataFrame, length: int, many: int, carry: dict[str, Column], want: str) -> DataFrame:
    """``doc`` and the columns of ``_KINDS[want]``, from one pass through Python:
    two in a row would keep two workers a task."""
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    @tidied
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, runs, kept = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                cut = merged(spans or [], length)
                left = b"".join(text[b:e] for b, e in zip([0, *(e for _, e in cut)], [*(b for b, _ in cut), len(text)]))
                sizes.append(len(text))
                runs.append(cut)
                kept.append(hashlib.sha256(left).hexdigest() if want == "digests" else left.decode("utf-8", "ignore") if want == "texts" else left)
            doc, n_bytes = batch.column("doc"), pa.array(sizes, pa.int64())
            if want == "digests":
                yield pa.RecordBatch.from_arrays(
                    [doc, n_bytes, pa.array([sum(e - b for b, e in r) for r in runs], pa.int64()), pa.array([len(r) for r in runs], pa.int64()), pa.array(kept, pa.string())],
                    ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
            elif want == "texts":
                yield pa.RecordBatch.from_arrays([doc, pa.array([len(r) for r in runs], pa.int32()), pa.array(kept, pa.string())], ["doc", "n_spans", "left"])
            else:
                yield pa.RecordBatch.from_arrays([doc, n_bytes, pa.array([[{"begin": b, "end": e} for b, e in r] for r in runs], span), pa.array(kept, pa.binary())],
                                                 ["doc", "n_bytes", "spans", "kept"])

    given = _with_spans(docs, length, many, carry)
    return given.mapInArrow(finish, StructType([given.schema["doc"], *StructType.fromDDL(_KINDS[want]).fields]))


def cut_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; of a character
    that loses only some of its bytes the others go too.  ``n_chars``, where
    there is one, follows the text.  A null text stays null."""
    others = {f"c{i}": docs[c] for i, c in enumerate(docs.columns) if c != "text"}
    left = _finished(docs, length, MANY, {"none": docs["text"].isNull(), **others}, "texts")
    out = []
    for i, c in enumerate(docs.columns):
        value = F.col(f"doc.c{i}")
        if c == "text":
            value = F.when(~F.col("doc.none"), F.col("left"))
        elif c == "n_chars":
            value = F.when(F.col("n_spans") > 0, F.char_length("left")).otherwise(value)
        out.append(value.cast(docs.schema[c].dataType).alias(c))
    return left.select(*out)
