"""Vector best-fit packing of documents into token sequences.

A document becomes its ids and a closing id; longer ones are cut into pieces
of the token capacity.  A bin has three capacities: tokens, documents (one a
piece) and attention cost (the sum of squared piece lengths).  Pieces are
placed in falling order of length, each into the open bin that can take it
under every capacity and scores best: the least weighted dot product of the
piece's demand with the bin's residual (``rule="dot"``), or the least
weighted norm of the residual that it would leave (``rule="norm"``).  A
resource weighs as much as the corpus asks of it.

A piece's three demands all follow from its length, so pieces of one length
are interchangeable and the plan is made on the histogram of lengths, which
has at most ``max_tokens`` rows whatever the corpus: bins in the same state
are ranges of sequence numbers and are filled together.  Spark then numbers
the pieces of each length (a count in each partition, running sums over the
partitions; a length that a third of all pieces have is spread over all
partitions) and each piece finds its range in the plan.

Defined results: a null text counts as empty and gives the closing id alone;
repeated rows are packed each; an empty table gives no rows; columns other
than ``doc_id`` and ``text`` are neither read nor returned.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from kiln.llm.bpe import byte_alphabet
from kiln.llm.memo import Memo, slices, tidy
from kiln.llm.rows import TEXTS_A_BATCH
from kiln.session import materialize, rows_a_batch

#: The published pre-token pattern of the word vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
_LATIN = "a-zA-Zªµºß-öø-ÿÀ-ÖØ-Þ"
#: The same pattern where all characters are Latin-1; several times as fast.
_LATIN_PATTERN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0{_LATIN}0-9²³¹¼½¾]+")
_FAR = re.compile("[\u0370-\U0010ffff]")


@dataclass(frozen=True)
class Capacity:
    """What one sequence can hold; None: no limit of its own."""

    tokens: int = 4096
    documents: int | None = None
    cost: int | None = None

    @property
    def of_bin(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.cost or self.tokens ** 2], np.int64)

    @property
    def piece(self) -> int:
        """The longest piece that fits an empty bin."""
        return max(1, min(self.tokens, math.isqrt(self.cost or self.tokens ** 2)))


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit integers.  Texts are
    normalised and cut into pre-tokens here; the tokenizers library's model
    merges each distinct pre-token once in a while, and the library encodes
    whole texts with characters unknown to this Python's Unicode tables."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_str(vocabulary)
        self._specials = {t["content"]: np.uint32(t["id"]).tobytes() for t in json.loads(vocabulary)["added_tokens"]}
        self._split = regex.compile("(" + "|".join(map(regex.escape, self._specials)) + ")")
        self._words, self._unsure = regex.compile(PATTERN), re.compile(unassigned())
        alphabet, model = byte_alphabet(), self._whole.model

        def merged(word: str) -> bytes:
            symbols = word if word.isascii() and word.isalnum() else "".join(alphabet[b] for b in word.encode())
            return array("I", [t.id for t in model.tokenize(symbols)]).tobytes()

        self._memo = Memo(merged, limit=100_000)

    def _pre_tokens(self, part: str) -> list[str]:
        if part.isascii():
            return _LATIN_PATTERN.findall(part)
        try:
            part.encode("latin-1")
        except UnicodeEncodeError:
            return self._words.findall(part)
        return _LATIN_PATTERN.findall(part)

    def encode(self, text: str) -> bytes:
        if not text.isascii() and _FAR.search(text) and self._unsure.search(text):
            return array("I", self._whole.encode(text, add_special_tokens=False).ids).tobytes()
        found = []
        for part in self._split.split(text):
            if part in self._specials:
                found.append(self._specials[part])
                continue
            if not part.isascii():
                # lower-casing is by character: no final sigma
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            for piece in slices(part.lower()):
                found += map(self._memo.__getitem__, self._pre_tokens(piece))
        return b"".join(found)


def unassigned() -> str:
    """A character class of the code points without a category here: the
    library's tables may be newer."""
    ranges, begin = [], None
    for c in range(0x370, 0x110001):
        free = c < 0x110000 and unicodedata.category(chr(c)) == "Cn"
        if free and begin is None:
            begin = c
        elif not free and begin is not None:
            ranges.append(f"\\U{begin:08x}-\\U{c - 1:08x}")
            begin = None
    return "[" + "".join(ranges) + "]"


_open: dict[str, WordEncoder] = {}


def pieces(docs: DataFrame, path: str, piece_tokens: int, end_id: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, for the numbering,
    ``part`` and ``place``: the how-manieth of its length in its partition."""
    with open(path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.uint32(end_id).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        if path not in _open:
            _open[path] = WordEncoder(vocabulary.value)
        encoder, part, seen = _open[path], TaskContext.get().partitionId(), np.zeros(piece_tokens + 1, np.int64)
        try:
            for batch in batches:
                for lo in range(0, batch.num_rows, 256):
                    rows = batch.slice(lo, 256)
                    out = []
                    for at, text in enumerate(rows.column("text").to_pylist()):
                        ids = encoder.encode(text or "") + end
                        for k, begin in enumerate(range(0, len(ids), 4 * piece_tokens)):
                            own = ids[begin:begin + 4 * piece_tokens]
                            length = len(own) // 4
                            out.append((at, k, begin // 4, length, zlib.crc32(own), seen[length]))
                            seen[length] += 1
                    at, k, start, length, crc, place = (np.array(x, np.int64) for x in zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("doc_id").take(pa.array(at)), pa.array(k.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc), pa.array(np.full(len(at), part)), pa.array(place)],
                        ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"])
        finally:
            _open.clear()
            encoder = None
            tidy()

    return docs.select("doc_id", "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, part long, place long")


def best_fit(histogram: dict[int, int], capacity: Capacity, rule: str = "dot") -> np.ndarray:
    """The plan: rows (length, first, after, bin, each, offset).  The pieces
    first..after-1 of a length go ``each`` to a bin, from bin ``bin`` on, the
    first of a bin at ``offset``."""
    if rule not in ("dot", "norm"):
        raise ValueError(f"rule must be 'dot' or 'norm', not {rule!r}")
    full = capacity.of_bin
    lengths = np.array(sorted(histogram, reverse=True), np.int64)
    counts = np.array([histogram[n] for n in lengths], np.float64)
    demands = np.stack([lengths, np.ones_like(lengths), lengths ** 2], 1)
    weight = (demands / full * counts[:, None]).sum(0)
    weight /= max(weight.sum(), 1e-300)
    residual, first, number = np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    plan, bins = [], 0

    def fill(room: np.ndarray, at: int, n: int, demand: np.ndarray, done: int, left: int) -> tuple[int, int]:
        """Fills up to ``n`` bins of a state; (bins, pieces in each)."""
        each = min(int((room // demand).min()), left)
        used = min(n, left // each)
        plan.append((demand[0], done, done + used * each, at, each, full[0] - room[0]))
        return used, each

    for demand in demands:
        left, done = histogram[int(demand[0])], 0
        live = residual[:, 0] >= lengths[-1]
        residual, first, number = residual[live], first[live], number[live]
        while left:
            fits = np.flatnonzero((residual >= demand).all(1))
            if not len(fits):
                each = min(int((full // demand).min()), left)
                wanted = -(-left // each)
                residual, first, number = np.vstack([residual, full]), np.append(first, bins), np.append(number, wanted)
                bins += wanted
                continue
            rest, need = residual[fits] / full, demand / full
            score = (rest * (need * weight)).sum(1) if rule == "dot" else ((rest - need) ** 2 * weight).sum(1)
            g = fits[np.argmin(score)]
            used, each = fill(residual[g], first[g], int(number[g]), demand, done, left)
            state = residual[g] - each * demand
            if used < number[g]:
                first[g] += used
                number[g] -= used
                residual, first, number = np.vstack([residual, state]), np.append(first, plan[-1][3]), np.append(number, used)
            else:
                residual[g] = state
            left -= used * each
            done += used * each
    return np.array(plan, np.int64).reshape(-1, 6)


def pack(docs: DataFrame, path: str, capacity: Capacity = Capacity(), end_id: int = 1, rule: str = "dot") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of
    every piece; a sequence's pieces lie at gapless offsets from 0."""
    with rows_a_batch(docs.sparkSession, TEXTS_A_BATCH):
        cut = materialize(pieces(docs, path, capacity.piece, end_id), "pieces")
    spread = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = spread.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    histogram = {r["length"]: r["n"] for r in spread.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row a length
    plan = best_fit(histogram, capacity, rule)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    ranges = docs.sparkSession.sparkContext.broadcast(plan)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, begin, _, at, each, offset = ranges.value.T
        for batch in batches:
            own, i = (batch.column(c).to_numpy() for c in ("length", "number"))
            # the last range of the piece's length that begins at or before it
            lo, hi = np.searchsorted(length, own, "left"), np.searchsorted(length, own, "right")
            while (open_ := hi - lo > 1).any():
                mid = (lo + hi) // 2
                right = open_ & (begin[np.minimum(mid, len(begin) - 1)] <= i)
                lo, hi = np.where(right, mid, lo), np.where(open_ & ~right, mid, hi)
            inside = i - begin[lo]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(at[lo] + inside // each[lo]), pa.array(offset[lo] + inside % each[lo] * own)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return (cut.join(before, ["length", "part"])
            .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("number"))
            .mapInArrow(placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))
