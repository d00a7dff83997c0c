"""Sentence-piece BPE encoding and decoding of whole texts by backtracking.

The library merges neighbouring symbols, best score first.  The same ids come
from left to right: a sequence of pieces is the merged one exactly if every
two neighbours are, that is if merging their joined characters gives those two
again.  At each place the longest piece that fits the text is tried, then the
shorter pieces that begin it; a piece is taken if it is compatible with the
one before.  If none is, the piece before is taken back and its end marked in
a bit field: there is one sequence for each beginning of a text, so a place
that failed once fails always.

The longest pieces at all places come from one pass of an Aho-Corasick
automaton of the pieces.  Texts are cut into pre-tokens where no piece of the
vocabulary reaches across, and each distinct pre-token is encoded once in a
while.  Characters outside the vocabulary become byte pieces.  Decoding
concatenates the vocabulary strings (byte pieces as bytes, control pieces as
nothing) without the blank that encoding puts in front.

Defined results: a null text counts as empty; an empty text has the end id
only and decodes to the empty text; blanks, runs of blanks and the blank mark
itself are kept as the library keeps them; rows are independent, so repeated
rows repeat their results; an empty table gives no rows; columns other than
``doc_id`` and ``text`` (or ``ids``) are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from kiln.llm.memo import Memo, slices
from kiln.llm.token_counts import PATTERNS, SPACE

#: Places whose longest pieces are found at a time, and pairs of pieces whose
#: compatibility is remembered.
PLACES, PAIRS = 1 << 16, 1 << 20


class Vocabulary(NamedTuple):
    """What tasks need of a model file; of the vocabulary's size."""

    scores: dict[str, float]
    ids: dict[str, int]
    #: by id: a piece's characters, a byte piece's byte, nothing for control pieces
    strings: list[bytes]
    byte_ids: list[int]
    end_id: int
    unknown_id: int


def read_vocabulary(path: str) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    scores, ids, strings, byte_ids = {}, {}, [], [model.unk_id()] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte = int(piece[3:-1], 16)
            byte_ids[byte] = i
            strings.append(bytes([byte]))
        elif model.is_control(i):
            strings.append(b"")
        elif model.is_unknown(i):
            strings.append(" ⁇ ".encode())
        else:
            strings.append(piece.replace(SPACE, " ").encode())
            if not model.is_unused(i):
                scores[piece], ids[piece] = model.get_score(i), i
    return Vocabulary(scores, ids, strings, byte_ids, model.eos_id(), model.unk_id())


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """The pieces that merging leaves of a text's characters: highest score
    first, leftmost on ties."""
    symbols = list(text)
    following, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
    queue: list[tuple[float, int, str]] = []

    def offer(i: int, j: int) -> None:
        if (joined := symbols[i] + symbols[j]) in scores:
            heapq.heappush(queue, (-scores[joined], i, joined))

    for i in range(len(symbols) - 1):
        offer(i, i + 1)
    while queue:
        _, i, joined = heapq.heappop(queue)
        j = following[i]
        if not symbols[i] or j == len(symbols) or symbols[i] + symbols[j] != joined:
            continue
        symbols[i], symbols[j] = joined, ""
        following[i] = following[j]
        if following[i] < len(symbols):
            before[following[i]] = i
            offer(i, following[i])
        if before[i] >= 0:
            offer(before[i], i)
    return [s for s in symbols if s]


class PieceCoder:
    """Encoder and decoder of one vocabulary.  Inside, a piece is a number
    into the lists below; -1 is a character that no piece has."""

    def __init__(self, vocabulary: Vocabulary):
        self._vocabulary = v = vocabulary
        self._pattern = next(p for p in map(re.compile, PATTERNS) if all(p.findall(s) == [s] for s in v.scores))
        # a piece that merging does not reach by itself is in no result
        reached = [s for s in v.scores if len(s) == 1 or merged(s, v.scores) == [s]]
        # characters of pieces that are none themselves stand for their bytes
        self._pieces = reached + sorted({c for s in v.scores for c in s} - set(reached))
        self._ids = [(v.ids[s],) if s in v.ids else self._bytes(s) for s in self._pieces]
        self._widths = list(map(len, self._pieces))
        self._widest = max(self._widths, default=1)
        number = {s: i for i, s in enumerate(self._pieces)}
        #: the next shorter piece that begins a piece
        self._shorter = [next((number[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in number), -1) for s in self._pieces]
        self._automaton = ahocorasick.Automaton()
        for s, i in number.items():
            self._automaton.add_word(s, (len(s) - 1, i))
        self._automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        self._memo = Memo(self._pre_token)

    def _bytes(self, character: str) -> tuple[int, ...]:
        return tuple(self._vocabulary.byte_ids[b] for b in character.encode())

    def _longest(self, text: str) -> list[int]:
        """The longest piece at each place.  The automaton reports matches by
        their ends, so of one place the longest comes last."""
        found = [-1] * len(text)
        for end, (before, piece) in self._automaton.iter(text):
            found[end - before] = piece
        return found

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the characters of both leaves the two."""
        key = left * len(self._pieces) + right
        if (known := self._pairs.get(key)) is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            a, b = self._pieces[left], self._pieces[right]
            known = self._pairs[key] = merged(a + b, self._vocabulary.scores) == [a, b]
        return known

    def _pre_token(self, text: str) -> tuple[int, ...]:
        n, at, first = len(text), 0, 0
        longest = self._longest(text[:PLACES + self._widest])
        widths, shorter, compatible = self._widths, self._shorter, self._compatible
        if longest[0] >= 0 and widths[longest[0]] == n:
            return self._ids[longest[0]]
        taken: list[int] = []
        failed = bytearray(n // 8 + 1)
        piece, open_ = longest[0], True  # a piece to try, if any
        while at < n:
            while open_ and piece >= 0:
                end = at + widths[piece]
                if not failed[end >> 3] >> (end & 7) & 1 and (not taken or taken[-1] < 0 or compatible(taken[-1], piece)):
                    break
                piece = shorter[piece]
                open_ = piece >= 0
            if open_:
                taken.append(piece)
                at += widths[piece] if piece >= 0 else 1
                if at < n:
                    if not first <= at < first + PLACES:
                        first = max(0, at - PLACES // 2)  # going back a little needs no new pass
                        longest = self._longest(text[first:first + PLACES + self._widest])
                    piece = longest[at - first]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                back = taken.pop()
                at -= widths[back] if back >= 0 else 1
                piece = shorter[back] if back >= 0 else -1
                open_ = piece >= 0
        if -1 not in taken:
            return tuple(chain.from_iterable(map(self._ids.__getitem__, taken)))
        ids: list[int] = []
        at = 0
        for piece in taken:
            ids += self._ids[piece] if piece >= 0 else self._bytes(text[at])
            at += widths[piece] if piece >= 0 else 1
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        """The ids of a text, the end id last."""
        ids: list[int] = []
        for n, part in enumerate(slices(text) if text else ()):
            marked = part.replace(" ", SPACE) if n else SPACE + part.replace(" ", SPACE)
            ids += chain.from_iterable(map(self._memo.__getitem__, self._pattern.findall(marked)))
        ids.append(self._vocabulary.end_id)
        return ids

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self._vocabulary.strings.__getitem__, ids)).decode("utf-8", "replace")
        begins = next((s for s in map(self._vocabulary.strings.__getitem__, ids) if s), b"")
        return text[1:] if begins[:1] == b" " and begins != self._vocabulary.strings[self._vocabulary.unknown_id] else text


_open: dict[str, PieceCoder] = {}


def _coder(path: str, shared: Broadcast) -> PieceCoder:
    """The coder of a model, once a Python worker."""
    if path not in _open:
        _open[path] = PieceCoder(shared.value)
    return _open[path]


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, same`` of each row;
    ``same`` tells whether decoding gave the text back."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, shared)
        decimal = [str(i) for i in range(len(shared.value.strings))]
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                counts, ids_sha, text_sha, same = [], [], [], []
                for text in part.column("text").to_pylist():
                    text = text or ""
                    ids = coder.encode(text)
                    decoded = coder.decode(ids)
                    counts.append(len(ids))
                    ids_sha.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                    same.append(decoded == text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same"])

    return docs.select("doc_id", "text").mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean")


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids array<int>`` of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, shared)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                found = [coder.encode(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(ids, "doc_id long, ids array<int>")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids decode to the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, shared)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                found = [coder.decode(i or []) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, text string")
