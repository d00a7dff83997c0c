"""Byte-pair encoding and decoding of whole texts.

The vocabulary file is given by its path (``tokenizers`` JSON, byte-level
BPE) and read on the driver; its vocabulary and merges, of fixed size, reach
the tasks as a broadcast.  A text is split at its special strings and by the
pre-token pattern.  Each distinct pre-token is merged once in a while: a
priority queue of (merge rank, position) over a doubly linked list of
symbols; an entry whose symbols have changed since is stale and skipped.
Decoding concatenates the bytes of the vocabulary strings and reads them as
UTF-8, invalid sequences becoming U+FFFD.

Defined results: a null text counts as empty; an empty text has no ids and
decodes to the empty text; rows are independent, so repeated rows repeat
their results; an empty table gives no rows; columns other than ``doc_id``
and ``text`` are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kiln.llm.memo import Memo, slices

#: The published pattern of this vocabulary's pre-tokens (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary:
    itself if printable Latin-1, else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


def merge(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merges neighbouring symbols, lowest rank first, leftmost on ties.
    ``ranks`` maps a pair to its rank and the merged symbol."""
    n = len(symbols)
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(*found, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (found := ranks.get((symbols[i], symbols[i + 1])))]
    heapq.heapify(queue)
    while queue:
        _, merged, i, left, right = heapq.heappop(queue)
        j = following[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # stale: one of the two has been merged since
        symbols[i], symbols[j] = merged, -1
        following[i] = k = following[j]
        if k < n:
            before[k] = i
            if found := ranks.get((merged, symbols[k])):
                heapq.heappush(queue, (*found, i, merged, symbols[k]))
        if (h := before[i]) >= 0 and (found := ranks.get((symbols[h], merged))):
            heapq.heappush(queue, (*found, h, symbols[h], merged))
    return [s for s in symbols if s >= 0]


class ByteBPE:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, file: dict):
        alphabet = byte_alphabet()
        back = {c: b for b, c in alphabet.items()}
        vocab = file["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in file["added_tokens"]}
        self._first = [vocab[alphabet[b]] for b in range(256)]
        self._ranks = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(file["model"]["merges"])}
        size = max(*vocab.values(), *self.specials.values()) + 1
        self.strings = [b""] * size
        for token, i in (vocab | self.specials).items():
            self.strings[i] = bytes(back[c] for c in token)
        self._pattern = regex.compile(PATTERN)
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self._memo = Memo(self._merged)

    def _merged(self, pre_token: str) -> tuple[int, ...]:
        return tuple(merge([self._first[b] for b in pre_token.encode()], self._ranks))

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self._special.split(text) if self._special else [text]:
            if part in self.specials:
                ids.append(self.specials[part])
            else:
                for piece in slices(part):
                    ids += chain.from_iterable(map(self._memo.__getitem__, self._pattern.findall(piece)))
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


_open: dict[str, ByteBPE] = {}


def opened(key: str, text: str) -> ByteBPE:
    """The coder of a vocabulary, once a Python worker."""
    if key not in _open:
        _open[key] = ByteBPE(json.loads(text))
    return _open[key]


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, same`` of each row;
    ``same`` tells whether decoding gave the text back."""
    with open(path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = opened(path, vocabulary.value)
        decimal = [str(i) for i in range(len(coder.strings))]
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                counts, ids_sha, text_sha, same = [], [], [], []
                for text in part.column("text").to_pylist():
                    text = text or ""
                    ids = coder.encode(text)
                    decoded = coder.decode(ids)
                    counts.append(len(ids))
                    ids_sha.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                    same.append(decoded == text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same"])

    return docs.select("doc_id", "text").mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean")


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids array<int>`` of each row."""
    with open(path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def ids(batches):
        coder = opened(path, vocabulary.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                found = [coder.encode(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(ids, "doc_id long, ids array<int>")


def decode_texts(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids decode to the empty text."""
    with open(path, encoding="utf-8") as f:
        vocabulary = encoded.sparkSession.sparkContext.broadcast(f.read())

    def texts(batches):
        coder = opened(path, vocabulary.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                found = [coder.decode(i or []) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, text string")
