"""Token counts of whole texts under a sentence-piece BPE model.

Nothing of the text is encoded that need not be.  Offline, on the driver and
from the vocabulary alone, two things are proved: between which neighbouring
characters no piece reaches, so that a text can be cut there into pre-tokens
that are merged apart from each other; and which vocabulary strings, as a
pre-token of their own, end up as one token.  A pre-token that is such a
string counts one by a look-up; only the rest is merged (highest score first,
leftmost on ties), each distinct one once in a while.  Characters outside the
vocabulary count one token a UTF-8 byte.

Defined results: a null text counts as empty, an empty text has no tokens;
rows are independent, so repeated rows repeat their counts; an empty table
gives no rows; columns other than ``doc_id`` and ``text`` are neither read
nor returned.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from kiln.llm.memo import Memo, slices

SPACE = "▁"
_LETTER = rf"[^{SPACE}\n\W\d_²³¹¼½¾]"
#: Pre-tokens, finest first.  In the first a cut lies before a run of spaces,
#: after a letter that no letter follows and around line ends; in the last
#: only before a run of spaces.
PATTERNS = (
    rf"{SPACE}*{_LETTER}+|{SPACE}*(?:(?!{_LETTER})[^{SPACE}\n])+{_LETTER}*|{SPACE}+|\n",
    rf"{SPACE}+[^{SPACE}]*|[^{SPACE}]+",
)


class PieceCounter:
    """``pieces`` maps each ordinary vocabulary string to its score."""

    def __init__(self, pieces: dict[str, float]):
        self._pieces = pieces
        # a cut depends on the two characters beside it only, so a pattern is
        # safe if it cuts no piece
        self.pattern = next(p for p in map(re.compile, PATTERNS) if all(p.findall(s) == [s] for s in pieces))
        #: the proved whole tokens
        self.whole = frozenset(s for s in pieces if self.merged(s) == 1)

    def merged(self, pre_token: str) -> int:
        symbols, pieces = list(pre_token), self._pieces
        n = len(symbols)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(-pieces[s], i, s) for i in range(n - 1) if (s := symbols[i] + symbols[i + 1]) in pieces]
        heapq.heapify(queue)
        while queue:
            _, i, s = heapq.heappop(queue)
            j = following[i]
            if j >= n or not symbols[i] or symbols[i] + symbols[j] != s:
                continue
            symbols[i], symbols[j] = s, ""
            following[i] = k = following[j]
            if k < n:
                before[k] = i
                if (t := s + symbols[k]) in pieces:
                    heapq.heappush(queue, (-pieces[t], i, t))
            if (h := before[i]) >= 0 and (t := symbols[h] + s) in pieces:
                heapq.heappush(queue, (-pieces[t], h, t))
        return sum(1 if s in pieces else len(s.encode()) for s in symbols if s)

    def memo(self) -> Memo:
        return Memo(self.merged, known=dict.fromkeys(self.whole, 1))

    def count(self, text: str, memo: Memo) -> int:
        if not text:
            return 0
        marked = (SPACE + text).replace(" ", SPACE)
        return sum(sum(map(memo.__getitem__, self.pattern.findall(part))) for part in _parts(marked))


def _parts(marked: str) -> Iterator[str]:
    if len(marked) < 1 << 20:
        yield marked
    else:
        yield from (p.replace(" ", SPACE) for p in slices(marked.replace(SPACE, " ")))


def pieces_of_model(path: str) -> dict[str, float]:
    """The ordinary pieces of a model file and their scores."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}


_open: dict[str, tuple[PieceCounter, Memo]] = {}


def token_counts(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row; ``path`` names
    the model, ``over_limit`` is ``n_tokens > limit``."""
    counter = PieceCounter(pieces_of_model(path))
    shared = docs.sparkSession.sparkContext.broadcast(counter)  # of the vocabulary's size

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _open:
            _open[path] = shared.value, shared.value.memo()
        model, memo = _open[path]
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                n = pa.array([model.count(t, memo) if t else 0 for t in part.column("text").to_pylist()], pa.int64())
                n_bytes = pc.binary_length(part.column("text")).fill_null(0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), n_bytes, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(counts, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
