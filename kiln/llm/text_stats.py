"""Statistics of whole texts, computed from their bytes an Arrow batch at a
time.  A null or empty text has all statistics 0."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kiln.llm.shingles import byte_chunks, mix, words_of

#: Byte classes whose share of a text is a statistic.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".?", "comma": b",;:", "bang": b"!", "pipe": b"|",
    "symbol": b"#$%&*+/<=>@\\^_`~", "bracket": b"()[]{}", "quote": b"\"'", "dash": b"-", "space": b" \t\r\x0b\x0c", "line": b"\n",
    "wide": bytes(range(0x80, 0x100)),
}
STATISTICS = [*CLASSES, "log_bytes", "log_words", "word_bytes", "distinct_words", "commonest_word", "repeated_next", "distinct_pairs", "words_a_line"]
_CLASS = np.full(256, len(CLASSES), np.uint8)
for _i, _bytes in enumerate(CLASSES.values()):
    _CLASS[list(_bytes)] = _i


def _of_words(words: np.ndarray) -> tuple[float, float, float, float]:
    n = len(words)
    if not n:
        return 0.0, 0.0, 0.0, 0.0
    ordered = np.sort(words)
    ends = np.flatnonzero(np.concatenate((ordered[1:] != ordered[:-1], [True])))
    commonest = int(np.diff(ends, prepend=-1).max())
    if n == 1:
        return 1.0, 1.0, 0.0, 1.0
    pairs = np.sort(mix(words[:-1]) + words[1:])
    return len(ends) / n, commonest / n, float((words[1:] == words[:-1]).mean()), (1 + np.count_nonzero(pairs[1:] != pairs[:-1])) / (n - 1)


def statistics(texts: pa.Array) -> np.ndarray:
    """A row for each text, a column for each of ``STATISTICS``."""
    out = np.zeros((len(texts), len(STATISTICS)))
    k = len(CLASSES)
    for row, data, offsets in byte_chunks(texts):
        words, at = words_of(data, offsets)
        kinds = _CLASS[data]
        for i, (a, b, u, v) in enumerate(zip(offsets[:-1], offsets[1:], at[:-1], at[1:])):
            n = int(b - a)
            if not n:
                continue
            counts = np.bincount(kinds[a:b], minlength=k + 1)
            line, space = counts[k - 2], counts[k - 3]
            n_words = int(v - u)
            out[row + i] = [*(counts[:k] / n), np.log1p(n), np.log1p(n_words), (n - line - space) / max(n_words, 1),
                            *_of_words(words[u:v]), n_words / (1 + line)]
    return out


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the statistics of its ``text``."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics(batch.column(len(keep)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *map(pa.array, found.T)], [*keep, *STATISTICS])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    return docs.select(*keep, docs["text"].alias("_text")).mapInArrow(measured, ", ".join([*fields, *(f"{s} double" for s in STATISTICS)]))
