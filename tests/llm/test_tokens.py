"""Token counts, BPE and packing against the libraries themselves."""

import json
import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kiln.llm.bpe import ByteBPE, bpe_digests, decode_texts, encode_texts
from kiln.llm.memo import Memo, slices
from kiln.llm.packing import Capacity, best_fit, pack
from kiln.llm.token_counts import PieceCounter, pieces_of_model, token_counts

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
SPECIAL = ["<|endoftext|>", "<|startoftext|>x<|endoftext|>", "<s></s><0x0A>"]
EDGES = [None, "", " ", "\n", "a", "  two  spaces ", "▁▁a ▁", "ΣΑΣ straße İ ﬁ ²Ⅷ", "don't 'tis 12,345", "a\x1cb\x85c\x00", "中文 😀🏳️‍🌈", "՘࢏ b", *SPECIAL]
LONG = " ".join(["word"] * 30_000) + "x" * 5_000 + "\n" * 500


def fuzz(n=400, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdé .,\n\t'12▁ßΣ中😀　²_-<|>") for _ in range(rng.randint(0, 40))) for _ in range(n)]


def rows_of(spark, texts):
    # an extra column whose name an operator uses for its own
    return spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")


@pytest.fixture(scope="module")
def texts():
    return EDGES + [LONG] + fuzz() + EDGES  # rows repeat


def test_counts(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    out = {r.doc_id: r for r in token_counts(rows_of(spark, texts), PIECE, 4096).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        n = len(library.encode(t or ""))
        assert (out[i].n_bytes, out[i].n_tokens, out[i].over_limit) == (len((t or "").encode()), n, n > 4096)


def test_whole_tokens_are_proved():
    counter = PieceCounter(pieces_of_model(PIECE))
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    some = [s for s in sorted(counter.whole) if s[0] == "▁" and "▁" not in s[1:] and len(s) > 1][:3000]
    assert all(len(library.encode(s[1:])) == 1 for s in some)
    # a vocabulary in which a piece reaches over a letter's end takes the coarser cuts
    assert PieceCounter({"a": -1.0, ".": -2.0, "a.": -3.0}).pattern.findall("▁a.b▁c") == ["▁a.b", "▁c"]


def test_bpe(spark, texts):
    library = Tokenizer.from_file(BYTE)
    out = {r.doc_id: r for r in bpe_digests(rows_of(spark, texts), BYTE).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (out[i].n_tokens, out[i].ids_sha256) == (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert out[i].decoded_sha256 == sha256(decoded.encode()).hexdigest() and out[i].same


def test_bpe_decodes_any_ids():
    coder, library = ByteBPE(json.load(open(BYTE))), Tokenizer.from_file(BYTE)
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 20))]
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_round_trip(spark):
    docs = rows_of(spark, [t for t in EDGES if t is not None])
    back = decode_texts(encode_texts(docs, BYTE), BYTE)
    assert {(r.doc_id, r.text) for r in back.collect()} == {(r.doc_id, r.text) for r in docs.collect()}


def test_slices_and_memo():
    text = "ab cd " * 1000
    assert "".join(slices(text, 50)) == text and max(map(len, slices(text, 50))) < 60
    calls = Counter()
    memo = Memo(lambda k: calls.update([k]) or k * 2, limit=3, known={"z": "known"})
    assert [memo[k] for k in "abcdaz"] == ["aa", "bb", "cc", "dd", "aa", "known"]
    assert memo["q" * 100] == "q" * 200 and len(memo) <= 4


def check_plan(histogram, capacity, rule):
    plan = best_fit(histogram, capacity, rule)
    bins, seen = {}, Counter()
    for length, first, after, at, each, offset in plan.tolist():
        for i in range(first, after):
            bins.setdefault(at + (i - first) // each, []).append((offset + (i - first) % each * length, length))
            seen[length] += 1
    assert seen == Counter({k: v for k, v in histogram.items() if v})
    tokens, documents, cost = capacity.of_bin
    for held in bins.values():
        held.sort()
        assert [o for o, _ in held] == list(np.cumsum([0, *(n for _, n in held)])[:-1])
        assert sum(n for _, n in held) <= tokens and len(held) <= documents and sum(n * n for _, n in held) <= cost
    return len(bins)


@pytest.mark.parametrize("rule", ["dot", "norm"])
def test_plan(rule):
    rng = random.Random(5)
    for _ in range(60):
        capacity = Capacity(tokens=rng.choice([5, 16, 64]), documents=rng.choice([None, 2, 5]), cost=rng.choice([None, 40, 300]))
        histogram = {rng.randint(1, capacity.piece): rng.randint(1, 30) for _ in range(rng.randint(1, 12))}
        n = check_plan(histogram, capacity, rule)
        if capacity == Capacity(capacity.tokens):
            # pieces of over half a bin need a bin each
            least = max(sum(k * v for k, v in histogram.items()) / capacity.tokens, sum(v for k, v in histogram.items() if 2 * k > capacity.tokens))
            assert n <= 1.25 * least + 1
    assert check_plan({3: 10 ** 4, 2: 10 ** 4}, Capacity(5), rule) == 10 ** 4
    with pytest.raises(ValueError):
        best_fit({1: 1}, Capacity(4), "first")


def test_pack(spark, texts):
    library = Tokenizer.from_file(WORD)
    out = pack(rows_of(spark, texts).repartition(3), WORD, Capacity(tokens=64)).toPandas()
    assert len(out) == sum(-(-(len(library.encode(t or "", add_special_tokens=False).ids) + 1) // 64) for t in texts)
    for i, own in out.sort_values("piece").groupby("doc_id"):
        ids = np.array(library.encode(texts[i] or "", add_special_tokens=False).ids + [1], "<u4")
        assert list(own.piece) == list(range(len(own))) and own.length.sum() == len(ids)
        for r in own.itertuples():
            assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32 and r.start == 64 * r.piece
    placed = out.sort_values(["sequence_id", "offset"])
    ends = placed.groupby("sequence_id").length.cumsum()
    assert (placed.offset == ends - placed.length).all() and ends.max() <= 64
    assert out.sequence_id.nunique() <= 1.05 * out.length.sum() / 64 + 1


def test_empty_tables(spark):
    docs = rows_of(spark, [])
    assert token_counts(docs, PIECE, 1).collect() == bpe_digests(docs, BYTE).collect() == pack(docs, WORD).collect() == []
