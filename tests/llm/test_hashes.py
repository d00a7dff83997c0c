"""Words that a polynomial modulo 2^64 cannot tell apart, and very long ones."""

import random

import pyarrow as pa

from kiln.llm.lm_scoring import backoff_scores
from kiln.llm.minhash import near_duplicates
from kiln.llm.shingles import BLOCK, byte_chunks, sets_of, words_of
from kiln.llm.suffix_dedup import repeat_digests


def morse(n, a="a", b="b"):
    return "".join((a, b)[i.bit_count() & 1] for i in range(n))


TWINS = [(morse(n), morse(n, "b", "a")) for n in (1024, 2048, 1 << 15)]


def hashes(texts):
    found = []
    for _, data, offsets in byte_chunks(pa.array(texts)):
        words, at = words_of(data, offsets)
        found += [words[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    return found


def test_words_are_told_apart():
    for a, b in TWINS:
        (x,), (y,) = hashes([a, b])
        assert x != y
    rng = random.Random(2)
    words = {"".join(rng.choices("abcZ é", k=rng.choice([1, 3, BLOCK - 1, BLOCK, BLOCK + 1, 5 * BLOCK, 777]))).replace(" ", "_").lower() for _ in range(3000)}
    words |= {w[BLOCK:2 * BLOCK] + w[:BLOCK] + w[2 * BLOCK:] for w in words if len(w) > 2 * BLOCK}  # blocks in another order
    assert len({h[0] for h in hashes(sorted(words))}) == len(words)


def test_a_word_is_the_same_wherever_it_stands():
    long = "x" * 200 + "y" * 100
    alone = hashes(["one", long, "Two"])
    assert hashes([f"one {long}\tTWO", f"  {long.upper()} one"]) == [[alone[0][0], alone[1][0], alone[2][0]], [alone[1][0], alone[0][0]]]
    assert [s.tolist() for _, sets in sets_of(pa.array(["", None, "a b"]), 3) for s in sets][:2] == [[], []]


def test_near_duplicates_and_scores(spark):
    rows = [(10 * i + j, w) for i, pair in enumerate(TWINS) for j, w in enumerate(pair)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.component_id == r.doc_id and r.kept for r in near_duplicates(docs, width=3, percent=85).collect())
    assert all((r.n_words, r.n_unknown) == (1, 1) for r in backoff_scores(docs).collect())


def test_one_exchange_of_the_texts(spark):
    """Both joins of operator 5 read the texts from one shuffle."""
    passage = " ".join(f"w{i}" for i in range(100))
    docs = spark.createDataFrame([(i, f"{i} {passage} {i} {passage[i:]}") for i in range(40)], "doc_id long, text string")
    found = repeat_digests(docs)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    texts = [line for line in plan if "Exchange" in line and "hashpartitioning(row" in line and "REPARTITION_BY_COL" in line]
    assert sum("ReusedExchange" not in line for line in texts) == 1 == sum("ReusedExchange" in line and "text" in line for line in texts)
