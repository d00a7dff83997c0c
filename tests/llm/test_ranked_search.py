"""Ranked search against a plain search of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np

from kiln.llm import ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_documents, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scored = []
        for d, c, n in held:
            m = 100 - 50 + (50 * n * n_documents) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def made_up(n_docs, n_items, seed, words=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Ärger", "日本", "x1", "X1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, weights, k=n))
    return [(i, text(rng.randint(1, 80))) for i in range(n_docs)], [(i, text(rng.randint(1, 25))) for i in range(n_items)]


def searched(spark, docs, items, k, parts=3, **more):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, rank string").repartition(parts)
    q = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, score long")
    found = R.ranked_search(d, q, k, **more)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def test_equals_a_plain_search(spark, monkeypatch):
    docs, items = made_up(400, 30, 1)
    assert searched(spark, docs, items, 10) == plain(docs, items, 10)


def test_blocks_of_items_and_small_parts(spark, monkeypatch):
    docs, items = made_up(150, 12, 2)
    assert searched(spark, docs, items, 5, pairs=40) == plain(docs, items, 5)


def test_edges(spark):
    copies = [(100 + i, "Common words, repeated copy x1") for i in range(60)]
    docs = [(1, None), (2, ""), (3, " ,;."), (None, "common"), (None, "common"), (4, "common"), (4, "common"), (5, "COMMON words"), *copies, (6, "long " * 50_000 + "rare"), (7, "éé É ÉÉ")]
    items = [(1, "common rare"), (1, "words x1"), (None, "éé common"), (2, None), (3, "..."), (4, "absent"), (5, "copy")]
    assert searched(spark, docs, items, 50) == plain(docs, items, 50)
    assert searched(spark, [], items, 50) == [] == searched(spark, docs, [], 50) == searched(spark, [(1, None)], items, 50)


def test_accumulators_stop_and_results_stay():
    """With few accumulators allowed by the bounds, the best are the same."""
    rng = np.random.default_rng(3)
    n, k = 5000, 10
    sizes = rng.integers(1, 12, n)
    terms_ = np.concatenate([rng.choice(200, s, replace=False, p=(w := 1 / np.arange(1, 201)) / w.sum()) for s in sizes]).astype(np.int32)
    times = rng.integers(1, 6, len(terms_)).astype(np.int32)
    m = R.normalised(sizes.astype(np.int64), n, int(sizes.sum()))
    part = R.Part(np.arange(n), np.zeros(n, bool), m, sizes, terms_, times)
    df = np.bincount(terms_, minlength=200)
    stopped = 0
    for _ in range(40):
        query = sorted(((int(t), R.weight(n, int(df[t]))) for t in rng.choice(200, 8, replace=False)), key=lambda q: -q[1])
        best = R._Best(k)
        made = part.search(query, best, k)
        scores = np.zeros(n, np.int64)
        for t, w in query:
            at = np.repeat(np.arange(n), sizes)[terms_ == t]
            scores[at] += w * ((1_000_000_000 * times[terms_ == t].astype(np.int64)) // (1000 * times[terms_ == t] + 20 * m[at]))
        expected = np.lexsort((np.arange(n), -scores))[:k]
        assert best.documents.tolist() == expected[scores[expected] > 0].tolist()
        assert best.scores.tolist() == scores[best.documents].tolist()
        assert made <= np.count_nonzero(scores)
        stopped += made < np.count_nonzero(scores)
    assert stopped > 10


def test_lengths_beyond_64_bits():
    n = np.array([1, 10**9], np.int64)
    assert R.normalised(n, 10**11, 10**14).tolist() == [50 + 50 * int(x) * 10**11 // 10**14 for x in n]
