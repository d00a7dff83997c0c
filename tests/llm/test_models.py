"""Language, quality, n-gram scores and vector search: brute force and
held-out accuracy."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kiln.llm import langid, queries, rule_quality
from kiln.llm.ann_graph import build, lifted, nearest_neighbours, robust_prune
from kiln.llm.lm_scoring import _packed, _unpacked, backoff_scores
from kiln.llm.text_stats import STATISTICS, statistics, with_statistics

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- language

def test_language_held_out(spark):
    out = queries.QUERIES["op7_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = out.join(docs, "doc_id").filter("held_out")
    assert held.filter("lang = lang_pred").count() >= 0.98 * held.count() > 200
    assert out.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_language_edges(spark):
    rows = [(i, t, lang, "x") for i, (t, lang) in enumerate([("the house and the tree", "en"), ("das haus und der baum", "de")] * 20 + [(None, "en"), ("the", None)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = langid.learn(docs)
    assert model.languages == ["de", "en"]
    texts = [None, "", "12 ²Ⅷ ... \n", "THE HOUSE", "baumhaus " * 40_000, "treehouse", "x" * 200_000, "中文"]
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(asked, model).collect()}
    assert [found[i] for i in range(3)] == [("und", 0.0)] * 3
    assert [found[i][0] for i in (3, 4, 5)] == ["en", "de", "en"]
    assert found[7] == ("de", 0.0) and 0 <= found[6][1] <= 1  # letters, but nothing known: the most usual language
    left = langid.in_known_language(docs)
    assert left.schema == docs.schema and left.count() == 41
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert langid.in_known_language(none).count() == docs.count()
    empty = docs.limit(0)
    assert langid.in_known_language(empty).count() == 0 and langid.learn(empty).languages == []


def plain_language(model, text):
    """The answer for a text, word by word from the model's tables."""
    sums, n, letters = [0.0] * len(model.languages), 0, False
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        key = word if len(word) <= 64 else "#" + hashlib.md5(word.encode()).hexdigest()
        letters = letters or any(c.isalpha() for c in word)
        rows = [model.word_rows[model.words[key]]] if key in model.words else []
        for size in (5, 4, 3, 2, 1):
            marked = f"^{word}$"
            grams = [marked[i:i + size] for i in range(len(marked) - size + 1)]
            if not rows and any(c.isalpha() for c in word):
                rows = [model.gram_rows[model.grams[g]] for g in grams if g in model.grams]
        if rows:
            n += 1
            sums = [s + sum(r[j] for r in rows) / len(rows) for j, s in enumerate(sums)]
    if not n or not model.languages:
        return (model.usual if letters else "und"), 0.0
    best = max(range(len(sums)), key=lambda j: (sums[j], -j))
    return model.languages[best], 1 / sum(math.exp((s - sums[best]) / n) for s in sums)


def test_language_equals_a_plain_scorer(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learn(docs.select("doc_id", "text", "lang"), max_words=400, max_grams=800)
    odd = [(-1, "w" * 100 + " " + "é" * 70), (-2, "中文 日本語"), (-3, "½ ² 12"), (-4, None), (-5, "Ⅷ the"), (-6, "zzzzz qqqq " * 3000)]
    asked = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    found = {r.doc_id: r for r in langid.predict(asked, model).collect()}
    for row in asked.collect():
        lang, score = plain_language(model, row.text)
        assert (found[row.doc_id].lang_pred, found[row.doc_id].score) == (lang, pytest.approx(score, abs=1e-9))
    assert found[-2].lang_pred == model.usual != "und"


def test_language_bounds_are_shared(spark):
    """Ties inside the bound, a rare language beside a common one, long words."""
    common = [(i, f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x", "aa") for i in range(600)]
    rare = [(1000 + i, "k" * 90 + " zulu", "zz") for i in range(3)]
    docs = spark.createDataFrame(common + rare, "doc_id long, text string, lang string")
    model = langid.learn(docs, max_documents=100, max_words=40, max_grams=40)
    of = lambda lang, rows: int((rows[:, model.languages.index(lang)] > rows[:, 1 - model.languages.index(lang)]).sum())
    assert model.languages == ["aa", "zz"] and of("aa", model.word_rows) == 20 and of("zz", model.word_rows) == 2
    assert langid._key("k" * 90) in model.words and "kkkkk" in model.grams
    asked = spark.createDataFrame([(1, "k" * 90), (2, "zulu"), (3, "kkkkkkk")], "doc_id long, text string")
    assert {r.lang_pred for r in langid.predict(asked, model).collect()} == {"zz"}
    left = langid.in_known_language(docs.unionByName(spark.createDataFrame([(7, "12", "zz"), (8, "зима", None), (9, None, "zz")], docs.schema)))
    assert left.count() == 603


def test_language_memory_is_bounded():
    model = langid.Model(["a", "b"], {"ja": 0}, np.array([[0.0, -9.0]]), {"j": 0}, np.array([[-1.0, -2.0]]))
    scorer = langid.Scorer(model, limit=60, part=20)
    text = " ".join("j" + chr(97 + i % 26) + chr(97 + i // 26) for i in range(400)) + " ja"
    assert scorer.score(text)[0] == "a" and scorer.score("ja " * 50) == scorer.score("ja") and len(scorer._rows) < 70


# --- quality

def test_quality_held_out(spark):
    out = queries.QUERIES["op6_rule_quality"](spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    held = out[out.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.97
    assert ((out.score >= 0.3) == (out.predicted == 1)).all() and out.score.between(0, 1).all()


def test_quality_equals_a_plain_scorer(spark):
    """Every row's score from its statistics and the learned rules."""
    measured = with_statistics(spark.read.parquet(f"{SF}/documents.parquet"), ["doc_id"])
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rules = rule_quality.learn(measured.join(labels, "doc_id"), "quality", trees=4)
    assert rules.weighted
    for row in measured.select("*", rules.score().alias("_score")).collect():
        total = rules.intercept
        for conditions, weight in rules.weighted:
            if all(row[s] <= t if upper else row[s] > t for s, upper, t in conditions):
                total += weight
        assert row["_score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)
    none = rule_quality.learn(measured.limit(0).join(labels, "doc_id"), "quality")
    assert {r["s"] for r in measured.select(none.score().alias("s")).collect()} == {0.5} and measured.limit(0).select(rules.score()).count() == 0


def test_rules_from_a_described_tree():
    described = """DecisionTreeRegressionModel: depth=2
  If (feature 1 <= 0.5)
   If (feature 0 <= 2.0)
    Predict: 1.0
   Else (feature 0 > 2.0)
    Predict: 0.0
  Else (feature 1 > 0.5)
   If (feature 1 <= 1.0E-3)
    Predict: 3.0
   Else (feature 1 > 0.001)
    Predict: 2.0
"""
    found = rule_quality.paths(described, ["a", "b"])
    assert (("b", True, 0.5),) in found and (("a", False, 2.0), ("b", True, 0.5)) in found
    assert (("b", False, 0.5),) in found and (("b", False, 0.5), ("b", True, 0.001)) in found and len(found) == 5


def test_rules_learn_and_compile(spark):
    rng = random.Random(1)
    rows = [(i, *[rng.random() for _ in STATISTICS]) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS))
    frame = frame.withColumn("y", ((F.col("upper") > 0.4) & (F.col("digit") <= 0.7)).cast("int"))
    rules = rule_quality.learn(frame, "y", trees=6)
    scored = frame.select("y", rules.score().alias("s"))
    assert scored.filter("(s >= 0.5) = (y = 1)").count() > 580 and 0 < len(rules.weighted) < 60
    assert rule_quality.learn(frame.filter("y = 1"), "y").intercept > 10 and rule_quality.learn(frame.limit(0), "y").intercept == 0.0


def test_statistics(spark):
    docs = spark.createDataFrame([(1, None, 2.0), (2, "", 2.0), (3, "A b\nA!", 2.0), (4, "be " * 100_000, 2.0)], "doc_id long, text string, upper double")
    found = {r.doc_id: r for r in with_statistics(docs, ["doc_id"]).collect()}
    assert all(found[1][s] == found[2][s] == 0 for s in STATISTICS)
    assert found[3]["upper"] == pytest.approx(2 / 6) and found[3]["bang"] == pytest.approx(1 / 6) and found[3]["words_a_line"] == 1.5
    assert found[4]["commonest_word"] == found[4]["repeated_next"] == 1
    import pyarrow as pa
    assert statistics(pa.array([], pa.string())).shape == (0, len(STATISTICS))


# --- n-gram scores

def brute_scores(texts):
    words = [WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    own = [[Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) for k in (1, 2, 3)] for w in words]
    total = [sum((o[k] for o in own), Counter()) for k in range(3)]
    n = sum(map(len, words))
    out = []
    for w, o in zip(words, own):
        count = lambda g: total[len(g) - 1][g] - o[len(g) - 1][g]  # noqa: E731, B023
        rest, score, used = round(1e6 * math.log(max(n - len(w), 1))), 0, Counter()
        for i in range(len(w)):
            most = min(i + 1, 3)
            k = next((k for k in range(most, 0, -1) if count(tuple(w[i + 1 - k:i + 1])) > 0), 0)
            used[k] += 1
            g = tuple(w[i + 1 - k:i + 1])
            p = count(g) / count(g[:-1]) if k > 1 else count(g) if k else 1
            score += round(1e6 * math.log(0.4 ** (most - k) * p)) - (rest if k < 2 else 0)
        out.append((len(w), used[3], used[2], used[1], used[0], score))
    return out


@pytest.mark.parametrize("block_bytes", [16 << 20, 200])
def test_scores(spark, block_bytes):
    rng = random.Random(8)
    texts = [None, "", " \n", "One", "one", "A b c", "a B c d"] + [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 60))) for _ in range(150)]
    texts += ["same copy here twice"] * 2 + ["long " * 30_000]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)], "doc_id long, text string, score double").repartition(3)
    found = {r.doc_id: tuple(r)[1:7] for r in backoff_scores(docs, block_bytes).collect()}
    expected = brute_scores(texts)
    assert all(found[i][:5] == e[:5] and abs(found[i][5] - e[5]) <= 2 for i, e in enumerate(expected))
    assert backoff_scores(docs.limit(0)).count() == 0


def test_scores_of_input_from_a_shuffle(spark):
    """Its partitions may be merged differently in each scan."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    docs = spark.createDataFrame([(i % 300, texts[i % 300]) for i in range(600)], "doc_id long, text string").distinct()
    found = {r.doc_id: tuple(r)[1:7] for r in backoff_scores(docs, 300).collect()}
    assert all(found[i][:5] == e[:5] and abs(found[i][5] - e[5]) <= 2 for i, e in enumerate(brute_scores(texts)))


def test_blocks_that_do_not_agree_are_an_error():
    from kiln.llm import lm_scoring as L
    words = lambda texts: L._Words([pa.array(texts, pa.string())])
    marks = [words(t).mark() for t in (["a b", "c"], ["c", "a b"], ["a", "b c"], ["a b c"], ["a b", "c", ""], ["a b"], [])]
    assert len(set(marks)) == len(marks) and words(["a b", "c"]).mark() == marks[0]
    sink = pa.BufferOutputStream()
    batch = pa.record_batch({"doc_id": pa.array([1], pa.int64()), "text": ["a b"]})
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    texts = pa.table({"block": [0], "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
    others = lambda mark: pa.table({"block": [0], "mark": [mark], "bucket": [0], "others": pa.array([L._counts(np.array([1, 1]))], pa.binary())})
    assert L._scored(texts, others(words(["a b"]).mark()), 0).num_rows == 1
    with pytest.raises(RuntimeError, match="different blocks"):
        L._scored(texts, others(3), 0)


def test_packed_keys():
    rng = np.random.default_rng(3)
    for n in (1, 2, 1000):
        keys = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        assert (_unpacked(_packed(keys)) == keys).all()


# --- vector search

def brute_nearest(rows, k, every):
    rows = sorted(rows)
    out = {}
    for q, v in rows:
        if q % every == 0:
            out[q] = sorted((-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in rows if i != q)[:k]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 24))
    rows = [(i, (centres[i % 30] * rng.uniform(0.5, 2) + rng.normal(size=24) * 0.3).astype("float32").tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[7][1]) for i in range(300)]  # a very common vector
    bad = [(5001, None), (5002, [0.0] * 24), (5003, [float("nan")] * 24), (5004, [1.0] * 23 + [None]), (5005, [float("inf")] * 24), (5006, [1.0, 2.0]), (None, rows[0][1]), (3, rows[3][1])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], "vec_id long, embedding array<float>, rank int").repartition(5)
    found = nearest_neighbours(frame, k=20, every=20, shard_rows=500).toPandas()
    expected = brute_nearest(rows, 20, 20)
    assert set(found.query_id) == set(expected)
    vectors, hits = dict(rows), 0
    for q, own in found.groupby("query_id"):
        own = own.sort_values("rank")
        assert list(own["rank"]) == list(range(1, 21)) and q not in set(own.vec_id)
        assert all(s == pytest.approx(float(np.dot(np.float64(vectors[q]), np.float64(vectors[i]))), abs=1e-9) for i, s in zip(own.vec_id, own.score))
        assert [(-s, i) for s, i in zip(own.score, own.vec_id)] == sorted((-s, i) for s, i in zip(own.score, own.vec_id))
        hits += len({i for _, i in expected[q]} & set(own.vec_id))
    assert hits >= 0.95 * 20 * len(expected)
    few = nearest_neighbours(frame.filter("vec_id IN (20, 21, 40, 5002)"), k=20).collect()
    assert sorted((r.query_id, r.vec_id) for r in few) == [(20, 21), (20, 40), (40, 20), (40, 21)]
    assert nearest_neighbours(frame.limit(0)).count() == 0 and nearest_neighbours(frame.filter("vec_id = 20")).count() == 0


def test_pruning_keeps_diverse_edges():
    vectors = lifted(np.array([[1, 0], [0.99, 0.02], [0.98, 0.03], [0.99, -0.6]], float))
    kept = robust_prune(vectors, np.array([0]), np.array([[1, 2, 3, 1, -1, 0]]), 1.0, 3)[0]
    assert list(kept[kept >= 0]) == [1, 3]
    assert build(vectors[:1], 0).edges.max() == -1


def test_counts_beyond_32_bits():
    from kiln.llm.lm_scoring import _counts, _totals, _uncounted
    n = np.array([1, 2 ** 32 - 1, 2 ** 32 + 5, 2 ** 53 + 1])
    assert _uncounted(_counts(n)).tolist() == n.tolist()
    keys, big = np.array([3, 9], np.uint64), 3 * 10 ** 9
    rows = pa.table({"bucket": [0] * 3, "block": [0, 1, 2], "mark": [5, 6, 7], "grams": pa.array([_packed(keys)] * 3, pa.binary()), "counts": pa.array([_counts(np.array([big, 1]))] * 3, pa.binary())})
    assert [_uncounted(x.as_buffer()).tolist() for x in _totals(rows).column("others")] == [[2 * big, 2]] * 3
