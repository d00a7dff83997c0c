"""Context budget cases (FIXTURES 1.4), nearest-neighbour paths, chat."""
import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import collection, nearest
from kiln.operators import retrieval as R
from kiln.operators.nearest import PivotTree
from kiln.session import materialize

RES = "query_id string, rank int, type string, page int, distance double, document string"


def ctx(spark, rows, budget, queries=("q",)):
    res = spark.createDataFrame(rows, RES)
    qs = spark.createDataFrame([(q,) for q in queries], "query_id string")
    return {r["query_id"]: r["context"] for r in R.rag_context(qs, res, "query_id", budget).collect()}


def piece(page, rel, doc, kind="Text"):
    return f"[{kind} from page {page}, relevance: {rel}]\n{doc}\n"


def test_no_result(spark):
    assert ctx(spark, [], 100) == {"q": "No relevant context found."}


def test_budget_none_keeps_all(spark):
    rows = [("q", 1, "text", 1, 0.25, "aaa"), ("q", 2, "image", 3, 0.5, "Image from page 3, index 0")]
    want = piece(1, "0.75", "aaa") + "\n---\n" + piece(3, "0.50", "Image from page 3, index 0", "Image")
    assert ctx(spark, rows, None) == {"q": want}


def test_first_piece_over_budget_gives_empty(spark):
    rows = [("q", 1, "text", 1, 0.1, "x" * 50)]
    assert ctx(spark, rows, 10) == {"q": ""}


def test_exact_budget_and_no_short_piece_after_overflow(spark):
    p1 = piece(1, "0.90", "abc")
    rows = [("q", 1, "text", 1, 0.1, "abc"), ("q", 2, "text", 2, 0.2, "y" * 40), ("q", 3, "text", 3, 0.3, "z")]
    # budget equals the first piece: kept; second overflows; the short third stays out
    assert ctx(spark, rows, len(p1)) == {"q": p1}


def test_relevance_rounds_like_python(spark):
    rows = [("q", 1, "text", 1, 0.875, "d")]  # 1 - d = 0.125 -> '0.12' in Python
    assert ctx(spark, rows, None)["q"].startswith("[Text from page 1, relevance: 0.12]")


def _vectors(spark, n, dim, seed):
    rnd = np.random.default_rng(seed)
    m = rnd.normal(size=(n, dim)).astype(np.float32)
    return spark.createDataFrame([(i, [float(x) for x in m[i]]) for i in range(n)], "id long, embedding array<float>"), m


def _brute(q, c, k):
    qn = q / np.linalg.norm(q, axis=1, keepdims=True)
    cn = c / np.linalg.norm(c, axis=1, keepdims=True)
    d = 1 - qn.astype(np.float64) @ cn.T.astype(np.float64)
    return {i: list(np.lexsort((np.arange(len(c)), np.round(d[i], 12)))[:k]) for i in range(len(q))}


@pytest.mark.parametrize("cells, block_rows", [(64, 4096), (5, 7), (1, 50)])
def test_knn_join_agrees_with_brute_force(spark, cells, block_rows):
    coll, cm = _vectors(spark, 120, 16, 1)
    qs, qm = _vectors(spark, 30, 16, 2)
    out = R.knn_join(qs.withColumnRenamed("id", "query_id"), coll, 4, cells=cells, block_rows=block_rows).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["id"])
    assert got == {i: [int(x) for x in v] for i, v in _brute(qm, cm, 4).items()}


@pytest.mark.parametrize("parts", [1, 7])
def test_zero_and_equal_vectors(spark, parts):
    rows = [(i, [1.0, 0.0]) for i in range(50)] + [(100, [0.0, 0.0]), (101, None), (102, [0.0, 1.0])]
    coll = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(parts)
    qs = spark.createDataFrame([(1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None)], "query_id long, embedding array<double>")
    out = sorted(tuple(r) for r in R.knn_join(qs, coll, 3, block_rows=10).collect())
    assert out == [(1, 1, 0, 0.0), (1, 2, 1, 0.0), (1, 3, 2, 0.0)]
    assert [r["id"] for r in R.knn_topk(coll, [0.0, 3.0], 100).orderBy("rank").collect()][:2] == [102, 0]
    assert R.knn_topk(coll, [0.0, 0.0], 5).count() == 0 and R.knn_topk(coll, qs.where("query_id = 1"), 60).count() == 51
    assert R.knn_join(qs, coll.where("id = 100"), 3).count() == 0


def test_far_cells_are_skipped():
    tree = PivotTree(np.eye(8))
    tree.fill(np.full(8, 100), np.full(8, 0.2))
    assert [tree.visits(v[None], 5).tolist() for v in np.eye(8)] == [[i] for i in range(8)]
    assert sorted(tree.visits(np.eye(8)[2:5], 5)) == [2, 3, 4]
    # a cell too small for k brings in others, an empty one is never visited
    tree = PivotTree(np.eye(8))
    tree.fill(np.array([2, 2, 2, 2, 2, 2, 2, 0]), np.full(8, 0.2))
    assert set(tree.visits(np.eye(8)[:1], 5)) == set(range(7))


def test_tree_visits_hold_the_nearest():
    """Whatever the cells, all true neighbours lie in visited ones."""
    rng = np.random.default_rng(9)
    for n, leaves in ((300, 40), (300, 1), (50, 50)):
        units = rng.normal(size=(n, 6)) * rng.uniform(0.1, 1, (n, 1)) + np.eye(6)[rng.integers(0, 6, n)]
        units /= np.linalg.norm(units, axis=1)[:, None]
        tree = PivotTree(units[:leaves])
        leaf, far = tree.nearest(units)
        radius = np.zeros(leaves)
        np.maximum.at(radius, leaf, far)
        tree.fill(np.bincount(leaf, minlength=leaves), radius)
        for q in units[::7]:
            near = np.argsort(1 - units @ q, kind="stable")[:4]
            assert set(leaf[near]) <= set(tree.visits(q[None], 4))


def test_members_move_to_visiting_blocks_only(spark):
    """Well-parted clusters: each block visits its own cluster's cells, and the
    rows exchanged grow with these pairs."""
    rng = np.random.default_rng(5)
    rows = [(i, (np.eye(16)[i % 16] + rng.normal(size=16) * 0.01).tolist()) for i in range(1600)]
    coll = spark.createDataFrame(rows, "id long, embedding array<double>")
    with_pairs = []

    def keep(df, name):
        out = materialize(df, name)
        with_pairs.append((name, out))
        return out

    nearest.materialize, before = keep, nearest.materialize
    try:
        found = nearest.knn_join(coll.withColumnRenamed("id", "query_id"), coll, 3, cells=64, block_rows=50)
    finally:
        nearest.materialize = before
    assert found.count() == 4800
    by_name = dict(with_pairs)
    pairs = by_name["visits"].count()
    members = by_name["cells"].groupBy("cell").count()
    moved = by_name["visits"].where("part = 0").join(members, "cell").agg(F.sum("count")).first()[0]
    every = by_name["visits"].select("block_cell", "block").distinct().count() * 1600
    assert pairs == by_name["visits"].distinct().count() and moved < every / 8
    plan = found._jdf.queryExecution().toString()
    assert "Generate explode" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_knn_topk_plan_is_take_ordered(spark):
    coll, cm = _vectors(spark, 50, 8, 3)
    top = R.knn_topk(coll, list(cm[0]), 3)
    assert [r["id"] for r in top.orderBy("rank").collect()][0] == 0
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_chat_history_and_wrap(spark):
    conv = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo")],
                                 "conv_id long, turn long, role string, text string")
    rows = {r["turn"]: r["text"] for r in R.chat_history(conv).collect()}
    assert rows[1] == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n"
    opener = conv.select(R.chat_wrap(F.lit("user"), F.lit("q"), add_generation_prompt=True)).first()[0]
    assert opener == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\n"


def test_page_text_and_images(spark):
    html = ('<html><head><title>T</title><script>var a="<p>";</script></head><body><p>Hello &amp; '
            'bye &copy;&#233;&eacute;&#x41;&amp;lt;&nbsp;&hellip;</p><!-- c --><img src="a.png"><IMG alt=x src="b.jpg">'
            "<img src='c d.png' /><img width=1 src=e.gif><img data-src='no.png'></body></html>")
    pages = spark.createDataFrame([(1, html), (2, "<p>  </p>"), (3, None)], "page_id long, html string")
    assert [tuple(r) for r in R.extract_page_text(pages).collect()] == [(1, "Hello & bye ©ééA&lt; …")]
    imgs = [tuple(r) for r in R.extract_page_images(pages).orderBy("index").collect()]
    assert imgs == [(1, 0, "a.png"), (1, 1, "b.jpg"), (1, 2, "c d.png"), (1, 3, "e.gif")]


def test_vector_ids_differ_by_source(spark):
    df = spark.range(200_000).select(R.make_vector_id("text", F.lit(0), F.concat(F.lit("s"), "id")).alias("v"))
    assert df.distinct().count() == 200_000
    ab = spark.createDataFrame([("a1", 2), ("a", 12)], "s string, i int").select(R.make_vector_id("t", F.col("i"), F.col("s")))
    assert ab.distinct().count() == 2


def test_stored_collection(spark, tmp_path):
    path = str(tmp_path / "coll")
    assert R.read_collection(spark, path).count() == 0
    rows = [("a", [1.0], "d", 1, "s", None, "text"), ("b", [2.0], "e", 1, "s", 0, "image")]
    frame = spark.createDataFrame(rows, R.COLLECTION)
    assert R.add_to_collection(frame, path).count() == 2
    more = R.add_to_collection(frame.unionByName(spark.createDataFrame([("c", None, None, 1, None, None, "text")], R.COLLECTION)), path)
    assert sorted(r.id for r in more.collect()) == ["a", "b", "c"]
    only = more.where("type = 'image'")
    assert "PartitionFilters: [isnotnull(type" in only._jdf.queryExecution().executedPlan().toString() and only.count() == 1


def _vector(i, document="d", kind="text", page=1):
    return (i, [1.0], document, page, "s", None, kind)


def test_an_id_twice_in_one_call_is_stored_once(spark, tmp_path):
    path = str(tmp_path / "coll")
    given = spark.createDataFrame([_vector("a", "second"), _vector("a", "first"), _vector("b"), _vector("b", kind="image"), _vector("a", None)], R.COLLECTION).repartition(3)
    stored = {r.id: (r.document, r.type) for r in R.add_to_collection(given, path).collect()}
    assert stored == {"a": (None, "text"), "b": ("d", "image")}
    # what is stored stays
    again = R.add_to_collection(spark.createDataFrame([_vector("a", "later"), _vector("c")], R.COLLECTION), path)
    assert sorted((r.id, r.document) for r in again.collect()) == [("a", None), ("b", "d"), ("c", "d")]


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    """A commit that meets a taken number is taken up again on the new snapshot."""
    path, commit, calls = str(tmp_path / "coll"), collection._Snapshots.commit, []

    def late(self, number, parts):
        calls.append(number)
        if len(calls) == 1:  # another writer is faster
            R.add_to_collection(spark.createDataFrame([_vector("a", "other"), _vector("x")], R.COLLECTION), path)
        return commit(self, number, parts)

    monkeypatch.setattr(collection._Snapshots, "commit", late)
    found = R.add_to_collection(spark.createDataFrame([_vector("a", "mine"), _vector("y")], R.COLLECTION), path)
    assert sorted((r.id, r.document) for r in found.collect()) == [("a", "other"), ("x", "d"), ("y", "d")]
    assert calls == [1, 1, 2] and len(os.listdir(f"{path}/data")) == 2


def test_writers_in_threads(spark, tmp_path):
    path = str(tmp_path / "coll")
    frames = [spark.createDataFrame([_vector(f"v{j}", f"w{i}") for j in range(i, i + 4)], R.COLLECTION) for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda f: R.add_to_collection(f, path), frames))
    ids = [r.id for r in R.read_collection(spark, path).collect()]
    assert sorted(ids) == sorted({f"v{j}" for j in range(7)})


def test_a_dead_writer_leaves_nothing_to_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "coll")
    R.add_to_collection(spark.createDataFrame([_vector("a")], R.COLLECTION), path)

    def dies(self, number, parts):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(collection._Snapshots, "commit", dies)
        with pytest.raises(KeyboardInterrupt):
            R.add_to_collection(spark.createDataFrame([_vector("b")], R.COLLECTION), path)
    assert [r.id for r in R.read_collection(spark, path).collect()] == ["a"]
    assert R.add_to_collection(spark.createDataFrame([_vector("b")], R.COLLECTION), path).count() == 2


def test_lsh_recall(spark):
    """At least nine tenths of the exact nearest, with split buckets."""
    rng = np.random.default_rng(7)
    rows = [(i, (np.eye(24)[i % 24] * rng.uniform(1, 3) + rng.normal(size=24) * 0.25).tolist()) for i in range(3000)]
    rows += [(5000 + i, rows[3][1]) for i in range(500)] + [(9000, [0.0] * 24), (9001, None)]
    coll = spark.createDataFrame(rows, "id long, embedding array<double>")
    qs = coll.where("id % 50 = 0").withColumnRenamed("id", "query_id")
    exact = {(r.query_id, r.id) for r in R.knn_join(qs, coll, 10).collect()}
    for block_rows in (4096, 40):
        found = nearest.knn_lsh(qs, coll, 10, block_rows=block_rows).collect()
        assert len({(r.query_id, r["rank"]) for r in found}) == len(found)
        assert len(exact & {(r.query_id, r.id) for r in found}) >= 0.9 * len(exact) and len(found) <= len(exact)
    assert nearest.knn_lsh(qs, coll.limit(0), 3).count() == 0


def test_pluggable_encoder_and_generator(spark):
    def encoder(df, id_col, text_col):
        return df.withColumn("embedding", F.array(F.length(text_col).cast("float"), F.lit(1.0).cast("float")))

    rows = [(f"v{i}", [float(i), 1.0], f"doc {i}", 1, "s", None, "image" if i % 2 else "text") for i in range(1, 9)]
    coll = spark.createDataFrame(rows, R.COLLECTION)
    qs = spark.createDataFrame([("q", "four")], "query_id string, question string")
    out = R.rag_answers(qs, coll, encoder, lambda question, context: F.concat(question, F.lit("!")), n_results=2, filter_type="text").first()
    assert out.response == "four!" and "doc 4" in out.context and out.context.count("[Text") == 2
    assert R.rag_answers(qs, coll, encoder).first().context.count("relevance") == 5
