"""Exact, near and passage duplicates against brute force."""

import itertools
import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from kiln.llm.components import connected_components
from kiln.llm.exact_dedup import duplicate_classes, exact_dedup
from kiln.llm.minhash import alike, circulant_minhash, near_dedup, near_duplicates
from kiln.llm.shingles import sets_of
from kiln.llm.suffix_dedup import cut_repeats, repeat_digests, repeated_spans, shared_windows

COLUMNS = "doc_id long, text string, row int, kept string, run int"


def frame(spark, rows, path):
    """Rows written and read again; with columns whose names clash."""
    spark.createDataFrame([(i, t, 5, "x", 1) for i, t in rows], COLUMNS).repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


EDGES = [(None, None), (1, None), (2, ""), (3, "Same text"), (4, "sAME TEXT"), (4, "same text"), (5, "É same"), (6, "é same"), (None, "same text"), (7, " "), (8, "x" * 300_000), (9, "X" * 300_000)]


def test_exact(spark, tmp_path):
    docs = frame(spark, EDGES + [(100 + i, f"copy {i % 3}") for i in range(60)], tmp_path / "d")
    out = duplicate_classes(docs, fan=2).toPandas()
    groups = {}
    for r in out.itertuples():
        groups.setdefault(bytes(r.sha), []).append(r)
    texts = EDGES + [(100 + i, f"copy {i % 3}") for i in range(60)]
    expected = {}
    for i, t in texts:
        expected.setdefault(sha256(low(t).encode()).digest(), []).append(i)
    assert {k: sorted(v, key=lambda x: (x is None, x or 0)) for k, v in expected.items()}.keys() == groups.keys()
    for sha, members in groups.items():
        ids = [i for i in expected[sha] if i is not None]
        assert len(members) == len(expected[sha]) and sum(m.kept for m in members) == 1
        assert all(m.group_size == len(members) for m in members)
        keep = [m for m in members if m.kept][0]
        assert (keep.doc_id == max(ids)) if ids else keep.doc_id != keep.doc_id or keep.doc_id is None
    left = exact_dedup(docs, fan=2)
    assert left.schema == docs.schema and left.count() == len(groups)


def test_exact_empty(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert duplicate_classes(docs).count() == exact_dedup(docs).count() == 0


def variants(rng, base, n, share):
    out = []
    for _ in range(n):
        words = list(base)
        for i in rng.sample(range(len(words)), max(1, int(share * len(words)))):
            words[i] = f"w{rng.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


def brute_components(rows, width, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            up[root(a)] = root(b)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        smallest[root(i)] = min(smallest.get(root(i), (True, 0)), (d is None, d or 0))
    return [(d, len(s), None if smallest[root(i)][0] else smallest[root(i)][1]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("block", [256, 4])
def test_near(spark, tmp_path, block):
    rng = random.Random(11)
    rows = [(None, None), (1, ""), (2, " \t"), (3, "two words"), (4, "Two WORDS"), (5, "one"), (None, "two words"), (3, "two words")]
    for g, share in enumerate((0.01, 0.04, 0.06, 0.1)):
        base = [f"b{g}x{i % 83}" for i in range(120)]
        rows += [(1000 * (g + 1) + i, t) for i, t in enumerate([" ".join(base)] + variants(rng, base, 14, share))]
    rows += [(90_000 + i, " ".join(f"q{rng.randrange(10 ** 6)}" for _ in range(50))) for i in range(30)] + [(99_999, "very " * 50_000)]
    docs = frame(spark, rows, tmp_path / "d")
    found = near_duplicates(docs, width=3, percent=85, block=block).toPandas().astype(object).where(lambda x: x.notna(), None)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, found[["doc_id", "n_shingles", "component_id"]].itertuples(index=False)), key=key) == sorted(brute_components(rows, 3, 85), key=key)
    # one row of each component of non-empty sets, and every empty one
    assert found[found.n_shingles > 0].groupby(found.component_id.map(str)).kept.sum().eq(1).all() and found[found.n_shingles == 0].kept.all()
    left = near_dedup(docs, 3, 85)
    assert left.schema == docs.schema and left.count() == found.kept.sum()


def test_near_empty(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert near_duplicates(docs).count() == near_dedup(docs).count() == 0


def test_circulant_minhash_estimates_similarity():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2 ** 63, 1000, dtype=np.uint64)
    b = np.concatenate((a[:800], rng.integers(0, 2 ** 63, 200, dtype=np.uint64)))
    signature = circulant_minhash([np.sort(a), np.sort(b)], 400)
    assert abs((signature[:, 0] == signature[:, 1]).mean() - 800 / 1200) < 0.1
    assert alike(np.sort(a), np.sort(a), 100) and not alike(np.sort(a), np.sort(b), 85)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    up = {n: n for e in edges for n in e}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for u, v in edges:
        a, b = root(u), root(v)
        up[max(a, b)] = min(a, b)
    assert found == {n: root(n) for e in edges if e[0] != e[1] for n in e}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_repeats(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append((len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("length, many", [(12, 4096), (12, 1), (60, 4096), (60, 2)])
def test_repeats(spark, tmp_path, length, many):
    rng = random.Random(length)
    passages = ["".join(rng.choice("abé ") for _ in range(rng.randint(10, 200))) for _ in range(8)]
    texts = [None, "", "short", "ab" * 400, "é" * 300, "z" * (length - 1), "y" * length]
    texts += ["".join(rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(rng.randint(1, 8))) for _ in range(50)]
    texts += [texts[9], texts[10]]
    rows = [(None if i == 12 else i, t) for i, t in enumerate(texts)]
    docs = frame(spark, rows, tmp_path / "d")
    found = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeat_digests(docs, length, many).collect())
    assert found == Counter((i, *b) for (i, _), b in zip(rows, brute_repeats([(t or "").encode() for t in texts], length)))
    spans = repeated_spans(docs, length, many).collect()
    assert all(sum(s.end - s.begin for s in r.spans) + len(r.kept) == r.n_bytes for r in spans)


def test_very_long_text(spark, tmp_path):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(1_300_000))
    text = text[:1_048_500] + text[100:900] + text[1_048_500:]  # across the place where a long text is cut
    (r,) = repeat_digests(frame(spark, [(1, text)], tmp_path / "d"), 200).collect()
    assert (r.n_spans, r.n_removed) in {(2, 1600 + d) for d in range(8)}


def test_shared_windows():
    rng = random.Random(3)
    for _ in range(150):
        length = rng.choice([3, 5, 8])
        strings, before = [], []
        for _ in range(rng.randint(1, 12)):
            left, right = (bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6))) for _ in range(2))
            strings.append(left + b"aa" + right)
            before.append(len(left))
        seen = Counter((i - b, s[i:i + length]) for s, b in zip(strings, before) for i in range(len(s) - length + 1))
        for s, b, got in zip(strings, before, shared_windows(strings, np.array(before), length)):
            assert list(got) == [i for i in range(len(s) - length + 1) if seen[i - b, s[i:i + length]] > 1]


def test_cut_repeats(spark, tmp_path):
    passage = "é".join(str(i) for i in range(120))
    rows = [(1, "first " + passage + " end"), (2, passage), (3, None), (4, "clean"), (5, "pre " + passage)]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    out = cut_repeats(docs)
    assert out.schema == docs.schema
    # the space before or after is part of the repeat where another copy has it too
    assert {(r.doc_id, r.text, r.n_chars) for r in out.collect()} == {(1, "first end", 9), (2, "", 0), (3, None, 0), (4, "clean", 5), (5, "pre", 3)}


def test_repeats_empty(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert repeat_digests(docs).count() == cut_repeats(docs).count() == 0


def test_sets_of_words():
    import pyarrow as pa
    rows = ["A b\tc d", "a  B\nC D", None, "", "one two", "ein wort zwei drei"]
    (_, sets), = sets_of(pa.array(rows), 3)
    assert [len(s) for s in sets] == [2, 2, 0, 0, 1, 1] and (sets[0] == sets[1]).all()


def test_no_task_of_cut_repeats_needs_two_workers(spark, tmp_path, capsys):
    """A Python step right on top of another has a worker of its own, which stays."""
    spark.createDataFrame([(1, "a text", 6)], "doc_id long, text string, n_chars long").write.parquet(str(tmp_path / "d"))
    cut_repeats(spark.read.parquet(str(tmp_path / "d"))).explain()
    steps = [re.match(r"[\s:|+-]*(\w+)", line)[1] for line in capsys.readouterr().out.splitlines() if re.match(r"[\s:|]*\+- ", line)]
    steps = [s for s in steps if s != "Project"]
    assert "MapInArrow" in steps and ("MapInArrow", "MapInArrow") not in set(itertools.pairwise(steps))


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    from kiln.llm import minhash, rows, suffix_dedup
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(key), {}
    for module in (minhash, suffix_dedup):
        def keep(df, name, write=module.materialize):
            seen[name] = int(spark.conf.get(key))
            return write(df, name)
        monkeypatch.setattr(module, "materialize", keep)
    docs = spark.createDataFrame([(i, f"one text of some words {i}") for i in range(4)], "doc_id long, text string")
    assert near_duplicates(docs).count() == repeat_digests(docs).count() == 4
    texts = ("signatures", "candidate-sets", "hub-links", "repeated-grams", "repeated-segments")
    assert {seen[name] for name in texts} == {rows.TEXTS_A_BATCH} and spark.conf.get(key) == before


def test_a_task_gives_back_what_it_leaves():
    import gc
    import weakref

    from kiln.llm.memo import tidied
    left = []

    class Model:
        pass

    @tidied
    def run(batches):
        model = Model()
        model.own = model  # held in a circle
        left.append(weakref.ref(model))
        yield from batches

    gc.disable()
    try:
        assert list(run(iter([1, 2]))) == [1, 2] and left[0]() is None
        early = run(iter([1, 2]))
        assert next(early) == 1 and left[1]() is not None
        early.close()
        assert left[1]() is None
    finally:
        gc.enable()
