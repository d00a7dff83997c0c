"""What a task or a micro-batch takes at once."""
import json
import os

import pytest
from pyspark.sql import functions as F

from kiln.operators import model as M
from kiln.session import rows_a_batch, scratch_path
from kiln.sources import arrays
from kiln.sources import files as S
from kiln.streaming import names as N


def test_an_array_is_written_in_lines(spark, tmp_path):
    """Files of several megabytes in lines of at most one, whole arrays all the same."""
    texts = [f"{i} " + "x" * (400_000 if i % 9 else 2_500_000) for i in range(20)]
    rows = spark.createDataFrame([(t,) for t in texts], "question string").coalesce(1)
    path = str(tmp_path / "a")
    S.write_json_arrays(rows.select(F.to_json(F.struct("question")).alias("value")), path, max_rows=7, max_bytes=4 << 20)
    files = [os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-")]
    found = [json.load(open(f, encoding="utf-8")) for f in files]
    assert sorted(x["question"] for a in found for x in a) == sorted(texts) and max(map(len, found)) <= 7
    assert all(os.path.getsize(f) <= (4 << 20) + 4 for f in files) and len(files) < 10
    lines = [line for f in files for line in open(f, encoding="utf-8")]
    assert all(len(line) <= 1 << 20 or line.count('"question"') == 1 for line in lines) and len(lines) > len(files)
    read = arrays.read_array(spark, path, S.QUESTION_SCHEMA)
    assert sorted(r.question for r in read.collect()) == sorted(texts)


def test_chunks_come_two_at_a_time(spark, tmp_path, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, write = spark.conf.get(key), {}, arrays.materialize

    def keep(df, name):
        seen[name] = spark.conf.get(key)
        return write(df, name)

    monkeypatch.setattr(arrays, "materialize", keep)
    (tmp_path / "0.json").write_text(json.dumps([{"question": "q"}]), encoding="utf-8")
    assert arrays.read_array(spark, str(tmp_path), S.QUESTION_SCHEMA).count() == 1
    assert seen == {"array-chunks": "1024", "array-objects": "2"} and spark.conf.get(key) == before
    with pytest.raises(ValueError), rows_a_batch(spark, 3):
        raise ValueError
    assert spark.conf.get(key) == before


def test_many_small_files_are_one_micro_batch(spark):
    base = scratch_path(spark, "test-small-files")
    src, out, ckpt = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    d = spark.createDataFrame([(i, f"the Word{i} of") for i in range(12)], "doc_id long, text string")
    d.repartition(6).write.parquet(src)
    N.stream_rare_names(spark, src, d.schema, out, ckpt)
    assert len([f for f in os.listdir(f"{ckpt}/commits".removeprefix("file://")) if f.isdigit()]) == 1


def test_the_rules_of_the_stand_in():
    ask = lambda q: json.loads(M.rule_predictor([f"x\nQuestion: {q}\nAnswer: "])[0])
    for q in ("", "plain", "7", "٧", "²", "café", "€ 5", "the Name", "a\n中", "½", "\U0001d7d8"):
        found = ask(q)
        assert found["has_numbers"] == any(c.isdigit() and c.isascii() for c in q)
        assert found["has_non_english"] == any(ord(c) > 127 and c.isalpha() for c in q)


def test_a_token_is_hashed_once(monkeypatch):
    """Over many blocks of texts, with a bound on what is held."""
    import hashlib

    import pandas as pd

    from kiln.operators import retrieval as R

    asked, md5 = [], hashlib.md5
    monkeypatch.setattr(hashlib, "md5", lambda b: (asked.append(b), md5(b))[1])
    embed = R._hash_embedding_fn(8)
    texts = pd.Series(["one two two", None, "", "...", "three 4"] * 200)
    first = embed(texts)
    assert len(asked) == 4 and first[1] is None and not first[2].any() and all((first[i] == first[i % 5]).all() for i in range(5, 1000) if i % 5 != 1)
    monkeypatch.setattr(R, "HELD_TOKENS", 1)
    assert all(a is b is None or (a == b).all() for a, b in zip(first, R._hash_embedding_fn(8)(texts)))


def test_words_share_keys_of_the_state(spark):
    """A call of the state function for many words, not one each."""
    base = scratch_path(spark, "test-word-keys")
    src, out, ckpt = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    d = spark.createDataFrame([(i, "the " + " so ".join(f"W{i:02d}{j:03d}x" for j in range(300))) for i in range(40)], "doc_id long, text string")
    d.select("doc_id", F.regexp_replace("text", "[0-9]+", "$0").alias("text")).write.parquet(src)
    N.stream_rare_names(spark, src, d.schema, out, ckpt)
    spark.read.format("statestore").load(ckpt).createOrReplaceTempView("word_state")
    assert 0 < spark.table("word_state").count() <= N.WORD_BUCKETS < 40 * 300
