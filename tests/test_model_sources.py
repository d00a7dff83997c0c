"""Model application (batch failure semantics, resume), sources, streams."""
import os
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kiln.operators import curation as C
from kiln.operators import model as M
from kiln.session import scratch_path
from kiln.sources import files as S
from kiln.streaming import streams as ST


def records(spark, n=12):
    rows = [(i, "cat", f"question {i}" if i % 2 else "ünïcode words", "") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, category string, question string, answer string")


def test_rule_predictor_through_parse(spark):
    recs = records(spark).unionByName(spark.createDataFrame([(50, "c", "went to Paris", "")], records(spark).schema))
    out = {r["doc_id"]: tuple(r)[1:4] for r in M.classify_with_model(recs, "doc_id").collect()}
    assert out[1] == (True, False, False)
    assert out[2] == (False, True, False)
    assert out[50] == (False, False, True)


def test_failed_batch_nulls_every_row_of_it(spark):
    def flaky(prompts):
        if any("question 5" in p for p in prompts):
            raise RuntimeError("model down")
        return M.rule_predictor(prompts)

    recs = records(spark).coalesce(1).orderBy("doc_id")
    out = M.classify_with_model(recs, "doc_id", flaky, batch_size=4).collect()
    failed = sorted(r["doc_id"] for r in out if r["llm_has_numbers"] is None)
    assert failed == [4, 5, 6, 7]  # the whole batch holding row 5
    assert {r["error"] for r in out if r["doc_id"] in failed} == {"RuntimeError: model down"}


def test_resume_classifies_only_new_rows(spark):
    path = scratch_path(spark, "test-resume")
    recs = records(spark)
    assert M.classify_resume(recs.where(F.col("doc_id") < 5), "doc_id", path).count() == 5
    final = M.classify_resume(recs, "doc_id", path)
    # 12 rows and 12 distinct ids: the first five were not classified again
    assert final.count() == 12 and spark.read.parquet(path).count() == 12


def test_a_killed_run_keeps_its_slices_and_failed_rows_are_asked_again(spark, tmp_path):
    path, asked = scratch_path(spark, "test-kill"), tmp_path / "asked"
    recs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("c").alias("category"), F.concat(F.lit("question "), "id").alias("question"), F.lit("").alias("answer"))

    class Killed(BaseException):
        pass

    def dies(prompts):
        if any("question 17\n" in p for p in prompts):
            raise Killed
        return M.rule_predictor(prompts)

    with pytest.raises(Exception):
        M.classify_resume(recs, "doc_id", path, dies, slices=8)
    kept = {r.doc_id for r in spark.read.parquet(path).collect()}
    assert 0 < len(kept) < 40 and 17 not in kept

    def fails(prompts):
        with open(asked, "a") as f:
            f.writelines(p.split("Question: ")[1].split("\n")[0] + "\n" for p in prompts)
        if any("question 17\n" in p for p in prompts):
            raise RuntimeError("down")
        return M.rule_predictor(prompts)

    half = {r.doc_id: r.llm_has_numbers for r in M.classify_resume(recs, "doc_id", path, fails, slices=8).collect()}
    assert len(half) == 40 and half[17] is None
    assert {int(line.split()[1]) for line in asked.read_text().splitlines()} == set(range(40)) - kept  # only the rest
    whole = M.classify_resume(recs, "doc_id", path)
    assert whole.count() == 40 and whole.where("llm_has_numbers").count() == 40


def test_missing_csv_gives_empty_frame(spark):
    df = S.read_claims_csv(spark, f"/tmp/does-not-exist-{uuid.uuid4().hex}.csv")
    assert df.columns == ["id", "target"] and df.count() == 0


def test_missing_json_raises(spark):
    with pytest.raises(AnalysisException):
        S.read_questions(spark, f"/tmp/does-not-exist-{uuid.uuid4().hex}.json").count()


def test_json_array_file_and_clean(spark, tmp_path):
    p = tmp_path / "q.json"
    p.write_text('[{"category": " \\u3000History\\t", "question": "Q ", "value": null, "show_number": 12},'
                 ' {"category": "Art", "answer": " A", "llm_has_numbers": true}]', encoding="utf-8")
    df = C.clean_records(S.read_questions(spark, str(p), multi_line=True))
    rows = [r.asDict() for r in df.collect()]
    assert rows[0]["category"] == "History" and rows[0]["show_number"] == "12" and rows[0]["value"] is None
    assert rows[1]["answer"] == "A" and rows[1]["question"] == "" and "llm_has_numbers" not in df.columns


def test_stream_restart_processes_only_new_files(spark):
    base = scratch_path(spark, "test-stream")
    src, out, ckpt = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    d = spark.createDataFrame([(i, f"text {i}" if i % 3 else "plain") for i in range(20)], "doc_id long, text string")
    d.where("doc_id < 10").write.parquet(src)
    ST.stream_classify(spark, src, d.schema, out, ckpt)
    assert ST.read_classified(spark, out, d.schema["doc_id"]).count() == 10
    d.where("doc_id >= 10").write.mode("append").parquet(src)
    ST.stream_classify(spark, src, d.schema, out, ckpt)
    res = ST.read_classified(spark, out, d.schema["doc_id"])
    assert res.count() == 20 and res.select("doc_id").distinct().count() == 20


def test_late_turns_correct_the_history(spark):
    base = scratch_path(spark, "test-late")
    src, out, ckpt = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    turns = spark.createDataFrame([(1, t, "user", f"m{t}") for t in range(4)], "conv_id long, turn long, role string, text string")
    for part in ("turn IN (0, 3)", "turn = 1", "turn = 2"):
        turns.where(part).write.mode("append").parquet(src)
        ST.stream_chat_history(spark, src, turns.schema, out, ckpt, None)
    from kiln.operators.retrieval import chat_history
    assert sorted(map(tuple, ST.read_chat_history(spark, out).collect())) == sorted(map(tuple, chat_history(turns).select("conv_id", "turn", "text").collect()))


def test_json_sink_keeps_nulls(spark):
    path = scratch_path(spark, "test-json")
    S.write_json(spark.createDataFrame([(1, None)], "a int, value string"), path)
    assert spark.read.json(path).columns == ["a", "value"]


def test_labelled_images(spark, tmp_path):
    import struct
    import zlib
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 2, 1, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0" + bytes(6))) + chunk(b"IEND", b"")
    for label in ("cat", "dog"):
        (tmp_path / label).mkdir()
        (tmp_path / label / "1.png").write_bytes(png)
    (tmp_path / "dog" / "bad.png").write_bytes(b"no image")
    rows = S.read_labelled_images(spark, str(tmp_path)).collect()
    assert sorted((r.label, r.height, r.width) for r in rows) == [("cat", 1, 2), ("dog", 1, 2)]
    # the image side of the embedding step: a caller's encoder on the pixels
    sizes = []

    def encode(images):
        sizes.append(len(images))
        return [[len(i), sum(i)] for i in images]

    from kiln.operators import retrieval as R
    found = R.embed_with(S.read_labelled_images(spark, str(tmp_path)), "data", encode, batch_size=1)
    images = R.image_vectors(found.withColumn("i", F.lit(0)).withColumn("page", F.lit(1)), "i", "origin", "page", "i", "embedding")
    assert sorted(tuple(r.embedding) for r in images.collect()) == [(6.0, 0.0), (6.0, 0.0)]
    texts = spark.createDataFrame([("abc", 1), (None, 2)], "text string, n int")
    assert sorted(map(repr, R.embed_with(texts, "text", lambda ts: [[len(t)] for t in ts]).collect())) == ["Row(text='abc', n=1, embedding=[3.0])", "Row(text=None, n=2, embedding=None)"]


def test_number_words_of_four_languages(spark):
    texts = {"sixty years": True, "ninety men": True, "fünf Hunde": True, "thirteen": True, "dieciséis días": True, "quarante-deux": True,
             "a stone": False, "often done": False, "7up": True, "Zwölf!": True, "eleventh": False}
    rows = spark.createDataFrame(list(texts.items()), "t string, want boolean")
    assert rows.where(C.rule_has_numbers(F.col("t")) != F.col("want")).count() == 0
