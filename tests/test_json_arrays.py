"""Files of one JSON array each are bounded, whatever the ids are."""

import json
import os

from pyspark.sql import functions as F

from kiln.plans import stream_queries
from kiln.sources import arrays
from kiln.sources import files as S


def held(path):
    names = [os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-")]
    return [(os.path.getsize(f), json.load(open(f, encoding="utf-8"))) for f in names]


def test_arrays_are_bounded_and_whole(spark, tmp_path):
    texts = [f"é {i}\n" + "x" * (i % 7 * 20) for i in range(200)] + ["y" * 3000]
    rows = spark.createDataFrame([(t,) for t in texts], "question string").coalesce(2)
    path = str(tmp_path / "a")
    S.write_json_arrays(rows.select(F.to_json(F.struct("question")).alias("value")), path, max_rows=20, max_bytes=1000)
    files = held(path)
    assert all(len(a) == 1 or len(a) <= 20 and size <= 1001 for size, a in files)  # and a newline
    assert sorted(x["question"] for _, a in files for x in a) == sorted(texts)
    assert sorted(r.question for r in S.read_questions(spark, path, multi_line=True).collect()) == sorted(texts)


NASTY = ['}', '{"a": [', '\\"}', '\\\\', '"', '[]{}', "\n}\n", "é}ü", "\\\\\"}{", "", "x" * 90 + "}" * 9]


def test_one_array_in_ranges(spark, tmp_path):
    """Cut at every place by ranges and chunks of a few bytes: the same rows as
    the one-task read."""
    rows = [{"category": NASTY[i % len(NASTY)], "question": NASTY[i * 7 % len(NASTY)] * (i % 3), "answer": None if i % 5 else f"a{i}", "more": {"deep": [{"q": NASTY[i % 4]}]}} for i in range(60)]
    texts = [json.dumps(rows), json.dumps(rows[:7], indent=3, ensure_ascii=False), "[]", " [ {} ,\n{\"question\": \"}\"}]\n"]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
    path, schema = str(tmp_path), S.QUESTION_SCHEMA
    one = S.read_questions(spark, path, multi_line=True).where("coalesce(category, question, answer) IS NOT NULL")
    expected = sorted(map(repr, one.collect()))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size, chunk in (("4000", 200), ("3000", 1)):
            spark.conf.set(key, size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            found = arrays.read_array(spark, path, schema, chunk_bytes=chunk)
            assert sorted(map(repr, found.where("coalesce(category, question, answer) IS NOT NULL").collect())) == expected
            assert len(found.where("category IS NULL AND question IS NULL AND answer IS NULL").collect()) == 1  # {}
        scan = spark.read.option("lineSep", "}").text(str(tmp_path / "0.json"))
        assert scan.rdd.getNumPartitions() > 2  # one file, several tasks
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_elements_that_are_no_objects_are_left_out(spark, tmp_path):
    (tmp_path / "0.json").write_text(json.dumps([1, "}", [{"x": 1}], {"question": "}{"}, None, [], "{"]), encoding="utf-8")
    for chunk in (1, 1000):
        assert [r.question for r in arrays.read_array(spark, str(tmp_path), S.QUESTION_SCHEMA, chunk).collect()] == ["}{"]


def test_states_at_any_cut():
    """Whole objects and parts from cuts behind every closing brace."""
    rows = [{"a": NASTY[i % len(NASTY)], "b": [NASTY[i * 3 % len(NASTY)], {"c": "}"}]} for i in range(40)]
    text = json.dumps(rows)
    pieces = [p + "}" for p in text.split("}")]
    for width in (1, 2, 5, 1000):
        chunks = ["".join(pieces[i:i + width]) for i in range(0, len(pieces), width)]
        inside, level, found, open_ = False, 0, [], ""
        for chunk in chunks:
            head, whole, tail = arrays.cut(chunk, inside, level)
            if head is not None:
                open_ += head
            if open_ and (whole or tail is not None or arrays.depth(chunk, inside) + level <= 1):
                found.append(open_)
                open_ = ""
            found += whole
            open_ = tail if tail is not None else open_
            level += arrays.depth(chunk, inside)
            inside ^= arrays.quotes(chunk) % 2 == 1
        assert [json.loads(f) for f in found] == rows


def test_one_id_on_all_rows(spark, tmp_path, monkeypatch):
    docs = spark.range(30).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    read = S.read_questions
    monkeypatch.setattr(S, "read_questions", lambda spark, path, **kw: (seen.append(path), read(spark, path, **kw))[1])
    out = stream_queries.scan_json_questions(spark, str(tmp_path))
    assert sorted(r.question for r in out.collect()) == sorted(f"t{i}" for i in range(30))
    assert len(held(seen[0].removeprefix("file://"))) > 1  # not one value for all rows of one id
