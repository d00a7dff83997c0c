"""Streams: rare names with corrections, a model with retries, chat state."""
import os
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from kiln.operators import curation as C
from kiln.operators import model as M
from kiln.operators.retrieval import chat_history
from kiln.session import scratch_path
from kiln.streaming import names as N
from kiln.streaming import predictions as P
from kiln.streaming import streams as ST


def folders(spark, name):
    base = scratch_path(spark, name)
    return [os.path.join(base, x) for x in ("in", "out", "retry", "ckpt")]


def test_rare_names_in_five_arrivals(spark):
    """After each arrival the flags are those of the batch rule on what has
    come so far; words that become common take flags back."""
    rng = random.Random(3)
    forms = [f"Na{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40)]
    rows = [(i, " ".join(["the", rng.choice(forms), "and", rng.choice(forms), rng.choice([".", ",", "so"]), rng.choice(forms)])) for i in range(60)]
    rows += [(100, None), (101, "met Once. Once only"), (102, "plain")]
    rng.shuffle(rows)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    src, out, _, ckpt = folders(spark, "test-names")
    seen, taken_back = [], 0
    for i in range(5):
        part = rows[i::5]
        spark.createDataFrame(part, d.schema).coalesce(2).write.mode("append").parquet(src)
        N.stream_rare_names(spark, src, d.schema, out, ckpt, files_per_batch=2)
        seen += part
        expected = {r.doc_id for r in C.unusual_name_ids(spark.createDataFrame(seen, d.schema), "doc_id", "text").collect()}
        assert {r.doc_id for r in N.rare_name_ids(spark, out, d.schema["doc_id"]).collect()} == expected
    taken_back = spark.read.parquet(out).where("delta < 0").count()
    assert taken_back > 10


def test_a_word_state_stays_small():
    n, ids, changes = N.merged(0, [], 1, [7], 2)
    assert (n, ids, changes) == (1, [7], [(7, 1)])
    assert N.merged(n, ids, 1, [8], 2) == (2, [7, 8], [(8, 1)])
    assert N.merged(2, [7, 8], 10**9, [9], 2) == (10**9 + 2, [], [(7, -1), (8, -1)])
    assert N.merged(10**9, [], 1, [5], 2) == (10**9 + 1, [], [])


def test_words_are_counted_before_the_shuffle(spark, monkeypatch):
    feat = spark.createDataFrame([(i, ["Common", f"W{i}"], ["Common"]) for i in range(50)], "doc_id long, _caps array<string>, _cands array<string>").coalesce(1)
    found = {r.word: (r.n, len(r.ids)) for r in N.word_counts(feat, "doc_id", 2).collect()}
    assert found["Common"] == (50, 3) and found["W7"] == (1, 0) and len(found) == 51


def test_settings_come_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with pytest.raises(ValueError), N.rocksdb(spark):
        raise ValueError
    assert spark.conf.get(key, None) == before


def test_the_model_in_a_stream_asks_no_row_twice(spark, tmp_path):
    """Killed after some micro-batches, restarted, then failed rows again."""
    asked = tmp_path / "asked"
    src, out, retry, ckpt = folders(spark, "test-model")
    d = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("c").alias("category"), F.concat(F.lit("question "), "id").alias("question"), F.lit("").alias("answer"))
    for i in range(8):
        d.where(F.pmod("doc_id", F.lit(8)) == i).coalesce(1).write.mode("append").parquet(src)

    class Killed(BaseException):
        pass

    def model(die, fail):
        def predict(prompts):
            ids = [int(p.split("Question: question ")[1].split("\n")[0]) for p in prompts]
            if die in ids:
                raise Killed
            with open(asked, "a") as f:
                f.writelines(f"{i}\n" for i in ids)
            if fail in ids:
                raise RuntimeError("down")
            return M.rule_predictor(prompts)
        return predict

    run = lambda **how: P.stream_predictions(spark, src, d.schema, out, retry, ckpt, predict=model(**how))
    with pytest.raises(Exception):
        run(die=13, fail=None)
    bad = max(set(range(40)) - {int(x) for x in asked.read_text().split()})  # not asked before the kill
    run(die=None, fail=bad)
    told = [int(x) for x in asked.read_text().split()]
    assert sorted(told) == list(range(40))  # each once, the killed run's too
    first = {r.doc_id: r for r in P.read_predictions(spark, out, d.schema).collect()}
    lost = {i for i, r in first.items() if r.error}
    assert len(first) == 40 and bad in lost and all(first[i].llm_has_numbers is None for i in lost) and all(first[i].llm_has_numbers for i in set(first) - lost)
    run(die=None, fail=None)  # the retry folder is input now
    told = [int(x) for x in asked.read_text().split()]
    assert sorted(told) == sorted([*range(40), *lost])
    final = P.read_predictions(spark, out, d.schema).collect()
    assert len(final) == 40 and all(r.llm_has_numbers and r.error is None for r in final)
    run(die=None, fail=None)
    assert len(asked.read_text().split()) == 40 + len(lost)  # nothing left to ask


class Turns(list):
    """List state that counts what is written."""

    written = 0

    def get(self):
        return iter(list(self))

    def appendList(self, rows):  # noqa: N802
        self.written += len(rows)
        self.extend(rows)


def test_a_turn_is_one_write_whatever_came_before():
    state = Turns()
    p = ST.ChatHistory()
    p.init(SimpleNamespace(getListState=lambda *a: state))
    for t in range(200):
        (out,) = p.handleInputRows((5,), iter([pd.DataFrame([(t, "user", f"m{t}")], columns=["turn", "role", "text"])]), None)
        assert state.written == t + 1 and len(out) == 1 and out.n_messages[0] == t + 1
    (late,) = p.handleInputRows((5,), iter([pd.DataFrame([(100, "user", "late")], columns=["turn", "role", "text"])]), None)
    assert state.written == 201 and sorted(set(late.turn)) == list(range(100, 200))


def test_finished_conversations_are_dropped(spark):
    """With an expiry, a turn after it begins a new history."""
    src, out, _, ckpt = folders(spark, "test-expiry")
    schema = "conv_id long, turn long, role string, text string"
    for turn in range(3):
        d = spark.createDataFrame([(1, turn, "user", f"m{turn}"), (2, turn, "user", f"n{turn}")], schema)
        d.coalesce(1).write.mode("append").parquet(src)
        ST.stream_chat_history(spark, src, d.schema, out, ckpt, None, idle_ms=1 if turn == 0 else 10**9)
    found = {(r.conv_id, r.turn): r.text.count("<|im_start|>") for r in ST.read_chat_history(spark, out).collect()}
    assert found[1, 0] == 1 and found[1, 2] == 2 or found[1, 2] == 3
    whole = spark.read.parquet(src)
    assert chat_history(whole).count() == len(found) == 6
