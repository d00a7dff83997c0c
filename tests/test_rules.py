"""Rules on texts: rare names against a plain search, their plan, and the
statistics of a run without one valid prediction."""
import random
import shutil
from collections import Counter

import regex
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kiln.functions.vectors import cosine_distance
from kiln.operators import curation as C
from kiln.plans import registry

registry.load_all()


def plain_unusual(rows, max_df=2):
    forms, cands = Counter(), {}
    for i, (_, text) in enumerate(rows):
        words, names, inside = set(), set(), False
        for event in regex.findall(r"[.!?\n]|\p{L}+", text or ""):
            if regex.match(r"\p{L}", event):
                if regex.match(r"\p{Lu}", event):
                    words.add(event)
                    names |= {event} if inside else set()
                inside = True
            else:
                inside = False
        forms.update(words)
        cands[i] = names
    return {row[0] for i, row in enumerate(rows) if any(forms[w] <= max_df for w in cands[i])}


def test_rare_names_equal_a_plain_search(spark):
    rng = random.Random(4)
    parts = ["Ana", "Bo", "Éva", "the", "a", "Zed", "Ärzte", "x1Y", "A", ". ", "! ", "\n", " ", ", ", " - ", "2 ", "'", "日本", "ǅo", "'s "]
    rows = [(i, "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 14)))) for i in range(400)]
    rows += [(500 + i, f"a Name{i % 200}x here") for i in range(400)] + [(1000, None), (1001, ""), (None, "met Onlyonce there")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for max_df in (1, 2, 5):
        found = {r.doc_id for r in C.unusual_name_ids(df, "doc_id", "text", max_df).collect()}
        assert found == plain_unusual(rows, max_df)


def test_each_pattern_runs_once_a_text(spark):
    plan = registry.QUERIES["rule_unusual_names"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 2 and plan.count(C.CAPITALISED_WORD) == plan.count(C.NAME_CANDIDATE) == 1
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp" in line] and "lambda" not in plan


def test_foreign_words_need_no_accents(spark):
    """Unaccented French, German and Spanish is found, English is left alone."""
    rng = random.Random(8)
    words = {"en": "the and of house water with from which".split(), "fr": "les avec dans pour maison eau vous sont".split(),
             "de": "und der haus wasser mit von nicht sind".split(), "es": "los con casa agua para desde pero muy".split()}
    rows = [(i, " ".join(rng.choices(words[lang], k=6)) + " taxi", lang) for i, lang in enumerate(["en", "fr", "de", "es"] * 60)]
    rows += [(900, "avec les", None), (901, "the taxi", None), (902, None, "fr"), (903, "", "en"), (904, "AVEC!", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id for r in C.rule_foreign_ids(df, "doc_id", "text", "lang").collect()}
    assert found == {i for i, _, lang in rows[:240] if lang != "en"} | {900, 904}


def test_number_words_by_hand(spark):
    cases = {"one": True, "One day": True, "eleven": True, "onerous": False, "someone": False, "siebzehn": True, "une": False, "7": True, "tone": False, "": False, "dix-sept": True, "a hundred": True}
    df = spark.createDataFrame([(t, want) for t, want in cases.items()], "t string, want boolean")
    assert [r.t for r in df.where(C.rule_has_numbers(F.col("t")) != F.col("want")).collect()] == []


def test_statistics_without_a_valid_prediction(spark, tmp_path):
    """No document has a label, so every prediction counts as failed."""
    shutil.copy(f"{SF_SMALL}/documents.parquet", tmp_path / "documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    labels.limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    (row,) = registry.QUERIES["sink_stats"](spark, str(tmp_path)).collect()
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert (row.total, row.successful, row.failed) == (n, 0, n)
    assert row.numbers_classified_count is None and row.estimate_total_size is None
    empty = tmp_path / "empty"
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(0).write.parquet(str(empty / f"{name}.parquet"))
    (row,) = registry.QUERIES["sink_stats"](spark, str(empty)).collect()
    assert (row.total, row.successful) == (0, 0)


def test_distance_without_a_direction_is_null(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0]), ([3.0, 0.0], [2.0, 0.0])], "a array<float>, b array<float>")
    assert [r[0] for r in df.select(cosine_distance(F.col("a"), F.col("b"))).collect()] == [1.0, None, None, 0.0]


def test_a_new_slice_updates_the_sketched_profile_alone(spark, tmp_path):
    path = str(tmp_path / "profile")
    rows = lambda a, b: spark.range(a, b).selectExpr("concat('c', id % 90000) AS category", "id % 7 AS show")
    C.store_profile(rows(0, 60_000), path, "a", "category", "show")
    (one,) = C.sketched_profile(spark, path).collect()
    C.store_profile(rows(30_000, 120_000), path, "b", "category", "show")
    C.store_profile(rows(30_000, 120_000), path, "b", "category", "show")  # again: it replaces itself
    (both,) = C.sketched_profile(spark, path).collect()
    assert (one.total_questions, one.unique_shows, both.total_questions, both.unique_shows) == (60_000, 7, 150_000, 7)
    assert abs(one.unique_categories - 60_000) <= 0.025 * 60_000 and abs(both.unique_categories - 90_000) <= 0.025 * 90_000  # three standard errors
    C.store_profile(rows(0, 0), path, "empty", "category", "show")
    assert C.sketched_profile(spark, path).collect() == [both]
