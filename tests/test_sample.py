"""Stratified sample: FIXTURES 1.7 cases, the rule as a sort key on random
tables, its properties, and independence from the partition count."""
import random

import pytest
from pyspark.sql import functions as F

from kiln.operators.curation import head_per_stratum, sample_exact, stratified_sample


def expected(rows, n):
    """The ids that one sort of all rows puts first.  A row's sort key is
    (-1, id) where everything fits; (0, stratum's first id, rank) if its rank
    in its stratum is within the quota; else (1, id), unless its value is
    among the rows already taken."""
    total = len(rows)
    per = {s: sorted(r[0] for r in rows if r[1] == s) for s in {r[1] for r in rows}}
    rank = {i: k for ids in per.values() for k, i in enumerate(ids)}
    quota = {s: max(1, n * len(ids) // total) for s, ids in per.items()}
    first = sorted((per[s][0], rank[i], i, (s, v)) for i, s, v in rows if rank[i] < quota[s])[:n]
    taken = {value for *_, value in first}
    keys = [(0, f, r, i) for f, r, i, _ in first] + [(1, i, 0, i) for i, s, v in rows if (s, v) not in taken]
    if total <= n:
        keys = [(-1, i, 0, i) for i, *_ in rows]
    return sorted(k[-1] for k in sorted(keys)[:n])


def run(spark, rows, n, parts=3):
    df = spark.createDataFrame(rows, "id long, s string, v string").repartition(parts)
    out = stratified_sample(df, n, "s", "id", ["s", "v"]).collect()
    return sorted(r["id"] for r in out)


def test_small(spark):
    rows = [(1, "a", "x"), (2, "b", "y"), (3, "a", "z")]
    assert run(spark, rows, 5) == [1, 2, 3]


def test_exact(spark):
    rows = [(i, "a", f"a{i}") for i in range(1, 7)] + [(i, "b", f"b{i}") for i in range(7, 11)]
    assert run(spark, rows, 5) == [1, 2, 3, 7, 8]


def test_overflow_keeps_first_strata(spark):
    rows = [(i, f"s{i}", "v") for i in range(1, 7)]
    assert run(spark, rows, 4) == [1, 2, 3, 4]


def test_underflow_fills_in_input_order(spark):
    rows = ([(i, "a", f"a{i}") for i in range(1, 6)] + [(i, "b", f"b{i}") for i in range(6, 9)]
            + [(i, "c", f"c{i}") for i in range(9, 12)])
    assert run(spark, rows, 5) == [1, 2, 3, 6, 9]


def test_duplicates_not_added(spark):
    # fill candidates equal by value to sampled rows are skipped
    rows = [(1, "a", "x"), (2, "a", "x"), (3, "a", "x"), (4, "a", "x"), (5, "a", "x"),
            (6, "b", "y"), (7, "b", "y"), (8, "b", "y"), (9, "c", "z"), (10, "c", "z"), (11, "c", "z")]
    assert run(spark, rows, 5) == expected(rows, 5) == [1, 2, 6, 9]


def test_null_stratum_is_its_own(spark):
    rows = [(1, None, "a"), (2, None, "b"), (3, "x", "c"), (4, "x", "d"), (5, None, "e"), (6, "y", "f")]
    assert run(spark, rows, 3) == expected(rows, 3)


@pytest.mark.parametrize("seed", range(12))
def test_random_tables_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    m = rnd.randint(1, 60)
    strata = [None, "a", "b", "c", "d", "e"][: rnd.randint(1, 6)]
    rows = [(i, rnd.choice(strata), rnd.choice("pqrst")) for i in range(1, m + 1)]
    n = rnd.randint(1, 30)
    assert run(spark, rows, n, parts=rnd.randint(1, 7)) == expected(rows, n)


def test_groups_are_independent(spark):
    rows = [(i, "a" if i % 3 else "b", str(i), "g1" if i <= 20 else "g2") for i in range(1, 41)]
    df = spark.createDataFrame(rows, "id long, s string, v string, g string")
    out = stratified_sample(df, 7, "s", "id", ["s", "v"], groups=["g"]).collect()
    for g, sub in (("g1", rows[:20]), ("g2", rows[20:])):
        got = sorted(r["id"] for r in out if r["g"] == g)
        assert got == expected([(r[0], r[1], r[2]) for r in sub], 7)


def test_partition_count_does_not_matter(spark):
    rows = [(i, random.Random(i).choice("abc"), str(i % 7)) for i in range(1, 301)]
    assert run(spark, rows, 40, parts=1) == run(spark, rows, 40, parts=7)


def test_head_per_stratum_uses_group_limit(spark):
    df = spark.range(1, 101).select(F.col("id"), (F.col("id") % 3).cast("string").alias("s"))
    plan = head_per_stratum(df, 10, "s", "id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_sample_exact_size_and_plan(spark):
    df = spark.range(0, 500).withColumnRenamed("id", "doc_id")
    s = sample_exact(df, 37, "doc_id", 42)
    assert s.count() == 37
    assert "TakeOrderedAndProject" in s._jdf.queryExecution().executedPlan().toString()
    again = sample_exact(df.repartition(5), 37, "doc_id", 42)
    assert sorted(r[0] for r in s.collect()) == sorted(r[0] for r in again.collect())


def test_asking_for_too_many_is_an_error(spark):
    with pytest.raises(ValueError):
        sample_exact(spark.range(5).withColumnRenamed("id", "doc_id"), 6, "doc_id")


@pytest.mark.parametrize("n", [1, 10, 33])
def test_proportional_shares(spark, n):
    rows = [(i, "a" if i % 10 < 7 else "b" if i % 10 < 9 else None, str(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, s string, v string").repartition(3)
    out = stratified_sample(df, n, "s", "id", mode="proportional").collect()
    share = {s: sum(r["s"] == s for r in out) for s in ("a", "b", None)}
    assert len(out) == len({r["id"] for r in out}) == n
    assert all(abs(share[s] - n * f) < 1 for s, f in (("a", 0.7), ("b", 0.2), (None, 0.1)))
    assert stratified_sample(df, 500, "s", "id", mode="proportional").count() == 200
    with pytest.raises(ValueError):
        stratified_sample(df, 5, "s", "id", mode="largest")


def test_no_window_over_one_key_holds_all_rows(spark):
    df = spark.range(1, 101).select(F.col("id"), (F.col("id") % 3).cast("string").alias("s"), F.lit("x").alias("big"))
    plan = stratified_sample(df, 10, "s", "id")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:  # rows are limited before they are sorted for a window, and before each exchange
            below = next(x for x in lines[i + 1:] if any(k in x for k in ("GroupLimit", "TakeOrdered", "Exchange", "Range")))
            assert "GroupLimit" in below or "TakeOrdered" in below
    assert "GroupLimit" in plan and "CartesianProduct" not in plan
