"""Row numbers when a later scan of the input is split otherwise."""

import random

import pytest

from kiln.llm.exact_dedup import exact_dedup
from kiln.llm.langid import in_known_language
from kiln.llm.minhash import near_dedup, near_duplicates
from kiln.llm.suffix_dedup import cut_repeats, repeat_digests


@pytest.fixture
def resplit(spark, monkeypatch):
    """After each of the next writes scans have one partition, or one a file."""
    key, writer = "spark.sql.files.minPartitionNum", type(spark.range(0).write)
    write = writer.parquet

    left = []

    def then_resplit(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        if left:
            left.pop()
            spark.conf.unset(key) if spark.conf.get(key, None) else spark.conf.set(key, "1")

    def begin(times):
        left.extend(range(times))
        monkeypatch.setattr(writer, "parquet", then_resplit)

    yield begin
    spark.conf.unset(key)


def documents(spark, path):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = " ".join(word() for _ in range(60))
    rows = []
    for i in range(60):
        own = " ".join(word() for _ in range(40 + i))
        rows += [(i, own, "en"), (100 + i, own.upper(), "en"), (200 + i, f"{own} {word()}", "en"), (300 + i, f"{word()} {passage} {word()}", "en"), (400 + i, "12 34", None)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("job, times", [(exact_dedup, 99), (near_dedup, 99), (lambda d: near_duplicates(d).drop("row", "keep_row"), 1),
                                        (cut_repeats, 99), (repeat_digests, 99), (in_known_language, 99)],
                         ids=["exact_dedup", "near_dedup", "near_duplicates", "cut_repeats", "repeat_digests", "in_known_language"])
def test_rows_keep_their_numbers(spark, tmp_path, resplit, job, times):
    docs = documents(spark, str(tmp_path / "d"))
    expected = sorted(map(tuple, job(docs).collect()), key=repr)
    resplit(times)
    assert sorted(map(tuple, job(docs).collect()), key=repr) == expected
