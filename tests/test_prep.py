"""Splits, row rendering, tokens and padding, metrics."""
from pyspark.sql import functions as F

from kiln.operators import prep as P


def test_split_sizes_and_disjoint(spark):
    df = spark.range(1000).withColumnRenamed("id", "rid")
    s = P.assign_split(df, ["rid"], 42, 0.3, nested=0.3)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 700, "validation": 210, "test": 90}
    assert s.select("rid").distinct().count() == 1000
    again = P.assign_split(df.repartition(7), ["rid"], 42, 0.3, nested=0.3)
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, again.collect()))


def test_cut_rows_are_those_of_the_order(spark):
    df = spark.range(300).withColumnRenamed("id", "rid")
    n, cuts = P.cut_rows(df, ["rid"], 7, lambda m: [1, 150, 300, 0, 301])
    ordered = sorted(map(tuple, df.select(P._order_value(7, ["rid"]).alias("u"), "rid").collect()))
    assert n == 300 and cuts == [ordered[0], ordered[149], ordered[299], None, None]


def test_radix_selection_narrows_until_few_rows_are_left(spark, monkeypatch):
    """With three bits a pass the same rows; what is sorted stays small."""
    df = spark.range(400).withColumnRenamed("id", "count").repartition(3)
    ordered = sorted(map(tuple, df.select(P._order_value(3, ["count"]).alias("u"), "count").collect()))
    monkeypatch.setattr(P, "DIGIT_BITS", 3)
    for most in (1, 5, 1000):
        monkeypatch.setattr(P, "SORTED_ROWS", most)
        n, cuts = P.cut_rows(df, ["count"], 3, lambda m: [1, 7, 7, 200, 399, 400])
        assert n == 400 and cuts == [ordered[i - 1] for i in (1, 7, 7, 200, 399, 400)]
    # a key that very many rows repeat is counted, not sorted
    many = df.withColumn("count", F.when(F.col("count") < 300, F.lit(5)).otherwise(F.col("count")))
    monkeypatch.setattr(P, "SORTED_ROWS", 10)
    ordered = sorted(map(tuple, many.select(P._order_value(3, ["count"]).alias("u"), "count").collect()))
    _, cuts = P.cut_rows(many, ["count"], 3, lambda m: list(range(1, 401, 57)))
    assert cuts == [ordered[i - 1] for i in range(1, 401, 57)]


def test_split_of_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None,)] * 3 + [(i % 20,) for i in range(40)], "rid long")
    s = P.assign_split(df, ["rid"], 42, 0.3)
    assert s.count() == 43 and s.where("split IS NULL").count() == 0
    assert s.distinct().count() == 21  # equal ids are on one side
    assert P.assign_split(df.limit(0), ["rid"]).count() == 0


def test_row_to_text_fixture(spark):
    df = spark.createDataFrame([(1, 1, None, 2.5)], "id long, a int, b double, c double")
    row = P.row_to_text(df).first()
    assert row["text"] == P.CLAIM_PROMPT + " The client attributes are: a: 1.0, b: NaN, c: 2.5."
    assert row["label"] is None


def test_label_maps(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "label int")
    names = [r[0] for r in df.select(P.map_label_names(F.col("label"))).collect()]
    assert names == ["NO_CLAIM", "CLAIM_FILED", None]
    idx = P.build_label_index(spark.createDataFrame([("b",), ("a",), ("b",)], "n string"), "n")
    assert sorted(map(tuple, idx.collect())) == [("a", 0), ("b", 1)]


def test_argmax_first_maximum(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9],), ([2.0, 1.0, 0.0],)], "logits array<double>")
    assert [r[0] for r in df.select(P.argmax(F.col("logits"))).collect()] == [1, 0]


def test_special_tokens_and_round_trip(spark):
    texts = ["<|im_start|>user\nHi there<|im_end|>\n", "  <think>  ", "a <think>b</think> c<|foo|>"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "rid long, text string")
    toks = {r["rid"]: r["t"] for r in df.select("rid", P.token_pieces(F.col("text")).alias("t")).collect()}
    assert toks[0][:3] == ["<|im_start|>", "user", "\nHi"] and toks[0][-2:] == ["<|im_end|>", "\n"]
    assert toks[1] == ["<think>"]
    assert "".join(toks[2]) == texts[2] and "<|foo|>" in toks[2]
    rows = df.select("rid", F.posexplode(P.token_pieces(F.col("text"))).alias("pos", "token"))
    vocab = P.build_vocabulary(rows, "token")
    assert sorted(r.id for r in vocab.collect()) == list(range(vocab.count()))
    enc = P.encode_long(rows, vocab)
    assert enc.where(F.col("token") == "<|im_start|>").select("id").first()[0] == 1
    dec = P.decode_long(enc.select("rid", "pos", F.col("token").alias("orig"), "id"), vocab)
    assert dec.where(F.col("token") != F.col("orig")).count() == 0
    # tokens that a vocabulary from elsewhere lacks
    other = P.build_vocabulary(rows.where("rid = 1"), "token")
    unknown = P.decode_long(P.encode_long(rows, other).select("rid", "pos", "id"), other)
    assert unknown.where(F.col("token") == P.UNK).where("id = -1").count() > 0


def test_padding_right_and_left(spark):
    df = spark.createDataFrame([(i, list(range(1, i + 2))) for i in range(5)], "k long, ids array<int>")
    b = P.assign_batches(df, ["k"], 2, 42)
    right = {r["k"]: r for r in P.truncate_pad(b, "ids", 3, 0).collect()}
    left = {r["k"]: r for r in P.truncate_pad(b, "ids", 3, 0, side="left").collect()}
    for k in range(5):
        r = right[k]
        assert len(r["input_ids"]) == r["padded_len"] == max(right[j]["n_tokens"] for j in right
                                                             if right[j]["batch"] == r["batch"])
        assert r["n_tokens"] == min(k + 1, 3)
        assert r["attention_mask"] == [1] * r["n_tokens"] + [0] * (r["padded_len"] - r["n_tokens"])
        assert left[k]["input_ids"][-left[k]["n_tokens"]:] == list(range(1, left[k]["n_tokens"] + 1))
    sizes = [r["n"] for r in P.collate_batches(P.truncate_pad(b, "ids", 3, 0)).collect()]
    assert sorted(sizes) == [1, 2, 2]
    assert max(r["n_tokens"] for r in P.truncate_pad(b, "ids", None, 0, side="left").collect()) == 5
