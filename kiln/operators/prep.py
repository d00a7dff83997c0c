"""Training-data preparation: row rendering, label maps, exact-size seeded
splits, special-token splitting, vocabulary encode/decode, truncation and
padding per batch, and accuracy figures.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import py_strip, seeded_key
from .ranking import global_rank

# --------------------------------------------------------------------------
# Row -> instruction text
# --------------------------------------------------------------------------

# The instruction prompt and the attribute lead-in.
CLAIM_PROMPT = ("Assess the likelihood of an insurance claim being filed based on the following customer attributes. "
                "All attributes have been anonymized to protect data confidentiality. ")
ATTRIBUTES_LEAD = "The client attributes are: "
# Label names of the claim task.
ID2LABEL = {0: "NO_CLAIM", 1: "CLAIM_FILED"}


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("id", "target")) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def row_to_text(df: DataFrame, id_col: str = "id", target_col: str = "target",
                features: Sequence[str] | None = None, prompt: str = CLAIM_PROMPT) -> DataFrame:
    """(id, text, label): ``prompt + " " + "The client attributes are: c: v, ...."``.

    ``features`` comes from the *training* frame and is reused for scoring
    data.  As in a pandas row, a frame mixing integer and floating columns
    renders every value as floating (``1.0``); a missing value renders
    ``NaN``.  Without a target column the label is null."""
    feats = list(features) if features is not None else feature_columns(df, (id_col, target_col))
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    numeric = {"integer", "long", "short", "byte", "float", "double", "decimal"}
    all_num = all(types.get(c) in numeric for c in feats)
    any_float = any(types.get(c) in ("float", "double", "decimal") for c in feats)

    def val(c):
        x = F.col(c)
        if all_num and any_float:
            x = x.cast("double")
        return F.coalesce(x.cast("string"), F.lit("NaN"))

    body = F.concat_ws(", ", *[F.concat(F.lit(c + ": "), val(c)) for c in feats])
    text = F.concat(F.lit(prompt + " " + ATTRIBUTES_LEAD), body, F.lit("."))
    label = (F.expr(f"try_cast(`{target_col}` as int)") if target_col in df.columns
             else F.lit(None).cast("int"))
    return df.select(F.col(id_col), text.alias("text"), label.alias("label"))


def map_label_names(label: Column, id2label: dict | None = None) -> Column:
    m = id2label or ID2LABEL
    return F.element_at(F.create_map(*[x for k, v in sorted(m.items()) for x in (F.lit(k), F.lit(v))]), label)


def map_label_ids(name: Column, id2label: dict | None = None) -> Column:
    m = id2label or ID2LABEL
    return F.element_at(F.create_map(*[x for k, v in sorted(m.items()) for x in (F.lit(v), F.lit(k))]), name)


def build_label_index(df: DataFrame, name_col: str) -> DataFrame:
    """Label dictionary from class names in ascending order: (name, id).

    The names are made distinct with partial aggregation first and ranked
    range by range, so a dictionary of any size fits."""
    names = df.select(F.col(name_col).alias("name")).where(F.col("name").isNotNull()).distinct()
    return global_rank(names, ["name"], "_rank").select("name", (F.col("_rank") - 1).cast("int").alias("id"))


# --------------------------------------------------------------------------
# Exact-size seeded splits
# --------------------------------------------------------------------------

def _order_value(seed: int, id_cols: Sequence[str]) -> Column:
    """60-bit uniform integer from the seeded md5 key; a null id counts as
    the text ``\\N``."""
    ids = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in id_cols]
    return F.conv(F.substring(seeded_key(seed, *ids), 1, 15), 16, 10).cast("bigint")


#: Bits of the 60-bit key that one pass tells apart, and rows that a task sorts.
DIGIT_BITS, SORTED_ROWS = 16, 50_000


def cut_rows(df: DataFrame, id_cols: Sequence[str], seed: int, ranks_for_n):
    """(n, [(u, ids...) or None]): the rows at the given 1-based positions of
    the seeded order, without a global sort.

    ``ranks_for_n(n)`` turns the row count into positions.  Radix selection:
    a histogram of the key's next ``DIGIT_BITS`` bits (at most 65,536 counts a
    position) names the bucket that holds a position, and is taken again
    inside that bucket until it has at most ``SORTED_ROWS`` rows, which are
    sorted, or all bits are known.  All positions share the passes.  Rows that
    agree in all bits are counted by their ids, as only repeated ids do."""
    keyed = df.select(_order_value(seed, id_cols).alias("_u"), *id_cols)
    bits = 60

    def digit(rest: int) -> Column:
        return F.shiftright("_u", max(0, bits - rest - DIGIT_BITS))

    whole = sorted((r["_d"], r["count"]) for r in keyed.groupBy(digit(0).alias("_d")).count().collect())
    n = sum(c for _, c in whole)
    ranks = ranks_for_n(n)
    # a position that is not yet found: its bucket (prefix), the bits that are known and its place inside
    found: dict[int, tuple[int, int, int, int]] = {}

    def narrow(i: int, histogram: list[tuple[int, int]], place: int, known: int) -> None:
        for d, c in histogram:
            if place <= c:
                found[i] = (d, min(bits, known + DIGIT_BITS), place, c)
                return
            place -= c

    for i, rank in enumerate(ranks):
        if 0 < rank <= n:
            narrow(i, whole, rank, 0)
    while open_ := {i: f for i, f in found.items() if f[3] > SORTED_ROWS and f[1] < bits}:
        known = min(f[1] for f in open_.values())
        now = {i: f for i, f in open_.items() if f[1] == known}
        prefix = F.shiftright("_u", bits - known)
        deeper = keyed.where(prefix.isin(*{f[0] for f in now.values()})).groupBy(prefix.alias("_p"), digit(known).alias("_d")).count().collect()
        for i, (bucket, _, place, _) in now.items():
            narrow(i, sorted((r["_d"], r["count"]) for r in deeper if r["_p"] == bucket), place, known)
    cuts = []
    for i in range(len(ranks)):
        if i not in found:
            cuts.append(None)
            continue
        bucket, known, place, _ = found[i]
        rows = keyed.where(F.shiftright("_u", bits - known) == bucket).groupBy("_u", *id_cols).agg(F.count("*").alias("_n")).orderBy("_u", *id_cols)
        for row in rows.toLocalIterator():  # at most SORTED_ROWS rows, or ids that agree in 60 bits
            place -= row["_n"]
            if place <= 0:
                cuts.append(tuple(row)[:-1])
                break
    return n, cuts


def split_sizes(n: int, test_size: float = 0.3, nested: float | None = 0.3) -> tuple[int, int]:
    """(test rows, nested-test rows) as in a fraction-based train/test split:
    test = ceil(fraction * n)."""
    n_test = math.ceil(test_size * n) if n else 0
    n_test2 = math.ceil(nested * n_test) if (nested and n_test) else 0
    return n_test, n_test2


def assign_split(df: DataFrame, id_cols: Sequence[str], seed: int = 42, test_size: float = 0.3,
                 nested: float | None = None,
                 names: tuple[str, str, str] = ("train", "validation", "test")) -> DataFrame:
    """Adds ``split``.  Rows are ordered by md5('<seed>-' || ids); the first
    ceil(test_size * n) rows form the held-out part.  With ``nested`` that
    part is split again: its first ceil(nested * held-out) rows are
    ``test`` and the rest ``validation`` (a 70/21/9 split for 0.3/0.3);
    without it the held-out part is ``test``.  Rows that repeat their ids
    stay together, on the side of the first of them."""
    n, (c1, c2) = cut_rows(df, id_cols, seed, lambda m: split_sizes(m, test_size, nested))
    u = _order_value(seed, id_cols)
    types = [T.LongType()] + [df.schema[c].dataType for c in id_cols]
    names_ = ["_u"] + list(id_cols)
    key = F.struct(u.alias("_u"), *[F.col(c) for c in id_cols])

    def le(cut):
        if cut is None:
            return F.lit(False)
        lit = F.struct(*[F.lit(x).cast(t).alias(nm) for x, t, nm in zip(cut, types, names_)])
        return key <= lit

    if nested:
        split = F.when(le(c2), names[2]).when(le(c1), names[1]).otherwise(names[0])
    else:
        split = F.when(le(c1), names[2]).otherwise(names[0])
    return df.withColumn("split", split)


# --------------------------------------------------------------------------
# Special tokens, vocabulary, encode / decode
# --------------------------------------------------------------------------

# Control tokens in id order.
SPECIALS = ["<|endoftext|>", "<|im_start|>", "<|im_end|>", "<|object_ref_start|>", "<|object_ref_end|>",
            "<|box_start|>", "<|box_end|>", "<|quad_start|>", "<|quad_end|>", "<|vision_start|>",
            "<|vision_end|>", "<|vision_pad|>", "<|image_pad|>", "<|video_pad|>", "<think>", "</think>"]
SPECIAL_SPLIT = r"(<\|[^>]+?\|>|<think>|</think>)"
PIECE = r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+"
SEP = "\u0001"
UNK, UNK_ID = "<unk>", -1


def _specials_array() -> Column:
    return F.array(*[F.lit(s) for s in SPECIALS])


def special_parts(text: Column) -> Column:
    """Split around special-token-like markup, empty parts removed."""
    marked = F.regexp_replace(text, SPECIAL_SPLIT, SEP + "$1" + SEP)
    return F.filter(F.split(marked, SEP), lambda x: x != "")


def token_pieces(text: Column) -> Column:
    """Token strings of one text: specials whole, other text cut into
    whitespace-led pieces (concatenating the pieces gives the text back).
    A text that is exactly one special token maps to that token."""
    stripped = py_strip(text)
    whole = F.array_contains(_specials_array(), stripped) & ~F.instr(stripped, "\n").cast("boolean")
    pieces = F.flatten(F.transform(special_parts(text), lambda p: F.when(
        F.array_contains(_specials_array(), p), F.array(p)).otherwise(
        F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)))))
    return F.when(whole, F.array(stripped)).otherwise(pieces)


def build_vocabulary(token_rows: DataFrame, token_col: str = "token") -> DataFrame:
    """(token, id) of every token: specials get 0..15, all others 16.. by
    falling count, ties by token.  The counts aggregate partially; the ids
    come from ranges with offsets, so the vocabulary may be of any size."""
    counts = (token_rows.where(~F.array_contains(_specials_array(), F.col(token_col)))
              .groupBy(F.col(token_col).alias("token")).agg(F.count("*").alias("cnt")))
    ranked = global_rank(counts, [F.desc("cnt"), F.asc("token")], "_rank")
    spark = token_rows.sparkSession
    specials = spark.createDataFrame([(s, i) for i, s in enumerate(SPECIALS)], "token string, id int")
    return specials.unionByName(ranked.select("token", (F.col("_rank") + 15).cast("int").alias("id")))


def encode_long(token_rows: DataFrame, vocab: DataFrame, token_col: str = "token") -> DataFrame:
    """Adds ``id`` to exploded token rows; a token outside the vocabulary
    gets ``UNK_ID``.  A plain equi-join: Spark measures the vocabulary before
    it broadcasts, else both sides are shuffled and common tokens split."""
    v = vocab.select(F.col("token").alias("_vt"), F.col("id").alias("_vid"))
    return (token_rows.join(v, token_rows[token_col] == v["_vt"], "left")
            .withColumn("id", F.coalesce(F.col("_vid"), F.lit(UNK_ID)).cast("int")).drop("_vt", "_vid"))


def collect_ordered(df: DataFrame, keys: Sequence[str], pos: str, value: str, alias: str) -> DataFrame:
    """Ordered array per key (collect structs, sort by position)."""
    return (df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(pos, value))).alias("_s"))
            .select(*keys, F.transform("_s", lambda x: x[value]).alias(alias)))


def decode_long(id_rows: DataFrame, vocab: DataFrame, id_col: str = "id") -> DataFrame:
    """Adds ``token``; an id outside the vocabulary gives ``UNK``."""
    v = vocab.select(F.col("id").alias("_vid"), F.col("token").alias("_vt"))
    return (id_rows.join(v, id_rows[id_col] == v["_vid"], "left")
            .withColumn("token", F.coalesce(F.col("_vt"), F.lit(UNK))).drop("_vid", "_vt"))


# --------------------------------------------------------------------------
# Truncation, padding, batches
# --------------------------------------------------------------------------

def assign_batches(df: DataFrame, key_cols: Sequence[str], batch_size: int, seed: int = 42,
                   sort_col: str | None = None) -> DataFrame:
    """Adds ``batch``: rows in seeded order (or by ``sort_col`` first, which
    reduces padding) are cut into runs of ``batch_size``; only the last may
    be shorter.  Positions come from ranges with offsets."""
    order = ([F.asc(sort_col)] if sort_col else []) + [F.asc("_k"), *[F.asc(c) for c in key_cols]]
    ranked = global_rank(df.withColumn("_k", seeded_key(seed, *[F.col(c) for c in key_cols])), order, "_rank")
    return ranked.withColumn("batch", F.floor((F.col("_rank") - 1) / batch_size)).drop("_k", "_rank")


def truncate_pad(df: DataFrame, ids_col: str, max_len: int | None, pad_id: int, side: str = "right") -> DataFrame:
    """Truncate to ``max_len`` (None: not at all) and pad every row to the
    longest row of its batch; adds input_ids, attention_mask, n_tokens,
    padded_len."""
    ids = F.col(ids_col) if max_len is None else F.slice(F.col(ids_col), 1, max_len)
    d = df.withColumn("_ids", ids).withColumn("n_tokens", F.size("_ids"))
    d = d.withColumn("padded_len", F.max("n_tokens").over(Window.partitionBy("batch")))
    npad = F.col("padded_len") - F.col("n_tokens")
    pad = F.array_repeat(F.lit(pad_id), npad)
    ones = F.array_repeat(F.lit(1), F.col("n_tokens"))
    zeros = F.array_repeat(F.lit(0), npad)
    both = (pad, "_ids", zeros, ones) if side == "left" else ("_ids", pad, ones, zeros)
    return d.withColumns({"input_ids": F.concat(*both[:2]), "attention_mask": F.concat(*both[2:])}).drop("_ids")


def collate_batches(padded: DataFrame) -> DataFrame:
    """Batch summary: rows and padded width of each batch."""
    return padded.groupBy("batch").agg(F.count("*").alias("n"), F.max("padded_len").alias("padded_len"))


def stack_batches(padded: DataFrame, order: Sequence[str], label_col: str | None = None) -> DataFrame:
    """A row a batch, as a model takes it: ``input_ids`` and ``attention_mask``
    as arrays of equally long rows and, with ``label_col``, the ``labels`` of
    these rows, all in ``order``.  A batch has a bounded number of rows."""
    names = [*dict.fromkeys([*order, "input_ids", "attention_mask", *([label_col] if label_col else [])])]
    rows = F.array_sort(F.collect_list(F.struct(*names)))
    stacked = padded.groupBy("batch").agg(F.count("*").alias("n"), F.max("padded_len").alias("padded_len"), rows.alias("_rows"))
    pick = lambda c: F.transform("_rows", lambda r: r[c])
    return stacked.select("batch", "n", "padded_len", pick("input_ids").alias("input_ids"), pick("attention_mask").alias("attention_mask"),
                          *([pick(label_col).alias("labels")] if label_col else []))


# --------------------------------------------------------------------------
# Metrics
# --------------------------------------------------------------------------

def argmax(logits: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def accuracy(df: DataFrame, pred_col: str, label_col: str, by: Sequence[str] = ()) -> DataFrame:
    hit = (F.col(pred_col) == F.col(label_col)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count("*").alias("n"))


def confusion_counts(df: DataFrame, pred_col: str, label_col: str) -> DataFrame:
    return df.groupBy(F.col(label_col).alias("label"), F.col(pred_col).alias("pred")).agg(F.count("*").alias("cnt"))


def best_run(metrics: DataFrame, run_col: str = "run", metric_col: str = "accuracy") -> DataFrame:
    """Best run by the metric (ties: smallest run name)."""
    return metrics.orderBy(F.desc(metric_col), run_col).limit(1).select(
        F.col(run_col).alias("run"), F.col(metric_col).alias("accuracy"))
