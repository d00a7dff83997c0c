"""Training-data preparation queries.

Bindings: claim records are ``customer`` numeric columns (no target, so the
label is null); claim labels come from ``lineitem`` (target = returnflag
'R'); class names from ``part.p_type``; logits are the first ten
components of each ``embeddings`` vector against ``label``; token work runs
on every turn of ``conversations``, wrapped with its role.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import STRIP_PATTERN, py_strip
from ..operators import prep as P
from ..operators import retrieval as R
from ..session import spread
from ..tables import table
from .registry import q, register

SEED = 42
MAX_LEN = 128  # of truncate_pad, whose feature the cut is
BATCH = 16


def _order_sql(cols: list[str]) -> str:
    key = " || '-' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"('0x' || substr(md5('{SEED}-' || {key}), 1, 15))::BIGINT, {', '.join(cols)}"


# ---- row rendering and labels ----------------------------------------------

@register("row_to_text", sql=f"""
SELECT c_custkey, {q(P.CLAIM_PROMPT + ' ' + P.ATTRIBUTES_LEAD)} || 'c_nationkey: '
       || coalesce(CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR), 'NaN') || ', c_acctbal: '
       || coalesce(CAST(CAST(c_acctbal AS DOUBLE) AS VARCHAR), 'NaN') || '.' AS text, CAST(NULL AS INTEGER) AS label
FROM customer""")
def row_to_text(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return P.row_to_text(c, id_col="c_custkey", target_col="target")


@register("row_to_text_labelled", sql=f"""
SELECT c_custkey AS id, {q(P.CLAIM_PROMPT + ' ' + P.ATTRIBUTES_LEAD)} || 'c_nationkey: ' || CAST(c_nationkey AS VARCHAR) || ', c_mktsegment: '
       || coalesce(c_mktsegment, 'NaN') || '.' AS text, CAST(c_acctbal < 0 AS INTEGER) AS label
FROM customer""")
def row_to_text_labelled(spark, sf):
    """Rows with a target; a text column keeps whole numbers whole."""
    c = table(spark, sf, "customer")
    return P.row_to_text(c.select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") < 0).cast("int").alias("target"), "c_nationkey", "c_mktsegment"))


@register("map_label_names", sql="""
SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) AS label,
       CASE CAST(l_returnflag = 'R' AS INTEGER) WHEN 0 THEN 'NO_CLAIM' WHEN 1 THEN 'CLAIM_FILED' END AS name,
       CASE CAST(l_returnflag = 'R' AS INTEGER) WHEN 0 THEN 0 WHEN 1 THEN 1 END AS name_id
FROM lineitem""")
def map_label_names(spark, sf):
    li = table(spark, sf, "lineitem")
    lab = (F.col("l_returnflag") == "R").cast("int")
    return li.select("l_orderkey", "l_linenumber", lab.alias("label")) \
             .withColumn("name", P.map_label_names(F.col("label"))) \
             .withColumn("name_id", P.map_label_ids(F.col("name")))


@register("build_label_index", sql="""
SELECT name, CAST(row_number() OVER (ORDER BY name) - 1 AS INTEGER) AS id
FROM (SELECT DISTINCT p_type AS name FROM part WHERE p_type IS NOT NULL)""")
def build_label_index(spark, sf):
    return P.build_label_index(table(spark, sf, "part"), "p_type")


# ---- splits --------------------------------------------------------------------

LI_KEYS = ["l_orderkey", "l_linenumber"]


def _split_sql(tbl: str, keys: list[str], nested: bool) -> str:
    k1 = "ceil(CAST(0.3 AS DOUBLE) * n)"
    k2 = f"ceil(CAST(0.3 AS DOUBLE) * {k1})"
    case = (f"CASE WHEN rn <= {k2} THEN 'test' WHEN rn <= {k1} THEN 'validation' ELSE 'train' END" if nested
            else f"CASE WHEN rn <= {k1} THEN 'test' ELSE 'train' END")
    return f"""
 o AS (SELECT *, row_number() OVER (ORDER BY {_order_sql(keys)}) AS rn FROM {tbl}),
 nn AS (SELECT count(*) AS n FROM {tbl}),
 sp AS (SELECT o.*, {case} AS split FROM o, nn)"""


@register("split_two_way", sql="WITH " + _split_sql("lineitem", LI_KEYS, False) +
          "\nSELECT l_orderkey, l_linenumber, split FROM sp")
def split_two_way(spark, sf):
    li = table(spark, sf, "lineitem").select(*LI_KEYS)
    return P.assign_split(li, LI_KEYS, SEED, 0.3)


@register("split_three_way", sql="WITH " + _split_sql("lineitem", LI_KEYS, True) +
          "\nSELECT l_orderkey, l_linenumber, split FROM sp")
def split_three_way(spark, sf):
    li = table(spark, sf, "lineitem").select(*LI_KEYS)
    return P.assign_split(li, LI_KEYS, SEED, 0.3, nested=0.3)


# ---- metrics ---------------------------------------------------------------------

PRED_SQL = "(list_position(list_slice(embedding, 1, 10), list_max(list_slice(embedding, 1, 10))) - 1)"
EVAL_SQL = "WITH " + _split_sql("embeddings", ["vec_id"], True) + f""",
 ev AS (SELECT split, avg(CASE WHEN {PRED_SQL} = label THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n
        FROM sp GROUP BY split)"""


def _predictions(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", "label", P.argmax(F.slice("embedding", 1, 10)).alias("pred"))


def _eval_by_split(spark, sf):
    p = P.assign_split(_predictions(spark, sf), ["vec_id"], SEED, 0.3, nested=0.3)
    return P.accuracy(p, "pred", "label", by=["split"])


@register("eval_accuracy", sql=f"""
SELECT round(avg(CASE WHEN {PRED_SQL} = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM embeddings""")
def eval_accuracy(spark, sf):
    a = P.accuracy(_predictions(spark, sf), "pred", "label")
    return a.select(F.round("accuracy", 6).alias("accuracy"), "n")


@register("eval_by_split", sql=EVAL_SQL + "\nSELECT split, round(accuracy, 6) AS accuracy, n FROM ev")
def eval_by_split(spark, sf):
    return _eval_by_split(spark, sf).select("split", F.round("accuracy", 6).alias("accuracy"), "n")


@register("confusion_counts", sql=f"""
SELECT label, CAST({PRED_SQL} AS INTEGER) AS pred, count(*) AS cnt FROM embeddings GROUP BY 1, 2""")
def confusion_counts(spark, sf):
    return P.confusion_counts(_predictions(spark, sf), "pred", "label")


@register("best_run", sql=EVAL_SQL + "\nSELECT split AS run, round(accuracy, 6) AS accuracy FROM ev "
          "ORDER BY accuracy DESC, split LIMIT 1")
def best_run(spark, sf):
    b = P.best_run(_eval_by_split(spark, sf).withColumnRenamed("split", "run"))
    return b.select("run", F.round("accuracy", 6).alias("accuracy"))


# ---- tokens ------------------------------------------------------------------------

SPECIALS_SQL = "[" + ", ".join(q(s) for s in P.SPECIALS) + "]"


def _tokens_sql() -> str:
    from .curation_queries import strip_sql
    wrapped = f"({q(R.IM_START)} || role || chr(10) || text || {q(R.IM_END)} || chr(10))"
    stripped = strip_sql("text")
    parts = (f"list_filter(string_split(regexp_replace({wrapped}, {q(P.SPECIAL_SPLIT)}, chr(1) || '\\1' || chr(1), 'g'),"
             f" chr(1)), lambda x: x <> '')")
    pieces = (f"flatten(list_transform({parts}, lambda p: CASE WHEN list_contains({SPECIALS_SQL}, p) THEN [p] "
              f"ELSE regexp_extract_all(p, {q(P.PIECE)}) END))")
    return f"""
 tk AS (SELECT conv_id, turn, CASE WHEN list_contains({SPECIALS_SQL}, {stripped}) AND strpos({stripped}, chr(10)) = 0
              THEN [{stripped}] ELSE {pieces} END AS toks FROM conversations),
 tl AS (SELECT conv_id, turn, CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos, unnest(toks) AS token FROM tk),
 vc AS (SELECT token, count(*) AS cnt FROM tl WHERE NOT list_contains({SPECIALS_SQL}, token) GROUP BY token),
 vocab AS (SELECT token, CAST(15 + row_number() OVER (ORDER BY cnt DESC, token) AS INTEGER) AS id FROM vc
           UNION ALL SELECT unnest(l) AS token, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS id
           FROM (SELECT {SPECIALS_SQL} AS l)),
 enc AS (SELECT tl.conv_id, tl.turn, tl.pos, tl.token, v.id
         FROM tl LEFT JOIN vocab v ON tl.token = v.token),
 seqs AS (SELECT conv_id, turn, list(id ORDER BY pos) AS ids FROM enc GROUP BY conv_id, turn)"""


TOKENS_SQL = "WITH " + _tokens_sql()


def token_rows(spark, sf):
    """(conv_id, turn, pos, token) for every turn wrapped with its role; a
    turn that is exactly one special token stays that token."""
    c = spread(table(spark, sf, "conversations"), "conv_id")
    stripped = py_strip(F.col("text"))
    single = F.array_contains(P._specials_array(), stripped) & (F.instr(stripped, "\n") == 0)
    arr = F.when(single, F.array(stripped)).otherwise(P.token_pieces(R.chat_wrap(F.col("role"), F.col("text"))))
    return c.select("conv_id", "turn", F.posexplode(arr).alias("pos", "token"))


def encoded(spark, sf):
    rows = token_rows(spark, sf)
    vocab = P.build_vocabulary(rows, "token")
    return P.encode_long(rows, vocab), vocab


def sequences(spark, sf):
    enc, vocab = encoded(spark, sf)
    return P.collect_ordered(enc, ["conv_id", "turn"], "pos", "id", "ids"), vocab


@register("split_special_tokens", sql=TOKENS_SQL + "\nSELECT conv_id, turn, pos, token FROM tl")
def split_special_tokens(spark, sf):
    return token_rows(spark, sf)


@register("encode_tokens", sql=TOKENS_SQL + "\nSELECT conv_id, turn, pos, id FROM enc")
def encode_tokens(spark, sf):
    return encoded(spark, sf)[0].select("conv_id", "turn", "pos", "id")


# what must come back is the text that went in, so the check reads the table
DECODED_SQL = f"""
SELECT conv_id, turn, CASE WHEN list_contains({SPECIALS_SQL}, s) AND strpos(s, chr(10)) = 0 THEN s
       ELSE {q(R.IM_START)} || role || chr(10) || text || {q(R.IM_END)} || chr(10) END AS text
FROM (SELECT *, regexp_replace(text, {q(STRIP_PATTERN)}, '', 'g') AS s FROM conversations)"""


@register("decode_tokens", sql=DECODED_SQL)
def decode_tokens(spark, sf):
    enc, vocab = encoded(spark, sf)
    dec = P.decode_long(enc.select("conv_id", "turn", "pos", "id"), vocab)
    return (P.collect_ordered(dec, ["conv_id", "turn"], "pos", "token", "toks")
            .select("conv_id", "turn", F.array_join("toks", "").alias("text")))


def _batches_sql(side: str, max_len: int | None) -> str:
    cut = "ids" if max_len is None else f"list_slice(ids, 1, {max_len})"
    fill = "list_transform(range(CAST(padded_len - n_tokens AS BIGINT)), lambda x: 0)"
    ones = "list_transform(cut, lambda x: 1)"
    ids, mask = (f"list_concat({fill}, cut)", f"list_concat({fill}, {ones})") if side == "left" else (
        f"list_concat(cut, {fill})", f"list_concat({ones}, {fill})")
    return TOKENS_SQL + f""",
 bt AS (SELECT conv_id, turn, {cut} AS cut, CAST(len({cut}) AS INTEGER) AS n_tokens,
          md5('{SEED}-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)) AS k FROM seqs),
 bb AS (SELECT *, CAST((row_number() OVER (ORDER BY k, conv_id, turn) - 1) // {BATCH} AS BIGINT) AS batch FROM bt),
 pd AS (SELECT *, max(n_tokens) OVER (PARTITION BY batch) AS padded_len FROM bb),
 pf AS (SELECT conv_id, turn, batch, n_tokens, padded_len, array_to_string({ids}, ',') AS input_ids,
          array_to_string({mask}, ',') AS attention_mask FROM pd)"""


def padded(spark, sf, side, max_len):
    seqs, _ = sequences(spark, sf)
    return P.truncate_pad(P.assign_batches(seqs, ["conv_id", "turn"], BATCH, seed=SEED), "ids", max_len, pad_id=0, side=side)


def _as_text(p):
    return p.select("conv_id", "turn", "batch", "n_tokens", "padded_len",
                    *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("input_ids", "attention_mask")])


@register("truncate_pad", sql=_batches_sql("right", MAX_LEN) + "\nSELECT * FROM pf")
def truncate_pad(spark, sf):
    return _as_text(padded(spark, sf, "right", MAX_LEN))


@register("pad_left", sql=_batches_sql("left", None) + "\nSELECT * FROM pf")
def pad_left(spark, sf):
    return _as_text(padded(spark, sf, "left", None))


@register("collate_batches", sql=_batches_sql("right", None) +
          "\nSELECT batch, count(*) AS n, max(padded_len) AS padded_len FROM pf GROUP BY batch")
def collate_batches(spark, sf):
    return P.collate_batches(padded(spark, sf, "right", None))


@register("stack_batches", sql=_batches_sql("right", None) + """
SELECT batch, count(*) AS n, max(padded_len) AS padded_len, string_agg(input_ids, '|' ORDER BY conv_id, turn) AS input_ids,
       string_agg(attention_mask, '|' ORDER BY conv_id, turn) AS attention_mask,
       string_agg(CASE WHEN role = 'assistant' THEN '1' ELSE '0' END, '|' ORDER BY conv_id, turn) AS labels
FROM pf JOIN conversations USING (conv_id, turn) GROUP BY batch""")
def stack_batches(spark, sf):
    """Whole batches with a label a row: whether the assistant speaks."""
    roles = table(spark, sf, "conversations").select("conv_id", "turn", (F.col("role") == "assistant").cast("int").alias("label"))
    b = P.stack_batches(padded(spark, sf, "right", None).join(roles, ["conv_id", "turn"]), ["conv_id", "turn"], "label")
    text = lambda c: F.array_join(F.transform(c, lambda r: F.array_join(r.cast("array<string>"), ",")), "|")
    return b.select("batch", "n", "padded_len", text("input_ids").alias("input_ids"), text("attention_mask").alias("attention_mask"),
                    F.array_join(F.col("labels").cast("array<string>"), "|").alias("labels"))
