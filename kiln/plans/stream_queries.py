"""Streaming, source/sink and model-run queries.

Each query first writes input files derived from the driver's tables into a
fresh folder under ``spark.checkpoint.dir``, runs the job, and returns what
it wrote read back.  Streams receive their input in two arrivals with a
restart in between, so the final table also proves that a restart skips
files already processed.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..operators import curation as C
from ..operators import model as M
from ..operators import prep as P
from ..session import scratch_path, spread
from ..sources import arrays as A
from ..sources import files as S
from ..streaming import names as N
from ..streaming import predictions as PR
from ..streaming import streams as ST
from ..tables import table
from .curation_queries import (CURATED_ROWS_SQL, RECORD, UNUSUAL_SQL, _stats_sql, curated, documents_as_records, flagged, has_names_sql,
                               has_numbers_sql, strip_sql)
from .registry import q, register


def _paths(spark, name):
    base = scratch_path(spark, name)
    return base, os.path.join(base, "in"), os.path.join(base, "out"), os.path.join(base, "ckpt")


# ---- streams ----------------------------------------------------------------------

@register("stream_classify", sql="WITH " + UNUSUAL_SQL + f"""
SELECT d.doc_id, {has_numbers_sql('d.text')} AS llm_has_numbers, regexp_matches(d.text, {q(C.NON_ENGLISH_PATTERN)}) AS llm_has_non_english,
       u.doc_id IS NOT NULL AS llm_has_unusual_proper_nouns FROM documents d LEFT JOIN unusual u ON d.doc_id = u.doc_id""")
def stream_classify(spark, sf):
    _, src, out, ckpt = _paths(spark, "stream-classify")
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    schema = d.schema
    first = F.coalesce(F.col("lang") == "en", F.lit(False))
    d.where(first).write.parquet(src)
    ST.stream_classify(spark, src, schema, out, ckpt)
    d.where(~first).write.mode("append").parquet(src)  # second arrival (all the rest), then restart
    ST.stream_classify(spark, src, schema, out, ckpt)
    return ST.read_classified(spark, out, schema["doc_id"])


@register("stream_rare_names", sql="WITH " + UNUSUAL_SQL + """
SELECT d.doc_id, u.doc_id IS NOT NULL AS flag FROM documents d LEFT JOIN unusual u ON d.doc_id = u.doc_id""")
def stream_rare_names(spark, sf):
    """Five arrivals, a run each: words become common and take flags back."""
    _, src, out, ckpt = _paths(spark, "stream-names")
    d = table(spark, sf, "documents").select("doc_id", "text")
    for i in range(5):
        d.where(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == i).write.mode("append").parquet(src)
        N.stream_rare_names(spark, src, d.schema, out, ckpt)
    ids = N.rare_name_ids(spark, out, d.schema["doc_id"]).withColumn("_u", F.lit(True))
    return d.select("doc_id").join(ids, "doc_id", "left").select("doc_id", F.col("_u").isNotNull().alias("flag"))


@register("stream_prevalence", sql="WITH " + UNUSUAL_SQL + f""",
 v AS (SELECT d.text, l.doc_id IS NOT NULL AS ok, u.doc_id IS NOT NULL AS rare FROM documents d
       LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id LEFT JOIN unusual u ON u.doc_id = d.doc_id)
SELECT count(*) AS total, count(*) FILTER (WHERE ok) AS successful,
       count(*) FILTER (WHERE ok AND {has_numbers_sql('text')}) AS numbers,
       count(*) FILTER (WHERE ok AND regexp_matches(text, {q(C.NON_ENGLISH_PATTERN)})) AS non_english,
       count(*) FILTER (WHERE ok AND rare) AS unusual_proper_nouns FROM v""")
def stream_prevalence(spark, sf):
    _, src, out, ckpt = _paths(spark, "stream-prevalence")
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    labels = table(spark, sf, "labels")
    schema = d.schema
    first = F.coalesce(F.col("lang") == "en", F.lit(False))
    d.where(first).write.parquet(src)
    ST.stream_prevalence(spark, src, schema, out, ckpt, labels)
    d.where(~first).write.mode("append").parquet(src)
    ST.stream_prevalence(spark, src, schema, out, ckpt, labels)
    return ST.read_prevalence(spark, out, labels, schema["doc_id"])


@register("stream_chat_history", sql=f"""
SELECT conv_id, turn, string_agg({q('<|im_start|>')} || role || chr(10) || text || {q('<|im_end|>')} || chr(10), ''
         ORDER BY turn) OVER (PARTITION BY conv_id ORDER BY turn
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS text FROM conversations""")
def stream_chat_history(spark, sf):
    _, src, out, ckpt = _paths(spark, "stream-chat")
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    schema = c.schema
    c.where(F.pmod("turn", F.lit(2)) == 1).write.parquet(src)  # every other turn arrives late
    ST.stream_chat_history(spark, src, schema, out, ckpt, files_per_batch=None)
    c.where(F.pmod("turn", F.lit(2)) == 0).write.mode("append").parquet(src)
    ST.stream_chat_history(spark, src, schema, out, ckpt, files_per_batch=None)
    return ST.read_chat_history(spark, out)


# ---- sources and sinks -----------------------------------------------------------

@register("scan_json_questions", sql=f"""
SELECT {strip_sql('source')} AS category, {strip_sql('text')} AS question, lang AS show_number, '' AS air_date
FROM documents""")
def scan_json_questions(spark, sf):
    """Many files that hold one JSON array each, the form of the source."""
    _, src, _, _ = _paths(spark, "questions-json")
    d = table(spark, sf, "documents")
    one = F.struct(F.col("source").alias("category"), F.col("text").alias("question"), F.col("lang").alias("show_number"))
    S.write_json_arrays(d.select(F.to_json(one).alias("value")), src)
    r = C.clean_records(S.read_questions(spark, src, multi_line=True))
    return r.select("category", "question", "show_number", "air_date")


@register("scan_json_array", sql=f"""
SELECT {strip_sql('source')} AS category, {strip_sql('text')} AS question, lang AS show_number, '' AS air_date
FROM documents""")
def scan_json_array(spark, sf):
    """Few large arrays, each read by several tasks in ranges of bytes."""
    _, src, _, _ = _paths(spark, "questions-array")
    d = table(spark, sf, "documents")
    one = F.struct(F.col("source").alias("category"), F.col("text").alias("question"), F.col("lang").alias("show_number"))
    S.write_json_arrays(d.select(F.to_json(one).alias("value")), src, max_rows=10_000_000, max_bytes=256 << 20)
    r = C.clean_records(A.read_array(spark, src, S.QUESTION_SCHEMA))
    return r.select("category", "question", "show_number", "air_date")


@register("scan_csv_claims", sql=f"""
SELECT c_custkey AS id, {q(P.CLAIM_PROMPT + ' ' + P.ATTRIBUTES_LEAD)} || 'c_nationkey: '
       || coalesce(CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR), 'NaN') || ', c_acctbal: '
       || coalesce(CAST(CAST(c_acctbal AS DOUBLE) AS VARCHAR), 'NaN') || '.' AS text, CAST(NULL AS INTEGER) AS label
FROM customer""")
def scan_csv_claims(spark, sf):
    _, src, _, _ = _paths(spark, "claims-csv")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey", "c_acctbal")
    c.write.option("header", True).csv(src)
    train = S.read_claims_csv(spark, src)  # types inferred once from the file
    return P.row_to_text(train, "id", "target").withColumn("id", F.col("id").cast("long"))


BINARY_FILE_BYTES = 4 << 20


@register("scan_binary_docs", sql=f"""
WITH n AS (SELECT CAST(coalesce(sum(octet_length(encode(html)) + 1), 0) // {BINARY_FILE_BYTES} + 1 AS BIGINT) AS files FROM pages),
 f AS (SELECT page_id % files AS file, string_agg(html || chr(10), '' ORDER BY page_id) AS content FROM pages, n GROUP BY 1)
SELECT file, CAST(octet_length(encode(content)) AS BIGINT) AS length, sha256(content) AS sha256 FROM f""")
def scan_binary_docs(spark, sf):
    """Files of many pages each, about ``BINARY_FILE_BYTES`` large however many
    pages there are, read back as bytes: a row a file with its digest."""
    _, src, _, _ = _paths(spark, "pages-bin")
    p = table(spark, sf, "pages").select("page_id", "html")
    n = (p.agg(F.sum(F.octet_length("html") + 1)).first()[0] or 0) // BINARY_FILE_BYTES + 1
    files = p.withColumn("file", F.pmod("page_id", F.lit(n))).repartition("file").sortWithinPartitions("file", "page_id")
    files.select("file", "html").write.partitionBy("file").text(src)
    return S.read_binary_docs(spark, src).select(F.col("file").cast("long").alias("file"), "length", F.sha2("content", 256).alias("sha256"))


@register("sink_curated_json", sql=CURATED_ROWS_SQL)
def sink_curated_json(spark, sf):
    _, _, out, _ = _paths(spark, "curated-json")
    rows = curated(spark, sf).select("dataset", *RECORD, *C.FLAGS)
    S.write_json(rows, out, partition_by="dataset")
    return spark.read.schema(rows.schema).json(out).select(*rows.columns)


@register("sink_stats", sql="WITH st AS (" + _stats_sql() + """)
SELECT total, successful, failed, valid_predictions, numbers_classified_count, non_english_classified_count,
       unusual_proper_nouns_classified_count, estimate_total_size FROM st""")
def sink_stats(spark, sf):
    _, _, out, _ = _paths(spark, "stats-json")
    fl = flagged(spark, sf)
    flat = C.curation_stats(fl, curated(spark, sf, fl), None)
    document = C.curation_stats_document(flat)
    S.write_json(document.coalesce(1), out)
    doc = spark.read.schema(document.schema).json(out)  # blocks that are null tell no types
    return doc.select(
        F.col("classification_quality.total").alias("total"),
        F.col("classification_quality.successful").alias("successful"),
        F.col("classification_quality.failed").alias("failed"),
        F.col("classified_dataset.valid_predictions").alias("valid_predictions"),
        F.col("numbers.classified_count").alias("numbers_classified_count"),
        F.col("non_english.classified_count").alias("non_english_classified_count"),
        F.col("unusual_proper_nouns.classified_count").alias("unusual_proper_nouns_classified_count"),
        F.col("full_dataset_estimates.total_size").alias("estimate_total_size"))


# ---- model runs ----------------------------------------------------------------------

MODEL_SQL = f"""
SELECT doc_id, regexp_matches({strip_sql('text')}, '[0-9]') AS llm_has_numbers,
       regexp_matches({strip_sql('text')}, {q(C.NON_ENGLISH_PATTERN)}) AS llm_has_non_english,
       {has_names_sql(strip_sql('text'))} AS llm_has_unusual_proper_nouns FROM documents"""


@register("classify_with_model", sql=MODEL_SQL)
def classify_with_model(spark, sf):
    return M.classify_with_model(spread(documents_as_records(spark, sf), "doc_id"), "doc_id").drop("error")


@register("stream_predictions", sql=MODEL_SQL)
def stream_predictions(spark, sf):
    """Records in two arrivals, a run of the model stream each."""
    base, src, out, ckpt = _paths(spark, "stream-model")
    recs = documents_as_records(spark, sf).select("doc_id", "category", "question", "answer")
    for i in range(2):
        recs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == i).write.mode("append").parquet(src)
        PR.stream_predictions(spark, src, recs.schema, out, os.path.join(base, "retry"), ckpt)
    return PR.read_predictions(spark, out, recs.schema).drop("error")


@register("classify_resume", sql=MODEL_SQL)
def classify_resume(spark, sf):
    _, _, out, _ = _paths(spark, "predictions")
    recs = documents_as_records(spark, sf)
    # an earlier run that stopped after the English documents
    M.classify_resume(recs.where(F.col("show_number") == "en"), "doc_id", out)
    return M.classify_resume(recs, "doc_id", out)
