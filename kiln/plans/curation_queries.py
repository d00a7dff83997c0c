"""Curation queries on ``documents`` / ``labels``.

Binding: id = doc_id, category = source, question = text, show = lang.
"Flagged documents" carry the three rule flags, null where the document has
no row in ``labels`` (standing for a failed model answer).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.json_flags import FALLBACK_PATTERN, STRICT_PATTERN
from ..functions.text import STRIP_PATTERN
from ..operators import curation as C
from ..session import scratch_path
from ..tables import table
from .registry import q, register

N_STRAT = 100
N_CURATED = 50
SEED = 42


def documents_as_records(spark, sf):
    d = table(spark, sf, "documents")
    return C.clean_records(d.select("doc_id", F.col("source").alias("category"),
                                    F.col("text").alias("question"), F.col("lang").alias("show_number")))


def flagged(spark, sf):
    """Flagged documents over one written table of text features."""
    return C.flagged_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


# ---- SQL building blocks ---------------------------------------------------

# number words, written down apart from the operator's list
NUMBERS_SQL = "(^|[^\\p{L}])(" + "|".join((
    "zero|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|(thir|four|fif|six|seven|eigh|nine)teen",
    "(twen|thir|for|fif|six|seven|eigh|nine)ty|hundreds?|thousands?|(m|b)illions?|trillion",
    "zéro|deux|trois|quatre|cinq|sept|huit|neuf|dix|onze|douze|treize|quatorze|quinze|seize|vingt|trente|quarante|cinquante|soixante",
    "(sept|huit|oct|non)ante|cents?|mille|milliards?",
    "null|eins|zwei|drei|vier|fünf|sechs|sieben|acht|neun|zehn|elf|zwölf|(drei|vier|fünf|sech|sieb|acht|neun)zehn|zwanzig|dreißig",
    "(vier|fünf|sech|sieb|acht|neun)zig|hundert|tausend|millionen|milliarden?",
    "cero|dos|tres|cuatro|cinco|seis|siete|ocho|nueve|diez|once|doce|trece|catorce|quince|dieciséis|dieci(siete|ocho|nueve)|veinte",
    "veinti(uno|dós|trés|cuatro|cinco)|(tre|cuare|cincue|sese|sete|oche|nove)nta|treinta|cien|ciento|mil|millón|millones")) + ")([^\\p{L}]|$)"


def has_numbers_sql(x: str) -> str:
    return f"(regexp_matches({x}, '[0-9]') OR regexp_matches(lower({x}), {q(NUMBERS_SQL)}))"


UNUSUAL_SQL = rf"""
 uw AS (SELECT doc_id,
          list_distinct(regexp_extract_all(text, {q(C.WORD)})) AS allw,
          list_distinct(list_filter(flatten(list_transform(string_split_regex(text, {q(C.SENTENCE_SPLIT)}),
                lambda s: regexp_extract_all(s, {q(C.WORD)})[2:])), lambda x: regexp_matches(x, {q(C.CAPITALISED)}))) AS cand
        FROM documents),
 urows AS (SELECT doc_id, unnest(allw) AS word, false AS is_cand FROM uw
           UNION ALL SELECT doc_id, unnest(cand) AS word, true AS is_cand FROM uw),
 ug AS (SELECT word, count(*) FILTER (WHERE NOT is_cand) AS df,
               min(doc_id) FILTER (WHERE is_cand) AS c1, max(doc_id) FILTER (WHERE is_cand) AS c2
        FROM urows GROUP BY word),
 unusual AS (SELECT c1 AS doc_id FROM ug WHERE df <= 2 AND c1 IS NOT NULL
             UNION SELECT c2 FROM ug WHERE df <= 2 AND c2 IS NOT NULL)"""

RULES_SQL = rf"""
 rules AS (SELECT d.doc_id, d.source, d.lang, d.text,
             {has_numbers_sql('d.text')} AS f1,
             regexp_matches(d.text, {q(C.NON_ENGLISH_PATTERN)}) AS f2,
             u.doc_id IS NOT NULL AS f3
           FROM documents d LEFT JOIN unusual u ON d.doc_id = u.doc_id),
 flagged AS (SELECT r.doc_id, r.source, r.lang, r.text,
               CASE WHEN l.doc_id IS NOT NULL THEN f1 END AS llm_has_numbers,
               CASE WHEN l.doc_id IS NOT NULL THEN f2 END AS llm_has_non_english,
               CASE WHEN l.doc_id IS NOT NULL THEN f3 END AS llm_has_unusual_proper_nouns
             FROM rules r LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON r.doc_id = l.doc_id)"""

FLAGGED_CTE = "WITH " + UNUSUAL_SQL + "," + RULES_SQL
VALID = ("(llm_has_numbers IS NOT NULL OR llm_has_non_english IS NOT NULL "
         "OR llm_has_unusual_proper_nouns IS NOT NULL)")


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, {q(STRIP_PATTERN)}, '', 'g')"


def prompt_sql(category: str, question: str, answer: str) -> str:
    parts = []
    cols = {"category": category, "question": question, "answer": answer}
    for p in C.template_parts(C.CLASSIFY_PROMPT, list(cols)):
        parts.append(f"coalesce(CAST({cols[p[1]]} AS VARCHAR), '')" if isinstance(p, tuple) else q(p))
    return "(" + " || ".join(x for x in parts if x != "''") + ")"


def stratified_sql(base: str, n: int, stratum: str, order: str, vals: list[str], out: list[str],
                   group: str | None = None) -> str:
    """SQL restatement of the stratified-sample rule (see operators.curation)."""
    g = group or "0"
    gsel = f"{group} AS _g" if group else "0 AS _g"
    on_vals = " AND ".join(f"p0.{c} IS NOT DISTINCT FROM b.{c}" for c in vals)
    cols = ", ".join(["_g"] + out)
    return f"""
 sb AS (SELECT *, {gsel} FROM {base}),
 tot AS (SELECT _g, count(*) AS total FROM sb GROUP BY _g),
 cnt AS (SELECT sb._g, {stratum}, count(*) AS c, min({order}) AS first_seen, any_value(total) AS total
         FROM sb JOIN tot ON sb._g = tot._g WHERE total > {n} GROUP BY sb._g, {stratum}),
 qq AS (SELECT _g, {stratum}, first_seen, greatest(1, ({n} * c) // total) AS quota FROM cnt),
 rr AS (SELECT sb.*, row_number() OVER (PARTITION BY sb._g, {stratum} ORDER BY {order}) AS rk FROM sb),
 p0a AS (SELECT rr.*, qq.first_seen AS o1, rr.rk AS o2 FROM rr JOIN qq
         ON rr._g = qq._g AND rr.{stratum} IS NOT DISTINCT FROM qq.{stratum} WHERE rr.rk <= qq.quota),
 p0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY _g ORDER BY o1, o2) AS n0 FROM p0a) WHERE n0 <= {n}),
 p1 AS (SELECT b.*, b.{order} AS o1, 0 AS o2 FROM sb b JOIN tot ON b._g = tot._g
        WHERE total > {n} AND NOT EXISTS (SELECT 1 FROM p0 WHERE p0._g = b._g AND {on_vals})),
 su AS (SELECT {cols}, -1 AS ph, {order} AS o1, 0 AS o2 FROM sb JOIN tot USING (_g) WHERE total <= {n}
        UNION ALL SELECT {cols}, 0, o1, o2 FROM p0
        UNION ALL SELECT {cols}, 1, o1, o2 FROM p1),
 sampled AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY _g ORDER BY ph, o1, o2) AS pick FROM su)
             WHERE pick <= {n})"""


def has_names_sql(x: str) -> str:
    """Some sentence has a capitalised word after its first."""
    words = f"list_transform(string_split_regex({x}, {q(C.SENTENCE_SPLIT)}), lambda s: regexp_extract_all(s, {q(C.WORD)})[2:])"
    return f"(len(list_filter(flatten({words}), lambda w: regexp_matches(w, {q(C.CAPITALISED)}))) > 0)"


# ---- queries -----------------------------------------------------------------

@register("clean_records", sql=f"""
SELECT doc_id, {strip_sql('source')} AS category, {strip_sql('text')} AS question FROM documents""")
def clean_records(spark, sf):
    return documents_as_records(spark, sf).select("doc_id", "category", "question")


@register("render_classify_prompt", sql=f"""
SELECT doc_id, {prompt_sql(strip_sql('source'), strip_sql('text'), "''")} AS prompt FROM documents""")
def render_classify_prompt(spark, sf):
    r = documents_as_records(spark, sf)
    return r.select("doc_id", C.classify_prompt(F.col("category"), F.col("question"), F.col("answer")).alias("prompt"))


@register("rule_has_numbers", sql=f"""
SELECT doc_id, {has_numbers_sql('text')} AS flag FROM documents""")
def rule_has_numbers(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", C.rule_has_numbers(F.col("text")).alias("flag"))


@register("rule_has_non_english", sql=f"""
SELECT doc_id, regexp_matches(text, {q(C.NON_ENGLISH_PATTERN)}) AS flag FROM documents""")
def rule_has_non_english(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", C.rule_has_non_english(F.col("text")).alias("flag"))


@register("rule_foreign_words", sql=f"""
WITH w AS (SELECT doc_id, lang, unnest(list_distinct(regexp_extract_all(lower(text), {q(C.WORD)}))) AS word FROM documents),
 n AS (SELECT CAST(count(*) FILTER (WHERE lang = 'en') AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE lang <> 'en') AS DOUBLE) AS m FROM documents),
 c AS (SELECT word, CAST(count(*) FILTER (WHERE lang = 'en') AS DOUBLE) AS a, CAST(count(*) FILTER (WHERE lang <> 'en') AS DOUBLE) AS b FROM w WHERE lang IS NOT NULL GROUP BY word),
 f AS (SELECT word FROM c, n WHERE b * n > a * m AND round(2 * (CASE WHEN a > 0 THEN a * ln(a * (n + m) / (n * (a + b))) ELSE 0 END
        + CASE WHEN b > 0 THEN b * ln(b * (n + m) / (m * (a + b))) ELSE 0 END), 6) >= 10.83),
 u AS (SELECT DISTINCT doc_id FROM w WHERE word IN (SELECT word FROM f))
SELECT d.doc_id, u.doc_id IS NOT NULL AS flag FROM documents d LEFT JOIN u ON d.doc_id = u.doc_id""")
def rule_foreign_words(spark, sf):
    """Foreign words by statistics of the corpus, accented or not."""
    d = table(spark, sf, "documents")
    ids = C.rule_foreign_ids(d, "doc_id", "text", "lang").withColumn("_f", F.lit(True))
    return d.select("doc_id").join(ids, "doc_id", "left").select("doc_id", F.col("_f").isNotNull().alias("flag"))


@register("rule_unusual_names", sql="WITH " + UNUSUAL_SQL + """
SELECT d.doc_id, u.doc_id IS NOT NULL AS flag FROM documents d LEFT JOIN unusual u ON d.doc_id = u.doc_id""")
def rule_unusual_names(spark, sf):
    d = table(spark, sf, "documents")
    ids = C.unusual_name_ids(d, "doc_id", "text", 2).withColumn("_u", F.lit(True))
    return (d.select("doc_id").join(ids, "doc_id", "left")
            .select("doc_id", F.col("_u").isNotNull().alias("flag")))


@register("filter_flags", sql=FLAGGED_CTE + """
SELECT doc_id FROM flagged WHERE llm_has_numbers = true AND llm_has_non_english = false""")
def filter_flags(spark, sf):
    return C.filter_flags(flagged(spark, sf), has_numbers=True, has_non_english=False).select("doc_id")


@register("profile", sql="""
SELECT count(*) AS total_questions, count(DISTINCT source) AS unique_categories,
       count(DISTINCT coalesce(lang, '')) AS unique_shows FROM documents""")
def profile(spark, sf):
    d = table(spark, sf, "documents")
    return C.profile(d, category="source", show="lang")


@register("profile_sketched", sql="""
SELECT count(*) AS total_questions, count(DISTINCT source) AS unique_categories,
       count(DISTINCT coalesce(lang, '')) AS unique_shows FROM documents""")
def profile_sketched(spark, sf):
    """The profile from sketches of four slices, merged; few distinct values,
    of which the sketches are exact."""
    d, path = table(spark, sf, "documents"), scratch_path(spark, "profile")
    for i in range(4):
        C.store_profile(d.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == i), path, str(i), "source", "lang")
    return C.sketched_profile(spark, path)


@register("profile_flags", sql=FLAGGED_CTE + """
SELECT count(*) FILTER (WHERE llm_has_numbers) AS has_numbers,
       count(*) FILTER (WHERE llm_has_non_english) AS has_non_english,
       count(*) FILTER (WHERE llm_has_unusual_proper_nouns) AS has_unusual_proper_nouns FROM flagged""")
def profile_flags(spark, sf):
    return C.profile_flags(flagged(spark, sf))


@register("classification_quality", sql=FLAGGED_CTE + f"""
SELECT count(*) AS total, count(*) FILTER (WHERE {VALID}) AS successful,
       count(*) FILTER (WHERE NOT {VALID}) AS failed,
       CASE WHEN count(*) > 0 THEN round(100.0 * count(*) FILTER (WHERE {VALID}) / count(*), 2) ELSE 0.0 END AS success_rate,
       CASE WHEN count(*) > 0 THEN round(100.0 * count(*) FILTER (WHERE NOT {VALID}) / count(*), 2) ELSE 0.0 END AS failure_rate
FROM flagged""")
def classification_quality(spark, sf):
    return C.classification_quality(flagged(spark, sf))


CLASS_COUNTS_SQL = FLAGGED_CTE + f""",
 cc AS (SELECT count(*) AS total, count(*) FILTER (WHERE {VALID}) AS valid,
          count(*) FILTER (WHERE {VALID} AND llm_has_numbers) AS numbers,
          count(*) FILTER (WHERE {VALID} AND llm_has_non_english) AS non_english,
          count(*) FILTER (WHERE {VALID} AND llm_has_unusual_proper_nouns) AS unusual_proper_nouns FROM flagged),
 cl AS (SELECT total, valid, 'numbers' AS class, numbers AS classified_count FROM cc
        UNION ALL SELECT total, valid, 'non_english', non_english FROM cc
        UNION ALL SELECT total, valid, 'unusual_proper_nouns', unusual_proper_nouns FROM cc)"""


@register("class_prevalence", sql=CLASS_COUNTS_SQL + """
SELECT class, classified_count, round(100.0 * classified_count / valid, 2) AS percentage FROM cl WHERE valid > 0""")
def class_prevalence(spark, sf):
    return C.class_prevalence(flagged(spark, sf))


@register("prevalence_estimate", sql=CLASS_COUNTS_SQL + """
SELECT class, CAST(trunc(classified_count / valid * total) AS BIGINT) AS estimated_count,
       round(100.0 * classified_count / valid, 2) AS percentage FROM cl WHERE valid > 0 AND total > valid""")
def prevalence_estimate(spark, sf):
    return C.prevalence_estimate(flagged(spark, sf), None)


@register("strata_counts", sql="SELECT lang, count(*) AS cnt FROM documents GROUP BY lang")
def strata_counts(spark, sf):
    return C.strata_counts(table(spark, sf, "documents"), "lang")


@register("head_per_stratum", sql=f"""
WITH t AS (SELECT count(*) AS total FROM documents),
 c AS (SELECT lang, count(*) AS cnt FROM documents GROUP BY lang),
 qq AS (SELECT lang, greatest(1, ({N_STRAT} * cnt) // total) AS quota FROM c, t),
 r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rk FROM documents)
SELECT r.doc_id, r.lang, CAST(r.rk AS INTEGER) AS rk FROM r JOIN qq ON r.lang IS NOT DISTINCT FROM qq.lang WHERE r.rk <= qq.quota""")
def head_per_stratum(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return C.head_per_stratum(d, N_STRAT, "lang", "doc_id").select("doc_id", "lang", "rk")


@register("stratified_sample", sql="WITH " + stratified_sql(
    "(SELECT doc_id, source, lang, text FROM documents)", N_STRAT, "lang", "doc_id",
    ["source", "lang", "text"], ["doc_id", "lang"]) + "\nSELECT doc_id, lang FROM sampled")
def stratified_sample(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    return C.stratified_sample(d, N_STRAT, "lang", "doc_id", ["source", "lang", "text"]).select("doc_id", "lang")


CURATED_BASE = f"""(SELECT f.*, t.dataset FROM flagged f, (VALUES ('numbers'), ('non_english'), ('unusual_proper_nouns')) t(dataset)
  WHERE {VALID} AND ((t.dataset = 'numbers' AND llm_has_numbers) OR (t.dataset = 'non_english' AND llm_has_non_english)
        OR (t.dataset = 'unusual_proper_nouns' AND llm_has_unusual_proper_nouns)))"""
CURATED_VALS_SQL = ["source", "lang", "text", "llm_has_numbers", "llm_has_non_english", "llm_has_unusual_proper_nouns"]
CURATED_VALS = ["source", "lang", "text_md5", "llm_has_numbers", "llm_has_non_english", "llm_has_unusual_proper_nouns"]
CURATED_SQL = FLAGGED_CTE + "," + stratified_sql(CURATED_BASE, N_CURATED, "source", "doc_id", CURATED_VALS_SQL,
                                                 ["doc_id", "dataset"], group="dataset")


RECORD = ["doc_id", "text", "lang", "source", "n_chars"]
CURATED_ROWS_SQL = (CURATED_SQL + "\nSELECT s._g AS dataset, " + ", ".join(f"d.{c}" for c in RECORD) + ", "
                    + ", ".join(f"f.{c}" for c in C.FLAGS)
                    + " FROM sampled s JOIN documents d ON d.doc_id = s.doc_id JOIN flagged f ON f.doc_id = s.doc_id")


def curated(spark, sf, fl=None):
    """The samples with their whole records."""
    fl = flagged(spark, sf) if fl is None else fl
    return C.curated_datasets(fl, N_CURATED, "source", "doc_id", CURATED_VALS, table(spark, sf, "documents").select(*RECORD))


@register("curated_datasets", sql=CURATED_ROWS_SQL)
def curated_datasets(spark, sf):
    return curated(spark, sf).select("dataset", *RECORD, *C.FLAGS)


def _stats_sql() -> str:
    cls = [("numbers", "llm_has_numbers"), ("non_english", "llm_has_non_english"),
           ("unusual_proper_nouns", "llm_has_unusual_proper_nouns")]
    sel = ["a.total", "a.valid AS successful", "a.total - a.valid AS failed",
           "CASE WHEN a.total > 0 THEN round(100.0 * a.valid / a.total, 2) ELSE 0.0 END AS success_rate",
           "CASE WHEN a.total > 0 THEN round(100.0 * (a.total - a.valid) / a.total, 2) ELSE 0.0 END AS failure_rate",
           "a.total AS total_questions", "a.valid AS valid_predictions"]
    for n, _ in cls:
        sel += [f"CASE WHEN a.valid > 0 THEN a.{n} END AS {n}_classified_count",
                f"CASE WHEN a.valid > 0 THEN round(100.0 * a.{n} / a.valid, 2) END AS {n}_percentage_of_valid",
                f"CASE WHEN a.valid > 0 THEN s.{n} END AS {n}_sample_size"]
    est = "a.valid > 0 AND a.total > a.valid"
    sel.append(f"CASE WHEN {est} THEN a.total END AS estimate_total_size")
    for n, _ in cls:
        sel += [f"CASE WHEN {est} THEN CAST(trunc(a.{n} / a.valid * a.total) AS BIGINT) END AS {n}_estimated_count",
                f"CASE WHEN {est} THEN round(100.0 * a.{n} / a.valid, 2) END AS {n}_estimate_percentage"]
    sel.append("CASE WHEN a.valid = 0 THEN 'No valid predictions - all classifications failed' END AS error")
    aggs = ", ".join(f"count(*) FILTER (WHERE {VALID} AND {c}) AS {n}" for n, c in cls)
    saggs = ", ".join(f"count(*) FILTER (WHERE _g = '{n}') AS {n}" for n, _ in cls)
    return (CURATED_SQL + f""",
 a AS (SELECT count(*) AS total, count(*) FILTER (WHERE {VALID}) AS valid, {aggs} FROM flagged),
 s AS (SELECT {saggs} FROM sampled)
SELECT {', '.join(sel)} FROM a, s""")


@register("curation_stats", sql=_stats_sql())
def curation_stats(spark, sf):
    fl = flagged(spark, sf)
    return C.curation_stats(fl, curated(spark, sf, fl), None)


@register("sample_exact", sql=f"""
SELECT doc_id FROM documents ORDER BY md5('{SEED}-' || CAST(doc_id AS VARCHAR)), doc_id LIMIT {N_STRAT}""")
def sample_exact(spark, sf):
    return C.sample_exact(table(spark, sf, "documents").select("doc_id"), N_STRAT, "doc_id", SEED)


# ---- model answers: built from labels, one response shape per residue -----

def responses(spark, sf):
    lab = table(spark, sf, "labels")
    qv = F.when(F.col("quality") == 1, "true").otherwise("false")
    tv = F.when(F.col("toxic") == 1, "true").otherwise("false")
    k = F.pmod(F.col("doc_id"), F.lit(6))
    text = (F.when(k == 0, F.concat(F.lit('ok {"has_numbers": '), qv, F.lit(', "has_non_english": '), tv,
                                    F.lit(', "has_unusual_proper_nouns": null} end')))
            .when(k == 1, F.concat(F.lit('{"has_unusual_proper_nouns": '), tv, F.lit(', "has_numbers": '), qv,
                                   F.lit("}")))
            .when(k == 2, F.concat(F.lit('{"has_numbers":"false","x":{"y":'), F.col("quality").cast("string"),
                                   F.lit("}}")))
            .when(k == 3, F.concat(F.lit('{"has_numbers": '), F.col("quality").cast("string"),
                                   F.lit(', "has_non_english": ['), F.col("toxic").cast("string"),
                                   F.lit('], "has_unusual_proper_nouns": ""}')))
            .when(k == 4, F.when(F.col("quality") == 1, F.lit("{bad")).otherwise(F.lit("no json")))
            .otherwise(F.concat(F.lit('{"has_numbers": tru, "has_non_english": '), tv,
                                F.lit(', "has_unusual_proper_nouns": false}'))))
    return lab.select(F.col("doc_id").alias("id"), text.alias("text"))


RESPONSES_SQL = """
 resp AS (SELECT doc_id AS id, CASE doc_id % 6
    WHEN 0 THEN 'ok {"has_numbers": ' || (CASE WHEN quality = 1 THEN 'true' ELSE 'false' END) || ', "has_non_english": '
                || (CASE WHEN toxic = 1 THEN 'true' ELSE 'false' END) || ', "has_unusual_proper_nouns": null} end'
    WHEN 1 THEN '{"has_unusual_proper_nouns": ' || (CASE WHEN toxic = 1 THEN 'true' ELSE 'false' END) || ', "has_numbers": '
                || (CASE WHEN quality = 1 THEN 'true' ELSE 'false' END) || '}'
    WHEN 2 THEN '{"has_numbers":"false","x":{"y":' || CAST(quality AS VARCHAR) || '}}'
    WHEN 3 THEN '{"has_numbers": ' || CAST(quality AS VARCHAR) || ', "has_non_english": [' || CAST(toxic AS VARCHAR)
                || '], "has_unusual_proper_nouns": ""}'
    WHEN 4 THEN CASE WHEN quality = 1 THEN '{bad' ELSE 'no json' END
    ELSE '{"has_numbers": tru, "has_non_english": ' || (CASE WHEN toxic = 1 THEN 'true' ELSE 'false' END)
         || ', "has_unusual_proper_nouns": false}' END AS text FROM labels)"""

SPAN_SQL = RESPONSES_SQL + rf""",
 sp AS (SELECT id, text, {strip_sql('text')} AS t FROM resp),
 span AS (SELECT id, text, CASE WHEN regexp_extract(t, {q(STRICT_PATTERN)}, 0) <> '' THEN regexp_extract(t, {q(STRICT_PATTERN)}, 0)
                       WHEN regexp_extract(t, {q(FALLBACK_PATTERN)}, 0) <> '' THEN regexp_extract(t, {q(FALLBACK_PATTERN)}, 0) END AS span
          FROM sp)"""


def _truthy_sql(k: str) -> str:
    p = f"'$.{k}'"
    return f"""CASE WHEN NOT ok THEN NULL
      WHEN json_type(j, {p}) IS NULL THEN false
      WHEN json_type(j, {p}) = 'NULL' THEN false
      WHEN json_type(j, {p}) = 'BOOLEAN' THEN json_extract_string(j, {p}) = 'true'
      WHEN json_type(j, {p}) IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN CAST(json_extract_string(j, {p}) AS DOUBLE) <> 0
      WHEN json_type(j, {p}) = 'VARCHAR' THEN length(json_extract_string(j, {p})) > 0
      WHEN json_type(j, {p}) = 'ARRAY' THEN json_array_length(j, {p}) > 0
      WHEN json_type(j, {p}) = 'OBJECT' THEN len(json_keys(j, {p})) > 0
      ELSE true END AS {k}"""


PARSE_SQL = "WITH " + SPAN_SQL + """,
 pv AS (SELECT id, text, span, coalesce(json_valid(span), false) AS v FROM span),
 parsed AS (SELECT id, text, CASE WHEN v THEN span END AS j, v AND json_type(CASE WHEN v THEN span END) = 'OBJECT' AS ok FROM pv),
 flags AS (SELECT id, text, """ + ",\n ".join(_truthy_sql(k) for k in
                                             ("has_numbers", "has_non_english", "has_unusual_proper_nouns")) + " FROM parsed)"


@register("extract_json_span", sql="WITH " + SPAN_SQL + "\nSELECT id, span FROM span")
def extract_json_span(spark, sf):
    from ..functions.json_flags import json_span
    return responses(spark, sf).select("id", json_span(F.col("text")).alias("span"))


@register("parse_flags", sql=PARSE_SQL + "\nSELECT id, has_numbers, has_non_english, has_unusual_proper_nouns FROM flags")
def parse_flags(spark, sf):
    from ..functions.json_flags import parse_flag_columns
    return responses(spark, sf).select("id", *parse_flag_columns(F.col("text")))


@register("parse_failures_sample", sql=PARSE_SQL + """
SELECT id, substr(text, 1, 200) AS preview FROM flags
WHERE has_numbers IS NULL AND has_non_english IS NULL AND has_unusual_proper_nouns IS NULL ORDER BY id LIMIT 3""")
def parse_failures_sample(spark, sf):
    from ..functions.json_flags import parse_flag_columns
    p = responses(spark, sf).select("id", "text", *parse_flag_columns(F.col("text")))
    failed = p.where(F.coalesce("has_numbers", "has_non_english", "has_unusual_proper_nouns").isNull())
    return failed.orderBy("id").limit(3).select("id", F.substring("text", 1, 200).alias("preview"))


# ---- predictions joined to their rows ----------------------------------------

ATTACHED_SQL = PARSE_SQL + """,
 att AS (SELECT d.doc_id, f.has_numbers AS llm_has_numbers, f.has_non_english AS llm_has_non_english,
           f.has_unusual_proper_nouns AS llm_has_unusual_proper_nouns FROM documents d LEFT JOIN flags f ON d.doc_id = f.id)"""


def attached(spark, sf):
    """Documents with the flags parsed from their model answers."""
    from ..functions.json_flags import parse_flag_columns
    parsed = responses(spark, sf).select(F.col("id").alias("doc_id"), *parse_flag_columns(F.col("text"), prefix="llm_"))
    return C.attach_predictions(table(spark, sf, "documents").select("doc_id"), parsed, "doc_id")


@register("attach_predictions", sql=ATTACHED_SQL + "\nSELECT * FROM att")
def attach_predictions(spark, sf):
    return attached(spark, sf)


@register("filter_valid", sql=ATTACHED_SQL + f"\nSELECT doc_id FROM att WHERE {VALID}")
def filter_valid(spark, sf):
    return C.filter_valid(attached(spark, sf)).select("doc_id")
