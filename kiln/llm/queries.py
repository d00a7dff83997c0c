"""The operators bound to the given tables: ``QUERIES`` and, where DuckDB can
say the same, ``ORACLE``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from kiln.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@query("op9_exact_dedup", """
    WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
               FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
    FROM d""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.exact_dedup import duplicate_classes
    return duplicate_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), limit=4096)


@query("op4_bpe_roundtrip")
def op4_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.bpe import bpe_digests
    return bpe_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.packing import Capacity, pack
    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), Capacity(tokens=4096), end_id=1)


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.langid import fold, learn, predict
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.filter(fold(3) != 1).select("doc_id", "text", "lang"))
    return predict(docs, model).select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score")


@query("op6_rule_quality")
def op6_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.langid import fold
    from kiln.llm.rule_quality import learn
    from kiln.llm.text_stats import with_statistics
    from kiln.session import materialize
    measured = materialize(with_statistics(table(spark, sf_dir, "documents"), ["doc_id"]), "text-statistics")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    rules = learn(measured.join(labels, "doc_id").filter(fold(5) != 0), "quality")
    score = measured.select("doc_id", (fold(5) == 0).alias("held_out"), rules.score().alias("score"))
    return score.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op10_minhash_near_dedup")
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.suffix_dedup import repeat_digests
    return repeat_digests(table(spark, sf_dir, "documents"), length=200)


@query("op1_lm_scoring", r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x20\x09-\x0D]+') AS w FROM documents),
    p AS (SELECT doc_id, unnest(w) AS c, unnest(range(len(w))) AS i, w FROM d),
    g AS (SELECT doc_id, i, c, CASE WHEN i >= 1 THEN w[i] END AS b, CASE WHEN i >= 2 THEN w[i - 1] END AS a FROM p),
    own1 AS (SELECT doc_id, c, count(*) AS n FROM g GROUP BY ALL), all1 AS (SELECT c, sum(n) AS n FROM own1 GROUP BY ALL),
    own2 AS (SELECT doc_id, b, c, count(*) AS n FROM g WHERE i >= 1 GROUP BY ALL), all2 AS (SELECT b, c, sum(n) AS n FROM own2 GROUP BY ALL),
    own3 AS (SELECT doc_id, a, b, c, count(*) AS n FROM g WHERE i >= 2 GROUP BY ALL), all3 AS (SELECT a, b, c, sum(n) AS n FROM own3 GROUP BY ALL),
    l1 AS (SELECT doc_id, c, all1.n - own1.n AS n FROM own1 JOIN all1 USING (c)),
    l2 AS (SELECT doc_id, b, c, all2.n - own2.n AS n FROM own2 JOIN all2 USING (b, c)),
    l3 AS (SELECT doc_id, a, b, c, all3.n - own3.n AS n FROM own3 JOIN all3 USING (a, b, c)),
    s AS (SELECT g.doc_id, least(i + 1, 3) AS have, t.n AS n3, bi.n AS n2, u.n AS n1, cb.n AS context2, cu.n AS context1
          FROM g JOIN l1 u ON u.doc_id = g.doc_id AND u.c = g.c
          LEFT JOIN l1 cu ON cu.doc_id = g.doc_id AND cu.c = g.b
          LEFT JOIN l2 bi ON bi.doc_id = g.doc_id AND bi.b = g.b AND bi.c = g.c
          LEFT JOIN l2 cb ON cb.doc_id = g.doc_id AND cb.b = g.a AND cb.c = g.b
          LEFT JOIN l3 t ON t.doc_id = g.doc_id AND t.a = g.a AND t.b = g.b AND t.c = g.c),
    f AS (SELECT *, CASE WHEN n3 > 0 THEN 3 WHEN n2 > 0 THEN 2 WHEN n1 > 0 THEN 1 ELSE 0 END AS used FROM s),
    x AS (SELECT doc_id, used, CAST(round(1e6 * ln(pow(0.4, have - used) * CASE used
              WHEN 3 THEN CAST(n3 AS DOUBLE) / CAST(context2 AS DOUBLE) WHEN 2 THEN CAST(n2 AS DOUBLE) / CAST(context1 AS DOUBLE)
              WHEN 1 THEN CAST(n1 AS DOUBLE) ELSE 1.0 END)) AS BIGINT) AS micro FROM f),
    y AS (SELECT doc_id, count(*) AS n, count(*) FILTER (used = 3) AS t, count(*) FILTER (used = 2) AS b,
                 count(*) FILTER (used = 1) AS u, count(*) FILTER (used = 0) AS z, sum(micro) AS micro FROM x GROUP BY doc_id),
    z AS (SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_words, coalesce(t, 0) AS n_trigrams, coalesce(b, 0) AS n_bigrams,
                 coalesce(u, 0) AS n_unigrams, coalesce(z, 0) AS n_unknown, coalesce(micro, 0) AS micro FROM d LEFT JOIN y USING (doc_id)),
    r AS (SELECT *, CAST(micro - (n_unigrams + n_unknown) * CAST(round(1e6 * ln(CAST(greatest(sum(n_words) OVER () - n_words, 1) AS DOUBLE))) AS BIGINT) AS BIGINT) AS score_micro FROM z)
    SELECT doc_id, n_words, n_trigrams, n_bigrams, n_unigrams, n_unknown, score_micro,
           CASE WHEN n_words > 0 THEN CAST(score_micro AS DOUBLE) / (n_words * CAST(1e6 AS DOUBLE)) ELSE 0.0 END AS score FROM r""")
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.lm_scoring import backoff_scores
    return backoff_scores(table(spark, sf_dir, "documents"))


@query("op2_ann_graph")
def op2_ann_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.ann_graph import nearest_neighbours
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), k=20, every=20)


@query("op13_piece_roundtrip")
def op13_piece_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.pieces import piece_digests
    return piece_digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op12_ranked_search", r"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    n AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
    s AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS terms FROM n),
    q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)),
    p AS (SELECT r, unnest(w) AS t FROM d),
    tf AS (SELECT r, t, count(*) AS tf FROM p WHERE t IN (SELECT t FROM q) GROUP BY ALL),
    w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(documents) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, s GROUP BY t),
    g AS (SELECT r, doc_id, t, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // terms)) AS impact FROM tf JOIN n USING (r), s),
    x AS (SELECT item_id, r, doc_id, CAST(sum(w * impact) AS BIGINT) AS score FROM q JOIN w USING (t) JOIN g USING (t) GROUP BY item_id, r, doc_id),
    k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM x WHERE score > 0)
    SELECT * FROM k WHERE rank <= 50""")
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.ranked_search import ranked_search
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query("op11_conversation_repair", r"""
    WITH RECURSIVE
    powers AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
               FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256)))),
    raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
    codes AS (SELECT k, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))),
                                        lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % 20 AS fault
              FROM (SELECT DISTINCT k FROM raw), powers),
    damaged AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                       CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS time
                FROM raw JOIN codes USING (k) WHERE fault <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare FROM damaged),
    marked AS (SELECT conv_id, turn, role, text, i, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS mark,
                      CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '?' END AS c, count(*) OVER (PARTITION BY conv_id) AS n,
                      lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed),
    figures AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (mark = 'blank') AS blank,
                       count(*) FILTER (mark = 'duplicate') AS duplicate, count(*) FILTER (mark = 'truncated') AS truncated,
                       count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id),
    ins(p, q, e, fee, lines) AS (VALUES (0, 0, '', 0, []::VARCHAR[]), (0, 2, 'I', 5, ['user:']), (0, 3, 'II', 10, ['user:', 'assistant:']),
        (1, 1, '', 0, []), (1, 2, 'I', 5, ['user:']), (1, 3, 'II', 10, ['user:', 'assistant:']), (2, 2, '', 0, []), (2, 3, 'I', 5, ['assistant:']),
        (2, 2, 'II', 10, ['assistant:', 'user:']), (3, 3, '', 0, []), (3, 2, 'I', 5, ['user:']), (3, 3, 'II', 10, ['user:', 'assistant:'])),
    reads(p, c, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
    ops AS (SELECT p, c, 'K' AS e, 0 AS fee, q, NULL AS said FROM reads
            UNION ALL SELECT p, x.c, 'R', 1, CASE WHEN p = 2 THEN 3 ELSE 2 END, CASE WHEN p = 2 THEN 'assistant' ELSE 'user' END FROM (VALUES (0), (1), (2), (3)) s(p), (VALUES ('s'), ('u'), ('a'), ('?')) x(c)
            UNION ALL SELECT p, x.c, 'D', 2, p, NULL FROM (VALUES (0), (1), (2), (3)) s(p), (VALUES ('s'), ('u'), ('a'), ('?')) x(c)),
    moves AS (SELECT ins.p, ops.c, ops.q, ins.e || ops.e AS e, ins.fee + ops.fee AS fee, ins.lines, ops.e AS op, ops.said FROM ins JOIN ops ON ops.p = ins.q),
    ways AS (
        SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, []::VARCHAR[] AS lines FROM (SELECT DISTINCT conv_id FROM marked)
        UNION ALL
        SELECT conv_id, i, state, cost, audit, lines FROM (
            SELECT w.conv_id, m.i, v.q AS state, w.cost + v.fee + CASE WHEN m.mark = 'truncated' AND v.op <> 'D' THEN 5 ELSE 0 END AS cost, w.audit || v.e AS audit,
                   list_concat(w.lines, v.lines, CASE WHEN v.op = 'D' THEN [] ELSE [coalesce(v.said, m.role) || ':' || m.text] END) AS lines,
                   row_number() OVER (PARTITION BY w.conv_id, v.q ORDER BY w.cost + v.fee + CASE WHEN m.mark = 'truncated' AND v.op <> 'D' THEN 5 ELSE 0 END, w.audit || v.e) AS k
            FROM ways w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1 JOIN moves v ON v.p = w.state AND v.c = m.c
            WHERE v.op = 'D' OR m.mark IN ('fine', 'truncated')) WHERE k = 1),
    ends AS (SELECT w.conv_id, w.cost + ins.fee AS cost, w.audit || ins.e AS audit, list_concat(w.lines, ins.lines) AS lines,
                    row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + ins.fee, w.audit || ins.e) AS k
             FROM ways w JOIN (SELECT conv_id, max(n) AS n FROM marked GROUP BY conv_id) z ON z.conv_id IS NOT DISTINCT FROM w.conv_id AND z.n = w.i JOIN ins ON ins.p = w.state WHERE ins.q IN (0, 3))
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
           coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN (SELECT * FROM ends WHERE k = 1) e ON e.conv_id IS NOT DISTINCT FROM o.conv_id""")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.conversation_repair import damage, repair_digests
    conversations = table(spark, sf_dir, "conversations")
    return repair_digests(conversations, damage(conversations))
