"""Retrieval queries on ``pages``, ``documents``, ``embeddings`` and
``conversations``.

Bindings: the vector collection of the ``embeddings`` table types a vector
as text when ``label`` is even (its document is the ``documents`` row with
the same id) and as image otherwise (page = vec_id div 4 + 1, index =
vec_id mod 4).  The retrieval-augmented answers search a second
collection: every document embedded by the hashed text encoder, queried by
every user turn of ``conversations``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import retrieval as R
from ..session import scratch_path
from ..tables import table
from .registry import q, register

K_TOP = 5
K_RAG = 5       # results of the pipeline
K_CHAT = 3      # results of a chat answer
BUDGET = 2000   # of rag_context, whose feature the budget is
DIMS = 64


def _d6(c):
    # + 0.0 turns -0.0 into 0.0 so both engines hash the same value
    return F.round(c, 6) + F.lit(0.0)


# ---- pages -------------------------------------------------------------------

# what stands for each character reference of the pages, written out
REFERENCES_SQL = (("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "))


def _html_text_sql(col: str) -> str:
    t = f"regexp_replace({col}, {q(R.DROP_BLOCKS)}, ' ', 'g')"
    t = f"regexp_replace({t}, {q(R.TAG)}, ' ', 'g')"
    for ent, ch in REFERENCES_SQL:
        t = f"replace({t}, {q(ent)}, {q(ch)})"
    t = f"regexp_replace({t}, '&amp;?', '&', 'g')"
    t = f"regexp_replace({t}, {q(R.BLANKS)}, ' ', 'g')"
    from .curation_queries import strip_sql
    return strip_sql(t)


@register("extract_page_text", sql=f"""
SELECT page_id, text FROM (SELECT page_id, {_html_text_sql('html')} AS text FROM pages) WHERE text <> ''""")
def extract_page_text(spark, sf):
    return R.extract_page_text(table(spark, sf, "pages"))


# the given pages hold no pictures: each gets three, one for each way to quote
PICTURES_SQL = """(SELECT page_id, html || '<img src="' || url || '/a.png"><IMG alt=x data-src="no.png" src = ''b ' || page_id || '.jpg'' /><img src='
  || page_id || '.gif width=1>' AS html FROM pages)"""


@register("extract_page_images", sql=f"""
SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS index,
       unnest(list_transform(l, lambda v: CASE WHEN v[1] IN ('"', '''') THEN v[2:len(v) - 1] ELSE v END)) AS src
FROM (SELECT page_id, regexp_extract_all(html, {q(R.IMG_SRC)}, 1) AS l FROM {PICTURES_SQL})""")
def extract_page_images(spark, sf):
    p = table(spark, sf, "pages")
    pictures = F.concat("html", F.lit('<img src="'), "url", F.lit('/a.png"><IMG alt=x data-src="no.png" src = \'b '), F.col("page_id").cast("string"),
                        F.lit(".jpg' /><img src="), F.col("page_id").cast("string"), F.lit(".gif width=1>"))
    return R.extract_page_images(p.select("page_id", pictures.alias("html")))


# ---- hashed embeddings -------------------------------------------------------

def hash_weights_sql(name: str, src: str, id_col: str, text_col: str) -> str:
    """CTEs ``{name}_w(id, bucket, weight)`` and ``{name}_e(id, emb FLOAT[])``."""
    return f"""
 {name}_t AS (SELECT {id_col} AS id, unnest(regexp_extract_all(lower({text_col}), {q(R.TOKEN)})) AS tok FROM {src}),
 {name}_h AS (SELECT id, ('0x' || substr(md5(tok), 1, 8))::BIGINT AS h FROM {name}_t),
 {name}_s AS (SELECT id, CAST(h % {DIMS} AS INTEGER) AS bucket,
                sum(CASE WHEN (h // {DIMS}) % 2 = 0 THEN 1 ELSE -1 END) AS v FROM {name}_h GROUP BY 1, 2),
 {name}_n AS (SELECT id, sqrt(sum(CAST(v AS DOUBLE) * v)) AS n FROM {name}_s WHERE v <> 0 GROUP BY id),
 {name}_w AS (SELECT s.id, s.bucket, s.v / n.n AS weight FROM {name}_s s JOIN {name}_n n USING (id) WHERE s.v <> 0),
 {name}_e AS (SELECT i.id, list(CAST(coalesce(w.weight, 0) AS FLOAT) ORDER BY b.bucket) AS emb
              FROM (SELECT DISTINCT {id_col} AS id FROM {src}) i CROSS JOIN (SELECT range AS bucket FROM range({DIMS})) b
              LEFT JOIN {name}_w w ON w.id = i.id AND w.bucket = b.bucket GROUP BY i.id)"""


@register("embed_text_hash", sql="WITH " + hash_weights_sql("dh", "documents", "doc_id", "text") + """
SELECT id AS doc_id, bucket, round(weight, 6) AS weight FROM dh_w""")
def embed_text_hash(spark, sf):
    w = R.hashed_token_weights(table(spark, sf, "documents"), "doc_id", "text", DIMS)
    return w.select("doc_id", "bucket", _d6(F.col("weight")).alias("weight"))


# ---- vector ids and the collection --------------------------------------------

def vector_id_sql(prefix: str, index: str, source: str) -> str:
    h = f"md5(coalesce(CAST({source} AS VARCHAR), '') || '|' || CAST({index} AS VARCHAR) || '|{prefix}')"
    return f"('{prefix}_' || CAST({index} AS VARCHAR) || '_' || {h})"


@register("make_vector_id", sql=f"SELECT doc_id, {vector_id_sql('text', 'doc_id', 'source')} AS id FROM documents")
def make_vector_id(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", R.make_vector_id("text", F.col("doc_id"), F.col("source")).alias("id"))


def text_blocks_with_vectors(spark, sf):
    """Every document and every text vector, joined where both are there."""
    e = table(spark, sf, "embeddings").where(F.pmod(F.col("label"), F.lit(2)) == 0).select("vec_id", "embedding")
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "source", "text")
    return e.join(d, "vec_id", "full").withColumn("page", F.lit(1))


def text_vectors(spark, sf):
    return R.text_vectors(text_blocks_with_vectors(spark, sf), "vec_id", "source", "page", "text", "embedding")


def image_vectors(spark, sf):
    e = table(spark, sf, "embeddings").where(F.pmod(F.col("label"), F.lit(2)) == 1)
    imgs = e.select("vec_id", "embedding", F.lit("embeddings").alias("source"),
                    (F.floor(F.col("vec_id") / 4) + 1).alias("page"), F.pmod("vec_id", F.lit(4)).alias("img"))
    return R.image_vectors(imgs, "vec_id", "source", "page", "img", "embedding")


def _emb_sql(col: str) -> str:
    # a vector as text: its components in millionths
    return f"array_to_string(list_transform({col}, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000000 + 0.5) AS BIGINT)), ',')"


def _emb(col="embedding"):
    return F.array_join(F.transform(F.col(col), lambda x: F.floor(x.cast("double") * 1000000 + 0.5).cast("string")), ",")


TEXT_VEC_SQL = f"""
 tv AS (SELECT {vector_id_sql('text', 'coalesce(e.vec_id, d.doc_id)', 'd.source')} AS id, d.text AS document, 'text' AS type,
           1 AS page, d.source AS source, CAST(NULL AS INTEGER) AS image_index, {_emb_sql('e.embedding')} AS embedding
        FROM (SELECT * FROM embeddings WHERE label % 2 = 0) e FULL JOIN documents d ON e.vec_id = d.doc_id)"""
IMAGE_VEC_SQL = f"""
 iv AS (SELECT {vector_id_sql('image', 'vec_id', "'embeddings'")} AS id,
           'Image from page ' || CAST(vec_id // 4 + 1 AS VARCHAR) || ', index ' || CAST(vec_id % 4 AS VARCHAR) AS document,
           'image' AS type, CAST(vec_id // 4 + 1 AS INTEGER) AS page, 'embeddings' AS source,
           CAST(vec_id % 4 AS INTEGER) AS image_index, {_emb_sql('embedding')} AS embedding
        FROM embeddings WHERE label % 2 = 1)"""
COLS = ["id", "document", "type", "page", "source", "image_index"]
STORED_SQL = "WITH " + TEXT_VEC_SQL + "," + IMAGE_VEC_SQL + ",\n st AS (SELECT * FROM tv UNION ALL SELECT * FROM iv)"


def stored_collection(spark, sf):
    """Text vectors, then image vectors, then the first of them again (which
    adds nothing) into a collection that does not exist yet."""
    path = scratch_path(spark, "collection")
    R.add_to_collection(text_vectors(spark, sf), path)
    R.add_to_collection(image_vectors(spark, sf), path)
    return R.add_to_collection(image_vectors(spark, sf).where(F.col("image_index") == 0), path)


@register("store_text_vectors", sql="WITH " + TEXT_VEC_SQL + "\nSELECT * FROM tv")
def store_text_vectors(spark, sf):
    c = R.add_to_collection(text_vectors(spark, sf), scratch_path(spark, "collection"))
    return c.select(*COLS, _emb().alias("embedding"))


@register("store_image_vectors", sql="WITH " + IMAGE_VEC_SQL + "\nSELECT * FROM iv")
def store_image_vectors(spark, sf):
    c = R.add_to_collection(image_vectors(spark, sf), scratch_path(spark, "collection"))
    return c.select(*COLS, _emb().alias("embedding"))


@register("build_collection", sql=STORED_SQL + "\nSELECT * FROM st")
def build_collection(spark, sf):
    c = R.build_collection(text_vectors(spark, sf), image_vectors(spark, sf))
    return c.select(*COLS, _emb().alias("embedding"))


@register("collection_count", sql=STORED_SQL + "\nSELECT type, count(*) AS cnt FROM st GROUP BY type")
def collection_count(spark, sf):
    return stored_collection(spark, sf).groupBy("type").agg(F.count("*").alias("cnt"))


# ---- nearest neighbours on the embeddings table ---------------------------------

def _dist_sql(a: str, b: str) -> str:
    return (f"(1 - list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])) / "
            f"(sqrt(list_dot_product(CAST({a} AS DOUBLE[]), CAST({a} AS DOUBLE[]))) * "
            f"sqrt(list_dot_product(CAST({b} AS DOUBLE[]), CAST({b} AS DOUBLE[])))))")


def _topk_sql(where: str) -> str:
    return f"""
WITH qv AS (SELECT embedding AS qe FROM embeddings WHERE vec_id = 0),
 d AS (SELECT vec_id, {_dist_sql('e.embedding', 'qv.qe')} AS distance FROM embeddings e, qv WHERE {where})
SELECT CAST(row_number() OVER (ORDER BY distance, vec_id) AS INTEGER) AS rank, vec_id, round(distance, 6) + 0.0 AS distance
FROM d ORDER BY distance, vec_id LIMIT {K_TOP}"""


def _query_vec(spark, sf):
    return table(spark, sf, "embeddings").where(F.col("vec_id") == 0)


@register("knn_topk", sql=_topk_sql("true"))
def knn_topk(spark, sf):
    r = R.knn_topk(table(spark, sf, "embeddings"), _query_vec(spark, sf), K_TOP, id_col="vec_id")
    return r.select("rank", "vec_id", _d6(F.col("distance")).alias("distance"))


@register("knn_filtered", sql=STORED_SQL + f""",
 qv AS (SELECT embedding AS qe FROM embeddings WHERE vec_id = 0),
 d AS (SELECT {vector_id_sql('image', 'vec_id', "'embeddings'")} AS id, {_dist_sql('e.embedding', 'qv.qe')} AS distance
       FROM embeddings e, qv WHERE e.label % 2 = 1)
SELECT CAST(row_number() OVER (ORDER BY distance, id) AS INTEGER) AS rank, id, round(distance, 6) + 0.0 AS distance
FROM d ORDER BY distance, id LIMIT {K_TOP}""")
def knn_filtered(spark, sf):
    """Among the stored image vectors: the filter reads their folder only."""
    r = R.knn_topk(stored_collection(spark, sf), _query_vec(spark, sf), K_TOP, where=F.col("type") == "image")
    return r.select("rank", "id", _d6(F.col("distance")).alias("distance"))


@register("knn_join", sql=f"""
WITH d AS (SELECT a.vec_id AS query_id, b.vec_id, {_dist_sql('a.embedding', 'b.embedding')} AS distance
           FROM embeddings a, embeddings b),
 r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 12), vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(distance, 6) + 0.0 AS distance FROM r WHERE rank <= {K_TOP}""")
def knn_join(spark, sf):
    e = table(spark, sf, "embeddings")
    r = R.knn_join(e.select(F.col("vec_id").alias("query_id"), "embedding"), e, K_TOP,
                   query_id="query_id", id_col="vec_id")
    return r.select("query_id", "rank", "vec_id", _d6(F.col("distance")).alias("distance"))


@register("knn_lsh")
def knn_lsh(spark, sf):
    """Approximate search for every vector whose id is divisible by 50, against
    all vectors; the tests measure its recall against ``knn_join``."""
    e = table(spark, sf, "embeddings")
    asked = e.where(F.pmod("vec_id", F.lit(50)) == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    r = R.knn_lsh(asked, e, K_TOP, query_id="query_id", id_col="vec_id")
    return r.select("query_id", "rank", "vec_id", _d6(F.col("distance")).alias("distance"))


# ---- retrieval-augmented answers over documents ------------------------------------

def doc_collection(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", "text")
    e = R.embed_text_hash(d, "doc_id", "text", DIMS).withColumn("page", F.lit(1))
    return R.add_to_collection(R.text_vectors(e, "doc_id", "source", "page", "text", "embedding"), scratch_path(spark, "collection"))


def user_questions(spark, sf):
    return (table(spark, sf, "conversations").where(F.col("role") == "user")
            .select(F.concat_ws(":", "conv_id", "turn").alias("query_id"), "conv_id", "turn", F.col("text").alias("question")))


def answers(spark, sf, k, budget=None):
    return R.rag_answers(user_questions(spark, sf), doc_collection(spark, sf), n_results=k, max_context_length=budget)


def rag_sql(k: int, budget: int | None = None) -> str:
    kept = "runs" if budget is None else f"(SELECT * FROM runs WHERE run <= {budget})"
    return "WITH " + hash_weights_sql("dh", "documents", "doc_id", "text") + "," + hash_weights_sql(
        "uh", "(SELECT conv_id || ':' || turn AS qid, text FROM conversations WHERE role = 'user')", "qid", "text") + f""",
 coll0 AS (SELECT {vector_id_sql('text', 'd.doc_id', 'd.source')} AS id, d.text AS document, 'text' AS type, 1 AS page,
            CAST(e.emb AS DOUBLE[]) AS v FROM documents d JOIN dh_e e ON e.id = d.doc_id),
 coll AS (SELECT *, sqrt(list_dot_product(v, v)) AS n FROM coll0 WHERE list_dot_product(v, v) > 0),
 qs AS (SELECT conv_id || ':' || turn AS query_id, conv_id, turn, text AS question FROM conversations WHERE role = 'user'),
 qe AS (SELECT query_id, v, sqrt(list_dot_product(v, v)) AS n
        FROM (SELECT id AS query_id, CAST(emb AS DOUBLE[]) AS v FROM uh_e) WHERE list_dot_product(v, v) > 0),
 pairs AS (SELECT qe.query_id, coll.id, round(1 - list_dot_product(qe.v, coll.v) / (qe.n * coll.n), 12) AS distance FROM qe, coll),
 ranked0 AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs)
            WHERE rank <= {k}),
 ranked AS MATERIALIZED (SELECT r.*, c.document, c.type, c.page FROM ranked0 r JOIN coll0 c ON r.id = c.id),
 pieces AS MATERIALIZED (SELECT *, (CASE WHEN type = 'text' THEN '[Text from page ' ELSE '[Image from page ' END) || CAST(page AS VARCHAR)
               || ', relevance: ' || printf('%.2f', 1.0 - distance) || ']' || chr(10) || document || chr(10) AS piece FROM ranked),
 lens AS MATERIALIZED (SELECT query_id, rank, length(piece) AS plen FROM pieces),
 runs AS (SELECT a.query_id, a.rank, sum(b.plen) AS run FROM lens a JOIN lens b
          ON a.query_id = b.query_id AND b.rank <= a.rank GROUP BY a.query_id, a.rank),
 kept AS (SELECT p.* FROM pieces p JOIN {kept} r ON p.query_id = r.query_id AND p.rank = r.rank),
 has AS (SELECT DISTINCT query_id FROM ranked),
 joined AS (SELECT query_id, string_agg(piece, chr(10) || '---' || chr(10) ORDER BY rank) AS c FROM kept GROUP BY query_id),
 ctx AS MATERIALIZED (SELECT q.query_id, CASE WHEN h.query_id IS NULL THEN {q(R.NO_CONTEXT)} ELSE coalesce(j.c, '') END
                AS context FROM qs q LEFT JOIN has h ON h.query_id = q.query_id
                LEFT JOIN joined j ON j.query_id = q.query_id)"""


@register("rag_context", sql=rag_sql(K_RAG, BUDGET) + "\nSELECT query_id, context FROM ctx")
def rag_context(spark, sf):
    return answers(spark, sf, K_RAG, BUDGET).select("query_id", "context")


@register("build_rag_messages", sql=rag_sql(K_RAG) + f"""
SELECT query_id, 0 AS pos, 'system' AS role, {q(R.SYSTEM_PREFIX)} || context AS content FROM ctx
UNION ALL SELECT query_id, 1, 'user', question FROM qs""")
def build_rag_messages(spark, sf):
    a = answers(spark, sf, K_RAG)
    return R.rag_messages(a.select("query_id", "context"), a, "query_id", "question")


@register("rag_pipeline", sql=rag_sql(K_RAG) + f"""
SELECT query_id, regexp_extract(context, {q(R.FIRST_SENTENCE)}, 1) AS response FROM ctx""")
def rag_pipeline(spark, sf):
    return answers(spark, sf, K_RAG).select("query_id", "response")


@register("chat_answer_text", sql=rag_sql(K_CHAT) + f"""
SELECT q.conv_id, q.turn, {q(R.ANSWER_LEAD)} || c.context || {q(R.ANSWER_MIDDLE)} || regexp_extract(c.context, {q(R.FIRST_SENTENCE)}, 1) AS text
FROM qs q JOIN ctx c USING (query_id)""")
def chat_answer_text(spark, sf):
    a = answers(spark, sf, K_CHAT)
    return a.select("conv_id", "turn", R.chat_answer_text(F.col("context"), F.col("response")).alias("text"))


# ---- chat markup -------------------------------------------------------------------

def _wrap_sql(role: str, text: str) -> str:
    return f"({q(R.IM_START)} || {role} || chr(10) || {text} || {q(R.IM_END)} || chr(10))"


@register("chat_wrap", sql=f"SELECT conv_id, turn, {_wrap_sql('role', 'text')} AS text FROM conversations")
def chat_wrap(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", R.chat_wrap(F.col("role"), F.col("text")).alias("text"))


@register("chat_history", sql=f"""
SELECT conv_id, turn, string_agg({_wrap_sql('role', 'text')}, '' ORDER BY turn)
         OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS text
FROM conversations""")
def chat_history(spark, sf):
    return R.chat_history(table(spark, sf, "conversations")).select("conv_id", "turn", "text")
