"""Retrieval operators: page text, hashed embeddings, the stored vector
collection, cosine nearest neighbours, context and chat messages.

Scale notes
-----------
* ``knn_topk`` (one query) is a projection plus TakeOrderedAndProject: each
  task keeps k rows, one task merges k x tasks rows.
* ``knn_join`` (many queries) is exact without all pairs: see ``nearest``.
* A vector of length zero has no direction: it takes no part in any search,
  neither as query nor as candidate.  Ties go to the smaller id everywhere.
"""

from __future__ import annotations

import html
import re
from typing import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fmt2
from ..functions.vectors import cosine_distance, literal_vector
from ..session import materialize_passing as materialize
from ..session import spread
from .collection import COLLECTION, add_to_collection, read_collection  # noqa: F401
from .nearest import directed, knn_join, knn_lsh  # noqa: F401

# --------------------------------------------------------------------------
# Page text and images
# --------------------------------------------------------------------------

# Markup dropped before text extraction.
DROP_BLOCKS = r"(?is)<head[^>]*>.*?</head>|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
TAG = r"<[^>]*>"
BLANKS = r"[ \t\n\r\f]+"
# an attribute named src, its value in double, single or no quotes
IMG_SRC = r"""(?i)<img\b[^>]*?\ssrc\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def extract_page_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One text block per page: markup dropped, character references decoded
    (all named and numeric ones, a no-break space as a space), blanks
    collapsed; blank pages dropped.

    The expressions are evaluated once, below the Arrow step that decodes
    the references and drops blank pages."""
    bare = F.regexp_replace(F.regexp_replace(F.col(html_col), DROP_BLOCKS, " "), TAG, " ")

    def decode(batches):
        for batch in batches:
            texts = [" ".join(re.split(BLANKS, html.unescape(t).replace("\xa0", " "))).strip() if t else "" for t in batch.column(1).to_pylist()]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])
            yield out.filter(pa.array([bool(t) for t in texts], pa.bool_()))

    given = pages.select(id_col, bare.alias("_bare"))
    return given.mapInArrow(decode, T.StructType([given.schema[id_col], T.StructField("text", T.StringType())]))


def extract_page_images(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per ``<img src>`` with its 0-based index within the page."""
    quoted = F.regexp_extract_all(F.col(html_col), F.lit(IMG_SRC), F.lit(1))
    srcs = F.transform(quoted, lambda v: F.when(v.rlike("^[\"']"), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v))
    return pages.select(id_col, F.posexplode(srcs).alias("index", "src"))


# --------------------------------------------------------------------------
# Hashed text embedding (the built-in encoder; callers may plug their own)
# --------------------------------------------------------------------------

TOKEN = r"\p{L}+|\p{N}+"
#: Tokens whose hash a worker keeps.
HELD_TOKENS = 200_000


def _hash_embedding_fn(dims: int):
    import hashlib

    import regex

    tok_re = regex.compile(TOKEN)
    ascii_re = re.compile("[a-z]+|[0-9]+")  # the same on lower-cased ASCII, in less time

    class Codes(dict):
        """Bucket of a token, plus ``dims`` if its sign is negative; each token
        is hashed once as long as it is held."""

        def __missing__(self, token: str) -> int:
            h = int(hashlib.md5(token.encode("utf-8")).hexdigest()[:8], 16)
            if len(self) >= HELD_TOKENS:
                self.clear()
            code = self[token] = h % dims + dims * (h // dims % 2)
            return code

    codes = Codes()

    def embed(texts: pd.Series) -> pd.Series:
        # a few texts at a time, so that their tokens stay small in memory
        return pd.concat([some(texts.iloc[i:i + 256]) for i in range(0, len(texts), 256)] or [pd.Series([], dtype="object")])

    def some(texts: pd.Series) -> pd.Series:
        # look up the code of each token, then one bincount into the dense matrix
        valid = texts.notna().to_numpy()
        toks = [(ascii_re if t.isascii() else tok_re).findall(t.lower()) if ok else [] for t, ok in zip(texts, valid)]
        lengths = np.fromiter((len(t) for t in toks), dtype=np.int64, count=len(toks))
        code = np.fromiter((codes[w] for t in toks for w in t), dtype=np.int64, count=lengths.sum())
        row = np.repeat(np.arange(len(toks)), lengths)
        both = np.bincount(row * (2 * dims) + code, minlength=len(toks) * 2 * dims).reshape(len(toks), 2, dims)
        mat = (both[:, 0] - both[:, 1]).astype(np.float64)
        norms = np.sqrt((mat * mat).sum(axis=1))
        safe = np.where(norms > 0, norms, 1.0)
        mat = mat / safe[:, None]
        return pd.Series([mat[i] if valid[i] else None for i in range(len(toks))], index=texts.index, dtype="object")

    return embed


def hashed_embedding(text: Column, dims: int = 64) -> Column:
    """Signed feature hashing of the lower-cased letter / digit runs of a
    text, L2-normalised, as ``array<double>``: bucket = md5(token) mod dims,
    sign from the next bit.  All tokens of a text live in its row, so this
    is a row-local Arrow-batched pandas UDF: one pass, no shuffle (the
    equivalent explode + aggregate plan would shuffle and re-join the
    text).

    The UDF is a pure function of the text but is marked
    non-deterministic: otherwise Catalyst pushes a filter on the embedding
    below the projection and evaluates the UDF twice."""
    udf = F.pandas_udf(_hash_embedding_fn(dims), T.ArrayType(T.DoubleType())).asNondeterministic()
    return udf(text)


def hashed_token_weights(df: DataFrame, id_col: str, text_col: str, dims: int = 64) -> DataFrame:
    """Long form (id, bucket, weight) of the non-zero hashed weights."""
    return (spread(df, id_col)
            .select(id_col, F.posexplode(hashed_embedding(F.col(text_col), dims)).alias("bucket", "weight"))
            .where(F.col("weight") != 0).withColumn("bucket", F.col("bucket").cast("int")))


def embed_text_hash(df: DataFrame, id_col: str, text_col: str, dims: int = 64) -> DataFrame:
    """Adds a dense ``embedding array<float>`` (zero vector for a text
    without tokens)."""
    return spread(df, id_col).withColumn("embedding", F.transform(hashed_embedding(F.col(text_col), dims),
                                                  lambda x: x.cast("float")))


# --------------------------------------------------------------------------
# Collection (id, embedding, document, metadata)
# --------------------------------------------------------------------------

def embed_with(df: DataFrame, value_col: str, encode: Callable[[list], Sequence], batch_size: int = 64, out: str = "embedding") -> DataFrame:
    """Adds ``out``: the vectors a caller's encoder gives for texts, or for the
    bytes of images (``read_labelled_images``, ``binaryFile``).  It is called
    with at most ``batch_size`` values at a time; a null value has a null
    vector and is not handed over.  Other columns are kept."""
    kind = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, batch_size):
                b = whole.slice(lo, batch_size)
                values = b.column(value_col).to_pylist()
                given = [i for i, v in enumerate(values) if v is not None]
                vectors: list = [None] * len(values)
                if given:
                    found = list(encode([values[i] for i in given]))
                    if len(found) != len(given):
                        raise ValueError(f"{len(found)} vectors for {len(given)} values")
                    for i, v in zip(given, found):
                        vectors[i] = [float(x) for x in v]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(vectors, pa.list_(pa.float32()))], [*b.schema.names, out])

    return df.mapInArrow(run, kind)


def make_vector_id(prefix: str, index: Column, source: Column) -> Column:
    """``prefix_index_hash`` with the md5 of source, index and prefix, parted
    by ``|``: stable across processes, and different for every source."""
    h = F.md5(F.concat_ws("|", F.coalesce(source.cast("string"), F.lit("")), index.cast("string"), F.lit(prefix)))
    return F.concat_ws("_", F.lit(prefix), index.cast("string"), h)


def text_vectors(blocks: DataFrame, index_col: str, source_col: str, page_col: str, text_col: str,
                 embedding_col: str) -> DataFrame:
    return blocks.select(
        make_vector_id("text", F.col(index_col), F.col(source_col)).alias("id"),
        F.col(embedding_col).alias("embedding"),
        F.col(text_col).alias("document"),
        F.lit("text").alias("type"),
        F.col(page_col).cast("int").alias("page"),
        F.col(source_col).cast("string").alias("source"),
        F.lit(None).cast("int").alias("image_index"))


def image_vectors(images: DataFrame, index_col: str, source_col: str, page_col: str, image_index_col: str,
                  embedding_col: str) -> DataFrame:
    return images.select(
        make_vector_id("image", F.col(index_col), F.col(source_col)).alias("id"),
        F.col(embedding_col).alias("embedding"),
        F.format_string("Image from page %d, index %d", F.col(page_col).cast("int"),
                        F.col(image_index_col).cast("int")).alias("document"),
        F.lit("image").alias("type"),
        F.col(page_col).cast("int").alias("page"),
        F.col(source_col).cast("string").alias("source"),
        F.col(image_index_col).cast("int").alias("image_index"))


def build_collection(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


# --------------------------------------------------------------------------
# Nearest neighbours
# --------------------------------------------------------------------------

def knn_topk(collection: DataFrame, query: Sequence[float] | DataFrame, k: int = 5, id_col: str = "id",
             vec_col: str = "embedding", where: Column | None = None) -> DataFrame:
    """Cosine top-k for one query vector: (rank, <id>, distance, ...).  The
    query is a vector or a frame of one row with the column ``vec_col``."""
    c = (collection if where is None else collection.where(where)).where(directed(F.col(vec_col)))
    if isinstance(query, DataFrame):
        one = query.select(F.col(vec_col).alias("_query")).where(directed(F.col("_query"))).limit(1)
        c = c.join(F.broadcast(one))  # one row
    else:
        c = c.withColumn("_query", literal_vector(query)).where(directed(F.col("_query")))
    scored = c.withColumn("distance", cosine_distance(F.col(vec_col), F.col("_query"))).drop("_query")
    top = scored.orderBy("distance", id_col).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy("distance", id_col)))


# --------------------------------------------------------------------------
# Context, messages, chat
# --------------------------------------------------------------------------

# The no-result text, the line between pieces, the frame of an answer.
NO_CONTEXT = "No relevant context found."
CONTEXT_SEPARATOR = "\n---\n"
# Fixed value: the system message that carries the retrieved context.
SYSTEM_PREFIX = ("You are a helpful AI assistant. Use the following context from documents to answer the "
                 "user's question.\nIf the context doesn't contain relevant information, say so clearly.\n\n"
                 "Context:\n")


def context_piece(type_col: Column, page: Column, distance: Column, document: Column) -> Column:
    head = F.when(type_col == "text", F.lit("[Text from page ")).otherwise(F.lit("[Image from page "))
    return F.concat(head, page.cast("string"), F.lit(", relevance: "), fmt2(F.lit(1.0) - distance),
                    F.lit("]\n"), document, F.lit("\n"))


def rag_context(queries: DataFrame, results: DataFrame, query_id: str = "query_id",
                max_context_length: int | None = None) -> DataFrame:
    """Context text per query: pieces in rank order joined by ``\\n---\\n``;
    the running length (separators not counted) stops at the first piece
    that would pass the budget; a query with no result gets the fixed
    no-context text.  The window holds at most k rows per query."""
    r = results.withColumn("_piece", context_piece(F.col("type"), F.col("page"), F.col("distance"),
                                                   F.col("document")))
    kept = F.struct("rank", "_piece")
    if max_context_length is not None:
        # a piece over the budget is never shown: only its length goes on
        r = r.select(query_id, "rank", F.length("_piece").alias("_length"),
                     F.when(F.length("_piece") <= max_context_length, F.col("_piece")).alias("_piece"))
        w = Window.partitionBy(query_id).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
        kept = F.when(F.col("_run") <= max_context_length, kept)
        r = r.withColumn("_run", F.sum("_length").over(w))
    # a query with results has a row here, whatever is kept of them
    ctx = (r.groupBy(query_id).agg(F.array_sort(F.collect_list(kept)).alias("_p"))
           .select(query_id, F.array_join(F.transform("_p", lambda x: x["_piece"]), CONTEXT_SEPARATOR)
                   .alias("context"), F.lit(True).alias("_has")))
    return (queries.select(query_id).join(ctx, query_id, "left")
            .select(query_id, F.when(F.col("_has").isNull(), F.lit(NO_CONTEXT))
                    .otherwise(F.coalesce(F.col("context"), F.lit(""))).alias("context")))


def rag_messages(ctx: DataFrame, questions: DataFrame, query_id: str = "query_id",
                 question_col: str = "question") -> DataFrame:
    """Long form (query_id, pos, role, content): system message with the
    context, then the user question."""
    j = ctx.join(questions.select(query_id, question_col), query_id)
    msgs = F.array(
        F.struct(F.lit("system").alias("role"), F.concat(F.lit(SYSTEM_PREFIX), F.col("context")).alias("content")),
        F.struct(F.lit("user").alias("role"), F.col(question_col).alias("content")))
    return j.select(query_id, F.posexplode(msgs).alias("pos", "m")).select(
        query_id, "pos", F.col("m.role").alias("role"), F.col("m.content").alias("content"))


FIRST_SENTENCE = r"\]\n([^\n.!?]*[.!?]?)"


def extractive_answer(context: Column) -> Column:
    """Default generator: the first sentence of the best-ranked piece."""
    return F.regexp_extract(context, FIRST_SENTENCE, 1)


ANSWER_LEAD, ANSWER_MIDDLE = "Retrieved Context:\n---\n", "\n---\n\nGenerated Answer:\n"


def chat_answer_text(context: Column, response: Column) -> Column:
    return F.concat(F.lit(ANSWER_LEAD), context, F.lit(ANSWER_MIDDLE), response)


Encoder = Callable[[DataFrame, str, str], DataFrame]  # (frame, id, text) -> frame with ``embedding``
Generator = Callable[[Column, Column], Column]  # (question, context) -> answer


def retrieve(questions: DataFrame, collection: DataFrame, encoder: Encoder = embed_text_hash, n_results: int = 5,
             filter_type: str | None = None, query_id: str = "query_id", question_col: str = "question") -> DataFrame:
    """The stored rows nearest to each question, with rank and distance."""
    coll = collection if filter_type is None else collection.where(F.col("type") == filter_type)
    asked = encoder(questions.select(query_id, question_col), query_id, question_col)
    top = materialize(knn_join(materialize(asked, "questions"), coll, n_results, query_id=query_id), "nearest")
    return top.join(coll.select("id", "document", "type", "page"), "id")


def rag_answers(questions: DataFrame, collection: DataFrame, encoder: Encoder = embed_text_hash,
                generator: Generator | None = None, n_results: int = 5, filter_type: str | None = None,
                max_context_length: int | None = None, query_id: str = "query_id", question_col: str = "question") -> DataFrame:
    """The whole pipeline: ``questions`` with ``context`` and ``response``.
    ``encoder`` must be the one that made the collection's vectors; without a
    ``generator`` the answer is the first sentence of the best piece."""
    found = retrieve(questions, collection, encoder, n_results, filter_type, query_id, question_col)
    ctx = rag_context(questions, found, query_id, max_context_length)
    answer = generator(F.col(question_col), F.col("context")) if generator else extractive_answer(F.col("context"))
    return questions.join(ctx, query_id).withColumn("response", answer)


# Chat markup.
IM_START, IM_END = "<|im_start|>", "<|im_end|>"
THINK_OFF = "\n<think>\n\n</think>\n\n"


def chat_wrap(role: Column, text: Column, add_generation_prompt: bool = False,
              add_thinking: bool = False) -> Column:
    parts = [F.lit(IM_START), role, F.lit("\n"), text, F.lit(IM_END + "\n")]
    if add_generation_prompt:
        parts.append(F.lit(IM_START + "assistant" + ("\n" if add_thinking else THINK_OFF)))
    return F.concat(*parts)


def chat_history(conv: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per turn: the wrapped conversation so far, in turn order, and the
    message list (role, content)."""
    w = Window.partitionBy(conv_col).orderBy(turn_col).rowsBetween(Window.unboundedPreceding, 0)
    hist = F.array_sort(F.collect_list(F.struct(F.col(turn_col).alias("t"), F.col(role_col).alias("role"),
                                                F.col(text_col).alias("content"))).over(w))
    return (conv.withColumn("_h", hist)
            .select(conv_col, turn_col,
                    F.transform("_h", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
                    .alias("messages"),
                    F.array_join(F.transform("_h", lambda x: chat_wrap(x["role"], x["content"])), "")
                    .alias("text")))
