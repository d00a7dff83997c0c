"""Curation operators: clean, rule labels, quality and prevalence figures,
filters and the ordered samples.

Every operator is ``DataFrame -> DataFrame`` and takes its ordering key
explicitly; nothing depends on how rows happen to be partitioned.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import py_strip, seeded_key, to_str_or_empty

FLAGS = ("llm_has_numbers", "llm_has_non_english", "llm_has_unusual_proper_nouns")
CLASSES = (("numbers", FLAGS[0]), ("non_english", FLAGS[1]), ("unusual_proper_nouns", FLAGS[2]))

# --------------------------------------------------------------------------
# Cleaning and prompts
# --------------------------------------------------------------------------

STRIPPED = ("category", "question", "answer")
STRINGIFIED = ("air_date", "round", "show_number")


def clean_records(df: DataFrame) -> DataFrame:
    """Question-record clean: strip three text fields (Unicode blanks),
    stringify three others (missing or null -> ""), keep ``value``
    untouched and drop old prediction columns."""
    cols = set(df.columns)
    out = {}
    for c in STRIPPED:
        out[c] = py_strip(to_str_or_empty(F.col(c) if c in cols else F.lit(None)))
    for c in STRINGIFIED:
        out[c] = to_str_or_empty(F.col(c) if c in cols else F.lit(None))
    if "value" not in cols:
        out["value"] = F.lit(None).cast("string")
    return df.withColumns(out).drop(*FLAGS)


# Fixed value: the classification prompt, with {category}, {question} and
# {answer} filled from the row.
CLASSIFY_PROMPT = """Analyze this Jeopardy clue and classify it according to three criteria.

Category: {category}
Question: {question}
Answer: {answer}

Classify as true or false for each criterion:

1. has_numbers: Does the text contain any numbers? This includes:
   - Digits (1, 2, 3, 1492, 1.5)
   - Written numbers (one, two, hundred, million)
   - Years, ages
   - Monetary amounts ($100, 5 dollars)
   - Measurements, statistics, quantities

2. has_non_english: Does the text contain non-English words or phrases? This includes:
   - Foreign words/phrases (Latin, French, Spanish, German, Italian, etc.)
   - Loanwords that are clearly foreign (not fully anglicized)
   - Non-English names of places, works, or concepts
   - Words with diacritics or non-Latin characters
   - Scientific Latin names (genus/species)

3. has_unusual_proper_nouns: Does the text contain unusual or obscure proper nouns? This includes:
   - Obscure historical figures (not widely known)
   - Uncommon place names (small towns, obscure geographic features)
   - Specialized terminology names
   - Mythological/religious figures (except very common ones like Jesus, Zeus)
   - Foreign names that would be unfamiliar to average Americans
   - Obscure literary/artistic figures

You must respond with ONLY a valid JSON object in this exact format:
{
  "has_numbers": true/false,
  "has_non_english": true/false,
  "has_unusual_proper_nouns": true/false
}

Do not include any explanation or additional text. Only return the JSON object."""


def template_parts(template: str, fields: Sequence[str]) -> list:
    """Split a template into literal text and field names, in order."""
    parts: list = []
    rest = template
    while True:
        hits = [(rest.find("{" + f + "}"), f) for f in fields if ("{" + f + "}") in rest]
        if not hits:
            parts.append(rest)
            return parts
        pos, f = min(hits)
        parts.append(rest[:pos])
        parts.append(("field", f))
        rest = rest[pos + len(f) + 2:]


def render_template(template: str, **cols: Column) -> Column:
    pieces = []
    for p in template_parts(template, list(cols)):
        if isinstance(p, tuple):
            pieces.append(to_str_or_empty(cols[p[1]]))
        elif p:
            pieces.append(F.lit(p))
    return F.concat(*pieces)


def classify_prompt(category: Column, question: Column, answer: Column) -> Column:
    return render_template(CLASSIFY_PROMPT, category=category, question=question, answer=answer)


# --------------------------------------------------------------------------
# Rule labels (deterministic stand-ins for the three model questions)
# --------------------------------------------------------------------------

# Number words of English, French, German and Spanish, matched
# on the lower-cased text between non-letters.  Words that are articles too
# (un, une, ein, uno ...) are left out.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred hundreds thousand thousands "
    "million millions billion billions trillion "
    "zéro deux trois quatre cinq six sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante "
    "cinquante soixante septante huitante octante nonante cent cents mille million millions milliard milliards "
    "null eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn "
    "achtzehn neunzehn zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend millionen "
    "milliarde milliarden "
    "cero dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete dieciocho "
    "diecinueve veinte veintiuno veintidós veintitrés veinticuatro veinticinco treinta cuarenta cincuenta sesenta setenta "
    "ochenta noventa cien ciento mil millón millones"
).split()

NON_ENGLISH_PATTERN = r"[^\x00-\x7F\P{L}]"  # a letter outside ASCII
SENTENCE_SPLIT = r"[.!?\n]+"
WORD = r"\p{L}+"
CAPITALISED = r"^\p{Lu}"
# a word, then a capitalised one in the same sentence
NAME_PATTERN = r"\p{L}[^.!?\n\p{L}]+\p{Lu}"


def rule_has_numbers(text: Column) -> Column:
    """A digit, or a number word as a whole letter run of the lower-cased
    text."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return text.rlike("[0-9]") | F.arrays_overlap(runs, F.array(*[F.lit(w) for w in NUMBER_WORDS]))


def rule_has_non_english(text: Column) -> Column:
    return text.rlike(NON_ENGLISH_PATTERN)


def foreign_words(docs: DataFrame, text_col: str, lang_col: str, english: str = "en", least: float = 10.83) -> DataFrame:
    """Words (``word``, lower-case letter runs) that go with other languages
    than English, learned from all documents that have a language: those in a
    greater share of the other documents than of the English ones, with a
    log-likelihood ratio of at least ``least`` (one in a thousand by chance).
    Rows of a word are counted before the shuffle."""
    own = docs.where(F.col(lang_col).isNotNull()).select((F.col(lang_col) == english).alias("_en"), F.col(text_col).alias("_text"))
    totals = own.agg(F.count_if("_en").cast("double").alias("_n_en"), F.count_if(~F.col("_en")).cast("double").alias("_n_other"))
    counts = (own.select("_en", F.explode(distinct_words(F.col("_text"))).alias("word"))
              .groupBy("word").agg(F.count_if("_en").cast("double").alias("_a"), F.count_if(~F.col("_en")).cast("double").alias("_b")))
    a, b, n, m = (F.col(c) for c in ("_a", "_b", "_n_en", "_n_other"))
    part = lambda seen, docs_: F.when(seen > 0, seen * F.log(seen * (n + m) / (docs_ * (a + b)))).otherwise(0.0)
    scored = counts.join(F.broadcast(totals))  # one row
    return scored.where((b * n > a * m) & (F.round(2 * (part(a, n) + part(b, m)), 6) >= least)).select("word")


def distinct_words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def rule_foreign_ids(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Ids of documents with a word of ``foreign_words``, which needs no accent
    and no list; the rule for single rows is ``rule_has_non_english``."""
    words = docs.select(id_col, F.explode_outer(distinct_words(F.col(text_col))).alias("word")).where(F.col("word").isNotNull())
    return words.join(foreign_words(docs, text_col, lang_col), "word", "left_semi").select(id_col).distinct()


def rule_has_names(text: Column) -> Column:
    """A capitalised word that does not begin a sentence: what a single row
    can tell about proper nouns without the corpus."""
    return text.rlike(NAME_PATTERN)


# a capitalised word; and one that follows another word of its sentence, found
# from the last letter of that word, which alone is consumed
CAPITALISED_WORD = r"(?<!\p{L})\p{Lu}\p{L}*"
NAME_CANDIDATE = r"\p{L}(?=[^.!?\n\p{L}]+(\p{Lu}\p{L}*))"


def name_words(text: Column) -> tuple[Column, Column]:
    """(capitalised word forms, capitalised forms that do not begin a
    sentence), both distinct per row: one pattern over the text each."""
    return (F.array_distinct(F.regexp_extract_all(text, F.lit(CAPITALISED_WORD), F.lit(0))),
            F.array_distinct(F.regexp_extract_all(text, F.lit(NAME_CANDIDATE), F.lit(1))))


def unusual_from_features(feat: DataFrame, id_col: str, max_df: int = 2) -> DataFrame:
    """Ids of rows with a capitalised non-initial word whose exact form
    occurs in at most ``max_df`` rows.  Only capitalised forms can match a
    capitalised candidate, so only those are exploded.  Rows by word are
    counted with partial aggregation, so a common word is no hot key; the
    join keeps candidates of rare words, which have few rows each.

    ``explode_outer``, as from a plain ``explode`` Spark derives a filter on
    the array's size, which would evaluate the pattern once more below it."""
    word = lambda c: feat.select(F.col(id_col), F.explode_outer(c).alias("word")).where(F.col("word").isNotNull())
    rare = word("_caps").groupBy("word").agg(F.count("*").alias("df")).where(F.col("df") <= max_df)
    return word("_cands").join(rare.select("word"), "word", "left_semi").select(id_col).distinct()


def unusual_name_ids(df: DataFrame, id_col: str, text_col: str, max_df: int = 2) -> DataFrame:
    from ..session import spread
    caps, cands = name_words(F.col(text_col))
    return unusual_from_features(spread(df.select(id_col, text_col), id_col).select(id_col, caps.alias("_caps"), cands.alias("_cands")), id_col, max_df)


def rule_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Everything the rules need from the text, in one pass over it."""
    from ..session import spread
    caps, cands = name_words(F.col(text_col))
    return spread(docs, id_col).select(id_col, *keep, rule_has_numbers(F.col(text_col)).alias(FLAGS[0]),
                                       rule_has_non_english(F.col(text_col)).alias(FLAGS[1]), caps.alias("_caps"), cands.alias("_cands"))


def rule_flags(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               max_df: int = 2, keep: Sequence[str] = (), persist: bool = True) -> DataFrame:
    """Three rule flags per row: numbers, non-English letters, rare names.

    With ``persist`` the per-row features are written once under the
    shared checkpoint folder, so the text is scanned a single time although
    two branches (row flags, corpus word statistics) consume it."""
    feat = rule_features(docs, id_col, text_col, keep)
    if persist:
        from ..session import materialize
        feat = materialize(feat, "rule-features")
    unusual = unusual_from_features(feat, id_col, max_df).withColumn("_u", F.lit(True))
    return (feat.drop("_caps", "_cands").join(unusual, id_col, "left")
            .withColumn(FLAGS[2], F.col("_u").isNotNull()).drop("_u"))


def attach_predictions(rows: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Stored predictions joined to rows by record id; a row without one has
    null flags."""
    return rows.drop(*FLAGS).join(predictions.select(key, *FLAGS), key, "left")


def flagged_documents(docs: DataFrame, labels: DataFrame, max_df: int = 2,
                      keep: Sequence[str] = ("source", "lang")) -> DataFrame:
    """Documents with rule flags standing in for model answers; a document
    without a row in ``labels`` counts as a failed prediction (all null).

    The text itself is not carried on: ``text_md5`` stands for it in
    whole-row value comparisons (the sample's duplicate check); whoever needs
    the records joins the few rows kept back to them by id."""
    d = docs.withColumn("text_md5", F.md5(F.col("text")))
    flags = rule_flags(d, "doc_id", "text", max_df, keep=tuple(keep) + ("text_md5",))
    labelled = labels.select("doc_id").distinct().withColumn("_lab", F.lit(True))
    out = flags.join(labelled, "doc_id", "left")
    return out.select("doc_id", *keep, "text_md5",
                      *[F.when(F.col("_lab"), F.col(c)).alias(c) for c in FLAGS])


# --------------------------------------------------------------------------
# Filters and figures
# --------------------------------------------------------------------------

def is_valid() -> Column:
    return F.coalesce(*[F.col(c) for c in FLAGS]).isNotNull()


def filter_valid(df: DataFrame) -> DataFrame:
    return df.where(is_valid())


def filter_flags(df: DataFrame, has_numbers=None, has_non_english=None,
                 has_unusual_proper_nouns=None) -> DataFrame:
    """Conjunctive filter; ``None`` ignores a flag; null never matches."""
    for c, v in zip(FLAGS, (has_numbers, has_non_english, has_unusual_proper_nouns)):
        if v is not None:
            df = df.where(F.col(c) == F.lit(bool(v)))
    return df


def profile(df: DataFrame, category: str = "category", show: str = "show_number") -> DataFrame:
    return df.agg(
        F.count("*").alias("total_questions"),
        F.count_distinct(F.col(category)).alias("unique_categories"),
        F.count_distinct(F.coalesce(F.col(show).cast("string"), F.lit(""))).alias("unique_shows"))


#: Of the stored sketches: 2^14 registers, a relative error of about 0.8 %.
SKETCH_LG = 14


def store_profile(rows: DataFrame, path: str, slice_name: str, category: str, show: str) -> None:
    """Stores what the profile needs of one slice of the input, its row count
    and a sketch of its distinct values each; storing a slice again replaces
    it.  A new slice reads its own rows only."""
    sketch = lambda c: F.hll_sketch_agg(c, F.lit(SKETCH_LG))
    given = rows.select(F.col(category).cast("string").alias("category"), F.coalesce(F.col(show).cast("string"), F.lit("")).alias("show"))
    given.agg(F.count("*").alias("total"), sketch("category").alias("categories"), sketch("show").alias("shows")).write.mode("overwrite").parquet(f"{path}/slice={slice_name}")


def sketched_profile(spark, path: str) -> DataFrame:
    """The profile from the stored slices, without reading rows: the count is
    exact, distinct values are estimates (exact for small numbers)."""
    schema = T.StructType([T.StructField("total", T.LongType()), T.StructField("categories", T.BinaryType()), T.StructField("shows", T.BinaryType())])
    distinct = lambda c: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0))
    return spark.read.schema(schema).parquet(path).agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total_questions"),
                                                       distinct("categories").alias("unique_categories"), distinct("shows").alias("unique_shows"))


def profile_flags(df: DataFrame) -> DataFrame:
    present = [c for c in FLAGS if c in df.columns]
    return df.agg(*[F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(c.replace("llm_", ""))
                    for c in present])


def _pct(a: Column, b: Column) -> Column:
    return F.when(b > 0, F.round(F.lit(100.0) * a / b, 2)).otherwise(F.lit(0.0))


def classification_quality(df: DataFrame) -> DataFrame:
    failed = F.count_if(~is_valid())
    total = F.count("*")
    return (df.agg(total.alias("total"), F.count_if(is_valid()).alias("successful"), failed.alias("failed"))
            .withColumn("success_rate", _pct(F.col("successful"), F.col("total")))
            .withColumn("failure_rate", _pct(F.col("failed"), F.col("total"))))


def _class_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(is_valid()).alias("valid"),
        *[F.count_if(F.col(c) & is_valid()).alias(name) for name, c in CLASSES])


def _long(counts: DataFrame) -> DataFrame:
    stack = "stack(3, " + ", ".join(f"'{n}', {n}" for n, _ in CLASSES) + ") as (class, classified_count)"
    return counts.selectExpr("total", "valid", stack)


def class_prevalence(df: DataFrame) -> DataFrame:
    """Count and percent of *valid* rows per flag (flags overlap)."""
    return (_long(_class_counts(df)).where(F.col("valid") > 0)
            .select("class", "classified_count",
                    F.round(F.lit(100.0) * F.col("classified_count") / F.col("valid"), 2).alias("percentage")))


def prevalence_estimate(df: DataFrame, total_dataset_size: int | None = None) -> DataFrame:
    """int(share x N) per class, only when N exceeds the valid rows.  With
    ``total_dataset_size=None`` N is the number of input rows."""
    n = F.lit(total_dataset_size) if total_dataset_size is not None else F.col("total")
    return (_long(_class_counts(df)).where((F.col("valid") > 0) & (n > F.col("valid")))
            .select("class",
                    (F.col("classified_count") / F.col("valid") * n).cast("bigint").alias("estimated_count"),
                    F.round(F.lit(100.0) * F.col("classified_count") / F.col("valid"), 2).alias("percentage")))


# --------------------------------------------------------------------------
# Ordered samples
# --------------------------------------------------------------------------

def strata_counts(df: DataFrame, stratum: str) -> DataFrame:
    return df.groupBy(stratum).agg(F.count("*").alias("cnt"))


SALTS = 64


def _key(*cols: str) -> Column:
    """Columns as one value that is never null, for plain equi-joins."""
    return F.md5(F.to_json(F.struct(*cols)))


def _first_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, name: str, spread_by: str) -> DataFrame:
    """The first ``n`` rows of each group in ``order``, numbered in ``name``.
    Spark keeps n rows a group and task before each shuffle; the first pick is
    made in ``SALTS`` parts of a group, so that the last one sees at most
    SALTS x n rows, however many tasks and rows there are."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)))
    part = F.row_number().over(Window.partitionBy(*by, "_salt").orderBy(*order))
    few = salted.withColumn("_part", part).where(F.col("_part") <= n).drop("_part", "_salt")
    return few.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= n)


def _quotas(keys: DataFrame, n: int, mode: str) -> DataFrame:
    """``_g, _s, _cnt, _first, _total, _quota`` of each group and stratum."""
    counts = keys.groupBy("_g", "_s").agg(F.count("*").alias("_cnt"), F.min("_o").alias("_first"))
    totals = counts.groupBy("_g").agg(F.sum("_cnt").alias("_total"))
    quota = counts.join(totals, "_g").withColumn("_base", F.expr(f"{n}L * _cnt div _total"))
    if mode == "first":
        return quota.withColumn("_quota", F.greatest(F.lit(1).cast("bigint"), "_base")).drop("_base")
    # the largest remainders get one more each until n rows are given out
    left = quota.groupBy("_g").agg((F.lit(n) - F.sum("_base")).alias("_left"))
    rest = quota.withColumn("_rest", F.expr(f"{n}L * _cnt % _total"))
    more = (_first_n(rest, ["_g"], [F.desc("_rest"), F.asc("_s")], n, "_place", "_s").join(left, "_g")
            .where(F.col("_place") <= F.col("_left")).select("_g", "_s", F.lit(1).alias("_more")))
    return quota.join(more, ["_g", "_s"], "left").withColumn("_quota", F.col("_base") + F.coalesce("_more", F.lit(0))).drop("_base", "_more")


def head_per_stratum(df: DataFrame, n: int, stratum: str, order: str) -> DataFrame:
    """First ``quota`` rows of every stratum in ``order``, with
    quota = max(1, n * count div total): (<df's columns>, rk)."""
    keys = df.select(F.lit("").alias("_g"), _key(stratum).alias("_s"), F.col(order).alias("_o"))
    ranked = _first_n(keys, ["_g", "_s"], [F.asc("_o")], n, "rk", "_o")
    kept = ranked.join(_quotas(keys, n, "first"), ["_g", "_s"]).where(F.col("rk") <= F.col("_quota"))
    return df.join(kept.select(F.col("_o").alias(order), "rk"), order)


def stratified_sample(df: DataFrame, n: int, stratum: str, order: str,
                      value_cols: Sequence[str] | None = None,
                      groups: Sequence[str] = (), mode: str = "first", seed: int = 42) -> DataFrame:
    """Stratified sample of n rows of each group (all rows of a smaller one).

    ``mode="first"`` is the curation tool's rule: quota = max(1, int(n *
    count / rows)) a stratum; strata in first-seen order, the first
    min(quota, count) rows of each; if these are more than n, the first n of
    that list; if fewer, rows in input order whose value (``value_cols``,
    null-safe) is not sampled yet, up to n.  ``mode="proportional"`` gives
    each stratum its share of n by largest remainders and takes rows by a
    seeded hash.

    ``order`` is the input order and unique within a group.  All ranking is
    done on keys (group, stratum, order and a digest of the value); the few
    rows picked are then joined back to ``df``.  No window holds more than
    SALTS x n keys a group.
    """
    if mode not in ("first", "proportional"):
        raise ValueError(f"mode must be 'first' or 'proportional', not {mode!r}")
    vals = list(value_cols) if value_cols is not None else [c for c in df.columns if c != order]
    keys = df.select(_key(*groups).alias("_g") if groups else F.lit("").alias("_g"), _key(stratum).alias("_s"),
                     F.col(order).alias("_o"), _key(*vals).alias("_v"))
    by = [F.asc("_o")] if mode == "first" else [F.asc(seeded_key(seed, F.col("_o"))), F.asc("_o")]
    quota = _quotas(keys, n, mode)
    ranked = _first_n(keys, ["_g", "_s"], by, n, "_rk", "_o")
    phase0 = ranked.join(quota.where(F.col("_total") > n), ["_g", "_s"]).where(F.col("_rk") <= F.col("_quota"))
    phase0 = _first_n(phase0, ["_g"], [F.asc("_first"), F.asc("_rk"), F.asc("_s")], n, "_n0", "_o")
    if mode == "first":
        # what fills up a short list, and the whole of a small group; equal
        # values are not added again
        rest = _first_n(keys.join(phase0.select("_g", "_v"), ["_g", "_v"], "left_anti"), ["_g"], by, n, "_at", "_o")
        both = phase0.select("_g", "_o", F.lit(0).alias("_ph"), F.col("_n0").alias("_at")).unionByName(
            rest.select("_g", "_o", F.lit(1).alias("_ph"), "_at"))
        picked = _first_n(both, ["_g"], [F.asc("_ph"), F.asc("_at")], n, "_pick", "_o").select("_g", "_o")
    else:
        small = quota.where(F.col("_total") <= n).select("_g").distinct()
        picked = phase0.select("_g", "_o").unionByName(
            _first_n(keys, ["_g"], [F.asc("_o")], n, "_at", "_o").join(small, "_g").select("_g", "_o"))
    whole = df.withColumn("_g", _key(*groups) if groups else F.lit("")).withColumn("_o", F.col(order))
    return whole.join(picked, ["_g", "_o"], "left_semi").select(*df.columns)


def sample_exact(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """Uniform sample of exactly n rows without replacement; asking for more
    rows than there are is an error.  Hash key per row, so the pick is independent of partitioning;
    plans as TakeOrderedAndProject (n rows per task to the final merge)."""
    if (rows := df.count()) < n:
        raise ValueError(f"sample of {n} asked from {rows} rows")
    return (df.withColumn("_k", seeded_key(seed, F.col(id_col)))
            .orderBy("_k", id_col).limit(n).drop("_k"))


# --------------------------------------------------------------------------
# Curated datasets and the statistics document
# --------------------------------------------------------------------------

def route_datasets(valid: DataFrame) -> DataFrame:
    """One row per (dataset, row) for the three overlapping outputs."""
    tags = F.filter(F.array(*[F.when(F.col(c) == F.lit(True), F.lit(name)) for name, c in CLASSES]),
                    lambda x: x.isNotNull())
    return valid.withColumn("dataset", F.explode(tags))


def curated_datasets(flagged: DataFrame, n: int, stratum: str, order: str,
                     value_cols: Sequence[str] | None = None, records: DataFrame | None = None) -> DataFrame:
    """The three samples, one row per (dataset, row).  With ``records`` the
    rows carry all columns of their record (joined by ``order``, the id)."""
    routed = route_datasets(filter_valid(flagged))
    vals = list(value_cols) if value_cols is not None else [c for c in flagged.columns if c != order]
    picked = stratified_sample(routed, n, stratum, order, vals, groups=["dataset"])
    if records is None:
        return picked
    return picked.select("dataset", order, *FLAGS).join(records.drop(*FLAGS), order)


def curation_stats(flagged: DataFrame, samples: DataFrame | None,
                   total_dataset_size: int | None = None) -> DataFrame:
    """The statistics document as one flat row, from a single aggregation
    over the flagged rows and the curated samples."""
    a = flagged.select(F.lit("row").alias("_kind"), *FLAGS, F.lit(None).cast("string").alias("dataset"))
    parts = a
    if samples is not None:
        parts = a.unionByName(samples.select(
            F.lit("sample").alias("_kind"), *[F.lit(None).cast("boolean").alias(c) for c in FLAGS],
            F.col("dataset")))
    row = F.col("_kind") == "row"
    agg = parts.agg(
        F.count_if(row).alias("total"),
        F.count_if(row & is_valid()).alias("valid_predictions"),
        *[F.count_if(row & is_valid() & F.col(c)).alias(f"{name}_classified_count") for name, c in CLASSES],
        *[F.count_if((F.col("_kind") == "sample") & (F.col("dataset") == name)).alias(f"{name}_sample_size")
          for name, _ in CLASSES])
    valid = F.col("valid_predictions")
    n_full = F.lit(total_dataset_size) if total_dataset_size is not None else F.col("total")
    has_valid = valid > 0
    show_est = has_valid & n_full.isNotNull() & (n_full > valid)
    cols = [
        F.col("total"), (valid).alias("successful"), (F.col("total") - valid).alias("failed"),
        _pct(valid, F.col("total")).alias("success_rate"),
        _pct(F.col("total") - valid, F.col("total")).alias("failure_rate"),
        F.col("total").alias("total_questions"), valid.alias("valid_predictions"),
    ]
    for name, _ in CLASSES:
        cnt = F.col(f"{name}_classified_count")
        pct = F.round(F.lit(100.0) * cnt / valid, 2)
        cols += [F.when(has_valid, cnt).alias(f"{name}_classified_count"),
                 F.when(has_valid, pct).alias(f"{name}_percentage_of_valid"),
                 F.when(has_valid, F.col(f"{name}_sample_size")).alias(f"{name}_sample_size")]
    cols.append(F.when(show_est, n_full).cast("bigint").alias("estimate_total_size"))
    for name, _ in CLASSES:
        cnt = F.col(f"{name}_classified_count")
        cols += [F.when(show_est, (cnt / valid * n_full).cast("bigint")).alias(f"{name}_estimated_count"),
                 F.when(show_est, F.round(F.lit(100.0) * cnt / valid, 2)).alias(f"{name}_estimate_percentage")]
    cols.append(F.when(~has_valid, F.lit("No valid predictions - all classifications failed")).alias("error"))
    return agg.select(*cols)


def curation_stats_document(flat: DataFrame) -> DataFrame:
    """Nest the flat statistics row into the document shape (for the JSON
    sink): optional blocks are null when absent."""
    def cls(name):
        return F.when(F.col("error").isNull(), F.struct(
            F.col(f"{name}_classified_count").alias("classified_count"),
            F.col(f"{name}_percentage_of_valid").alias("percentage_of_valid"),
            F.col(f"{name}_sample_size").alias("sample_size")))

    def est(name):
        return F.struct(F.col(f"{name}_estimated_count").alias("estimated_count"),
                        F.col(f"{name}_estimate_percentage").alias("percentage"))

    return flat.select(
        F.struct("total", "successful", "failed", "success_rate", "failure_rate").alias("classification_quality"),
        F.struct("total_questions", "valid_predictions").alias("classified_dataset"),
        *[cls(n).alias(n) for n, _ in CLASSES],
        F.when(F.col("estimate_total_size").isNotNull(), F.struct(
            F.col("estimate_total_size").alias("total_size"), *[est(n).alias(n) for n, _ in CLASSES]))
        .alias("full_dataset_estimates"),
        "error")
