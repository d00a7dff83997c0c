"""Model application with a caller-supplied predictor, and resumable runs.

``predict(prompts: list[str]) -> list[str]`` is called inside the executors
with at most ``batch_size`` prompts at a time.  Any exception empties the
answers of that whole batch, as in the curation tool, and is recorded; the
parsed flags of those rows are null.  Predictions are written out before any
reuse, so the model runs once per row even when later steps read the result
several times.
"""

from __future__ import annotations

import re
from typing import Callable, Sequence

import pyarrow as pa
import regex
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_flags import parse_flag_columns
from ..session import clear_scratch, scratch_path
from .curation import FLAGS, classify_prompt

Predictor = Callable[[Sequence[str]], Sequence[str]]

_QUESTION = re.compile(r"\nQuestion: (.*)\nAnswer: ", re.S)
_DIGIT, _FOREIGN = re.compile("[0-9]"), re.compile(r"[^\x00-\x7f]")
_NAME = regex.compile(r"\p{L}[^.!?\n\p{L}]+\p{Lu}")


def rule_predictor(prompts: Sequence[str]) -> list[str]:
    """Deterministic stand-in for a language model: reads the question back
    out of the prompt and answers the three questions with simple rules (a
    digit; a letter outside ASCII; a capitalised word within a sentence)."""
    out = []
    for p in prompts:
        m = _QUESTION.search(p)
        q = m.group(1) if m else ""
        answers = (bool(_DIGIT.search(q)), any(ch[0].isalpha() for ch in _FOREIGN.finditer(q)), bool(_NAME.search(q)))
        out.append('{"has_numbers": %s, "has_non_english": %s, "has_unusual_proper_nouns": %s}' % tuple(str(a).lower() for a in answers))
    return out


def answer_with_model(df: DataFrame, prompt_col: str, predict: Predictor,
                      keep: Sequence[str], batch_size: int = 256) -> DataFrame:
    """Adds ``response`` (null for a failed batch) and ``error`` (why)."""
    cols = list(keep)
    given = df.select(*cols, F.col(prompt_col).alias("_asked"))
    schema = T.StructType([*(given.schema[c] for c in cols), T.StructField("response", T.StringType()), T.StructField("error", T.StringType())])

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, batch_size):
                b = whole.slice(lo, batch_size)
                failed = None
                try:
                    answers = list(predict(b.column("_asked").to_pylist()))
                    if len(answers) != b.num_rows:
                        raise ValueError(f"{len(answers)} answers to {b.num_rows} prompts")
                except Exception as e:  # noqa: BLE001 - a failed batch gives null answers
                    answers, failed = [None] * b.num_rows, f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in cols), pa.array(answers, pa.string()), pa.array([failed] * b.num_rows, pa.string())],
                                                 [*cols, "response", "error"])

    return given.mapInArrow(run, schema)


def classify_with_model(records: DataFrame, key: str, predict: Predictor = rule_predictor, batch_size: int = 256,
                        keep: Sequence[str] = ()) -> DataFrame:
    """Cleaned question records -> (key, three flags, error, and ``keep``)
    through the model."""
    prompts = records.select(key, *keep, classify_prompt(F.col("category"), F.col("question"), F.col("answer"))
                             .alias("_prompt"))
    answered = answer_with_model(prompts, "_prompt", predict, [key, *keep], batch_size)
    return answered.select(key, *parse_flag_columns(F.col("response"), prefix="llm_"), "error", *keep)


def stored_predictions(spark, path: str, key_type: T.DataType, key: str) -> DataFrame:
    """What is stored: (key, three flags, error), none where nothing is."""
    schema = T.StructType([T.StructField(key, key_type), *(T.StructField(c, T.BooleanType()) for c in FLAGS), T.StructField("error", T.StringType())])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def classify_resume(records: DataFrame, key: str, predictions_path: str,
                    predict: Predictor = rule_predictor, slices: int = 8, batch_size: int = 256) -> DataFrame:
    """Classifies the rows without a stored answer and returns (key, three
    flags) of all stored rows.

    The rows to ask are found and cut into ``slices`` by a hash of their key
    in one pass, written once; each slice is a job of its own that reads only
    its folder and appends its predictions in one commit, so a run that is
    killed keeps every slice it has finished and the next run goes on from
    there.  A row whose batch failed is stored with the reason and asked
    again by the next run."""
    spark = records.sparkSession
    kind = records.schema[key].dataType
    done = stored_predictions(spark, predictions_path, kind, key).where("error IS NULL").select(key)
    todo = records.join(done, key, "left_anti").withColumn("_slice", F.pmod(F.xxhash64(key), F.lit(slices)).cast("int"))
    asked = scratch_path(spark, "to-ask")
    todo.write.partitionBy("_slice").parquet(asked)
    whole = spark.read.schema(todo.schema).parquet(asked)
    for i in range(slices):
        part = whole.where(F.col("_slice") == i).drop("_slice")  # reads one folder
        classify_with_model(part, key, predict, batch_size).write.mode("append").parquet(predictions_path)
    clear_scratch(spark, [asked])
    answered = F.col("error").isNull()
    return (stored_predictions(spark, predictions_path, kind, key).groupBy(key)
            .agg(F.max_by(F.struct(*FLAGS), answered).alias("_best")).select(key, "_best.*"))
