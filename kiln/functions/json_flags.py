"""Model-answer parsing as column expressions.

Locating the JSON object and turning its values into booleans follows the
curation tool's rules: a strict three-key pattern first, else the span from
the first ``{`` to the last ``}``; values use Python truthiness, so the
*string* "false" is true; a missing key is false; anything that fails to
parse gives null in all three flags.

Answers are parsed by Spark; only those that it rejects go to Python's parser,
whose word is final: it also takes repeated keys (the last counts) and the
literals NaN and Infinity.  So the result does not depend on any setting of
the session.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip

FLAG_KEYS = ("has_numbers", "has_non_english", "has_unusual_proper_nouns")

# Fixed value: the strict response pattern (three keys in this order, no
# nested braces).
STRICT_PATTERN = (
    r'(?s)\{[^{}]*"has_numbers"[^{}]*"has_non_english"[^{}]*"has_unusual_proper_nouns"[^{}]*\}'
)
FALLBACK_PATTERN = r"(?s)\{.*\}"


def json_span(text: Column) -> Column:
    """The JSON text to parse, or null when there is none."""
    t = py_strip(text)
    strict = F.regexp_extract(t, STRICT_PATTERN, 0)
    loose = F.regexp_extract(t, FALLBACK_PATTERN, 0)
    return F.when(strict != "", strict).when(loose != "", loose)


def _truthy(v: Column) -> Column:
    """Python bool() of one variant value; null (missing) -> false."""
    t = F.schema_of_variant(v)
    js = F.to_json(v)
    return (
        F.when(v.isNull() | (t == "VOID"), F.lit(False))
        .when(t == "BOOLEAN", js == "true")
        .when(t == "STRING", js != '""')
        .when(t.isin("BIGINT", "DOUBLE", "FLOAT") | t.startswith("DECIMAL"),
              F.try_variant_get(v, "$", "double") != 0)
        .otherwise(~js.isin("[]", "{}"))
    )


def _flags_of(span: str | None) -> list[bool] | None:
    try:
        found = None if span is None else json.loads(span)
    except (ValueError, RecursionError):
        return None
    return [bool(found.get(k, False)) for k in FLAG_KEYS] if isinstance(found, dict) else None


def _parsed_in_python(spans: Column) -> Column:
    @F.arrow_udf("array<boolean>")
    def parsed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_flags_of(s) for s in batch.to_pylist()], pa.list_(pa.bool_()))

    return parsed(spans)


def parse_flag_columns(text: Column, prefix: str = "") -> list[Column]:
    """Three boolean columns (nullable) parsed from a model answer.

    Spark's JSON parser stops after the first value and ignores what
    follows; Python's rejects trailing text.  The span (which starts with
    ``{`` and ends with ``}``) is therefore accepted only if it parses and
    the span without its last character does not, i.e. the first value
    ends exactly at the end of the span."""
    span = json_span(text)
    doc = F.try_parse_json(span)
    whole = F.try_parse_json(F.substring(span, F.lit(1), F.length(span) - 1))
    ok = F.coalesce(doc.isNotNull() & whole.isNull() & F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))
    rest = _parsed_in_python(F.when(~ok, span))
    out = []
    for i, k in enumerate(FLAG_KEYS):
        v = F.try_variant_get(doc, f"$.{k}", "variant")
        out.append(F.when(ok, _truthy(v)).otherwise(rest[i]).alias(prefix + k))
    return out
