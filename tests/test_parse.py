"""Model-answer parsing: the truth table of FIXTURES 1.2."""
import pytest
from pyspark.sql import functions as F

from kiln.functions.json_flags import json_span, parse_flag_columns

CASES = [
    ('ok {"has_numbers": true, "has_non_english": false, "has_unusual_proper_nouns": null} end', (True, False, False)),
    ('{"has_numbers":"false","x":{"y":1}}', (True, False, False)),
    ('{"has_numbers": 0, "has_non_english": [1], "has_unusual_proper_nouns": ""}', (False, True, False)),
    ('{"has_unusual_proper_nouns": true, "has_numbers": true}', (True, False, True)),
    ("{}", (False, False, False)),
    ("{bad", (None, None, None)),
    ("no json", (None, None, None)),
    ("", (None, None, None)),
    (None, (None, None, None)),
    ('{"a": 1} text {"b": 2}', (None, None, None)),
    ('{"has_numbers": tru, "has_non_english": false, "has_unusual_proper_nouns": false}', (None, None, None)),
    ('{"has_numbers": [], "has_non_english": {}, "has_unusual_proper_nouns": 2.5}', (False, False, True)),
    ('{"has_numbers": true, "has_numbers": false}', (False, False, False)),
    ('  \n {"has_numbers": 1}\t', (True, False, False)),
    ('{"has_numbers": {"a": 1, "a": 2}, "has_non_english": NaN, "has_unusual_proper_nouns": -Infinity}', (True, True, True)),
    ('{"has_numbers": NaN} }', (None, None, None)),
    ("{" * 3000 + "}", (None, None, None)),
]


@pytest.mark.parametrize("repeated", ["true", "false", None])
def test_parse_flags(spark, repeated):
    """The same in any session, also in one that rejects repeated keys."""
    name = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, repeated) if repeated else spark.conf.unset(name)
        df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, text string")
        found = {r[0]: tuple(r)[1:] for r in df.select("i", *parse_flag_columns(F.col("text"))).collect()}
    finally:
        spark.conf.set(name, before)
    assert [found[i] for i in range(len(CASES))] == [expected for _, expected in CASES]


def test_strict_pattern_wins_without_fallback(spark):
    # the strict pattern matches but is not valid JSON: no fallback to the
    # wider span, even though that one would parse
    text = '{"ok": {"has_numbers": 1, "has_non_english": 2, "has_unusual_proper_nouns": x}}'
    df = spark.createDataFrame([(text,)], "text string")
    span = df.select(json_span(F.col("text"))).first()[0]
    assert span.startswith('{"has_numbers"')
    assert tuple(df.select(*parse_flag_columns(F.col("text"))).first()) == (None, None, None)
