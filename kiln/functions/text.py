"""Column expressions for text: strip, hashing keys, formatting.

Everything here is a built-in Spark expression, so it stays inside
whole-stage code generation.  Patterns avoid look-around and ``\\b`` so
that Java regex and RE2 (the SQL oracle) agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (str.isspace),
# as a regex class usable by both Java regex and RE2.
PY_WHITESPACE_CLASS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
STRIP_PATTERN = f"^{PY_WHITESPACE_CLASS}+|{PY_WHITESPACE_CLASS}+$"


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: removes every Unicode blank at both ends."""
    return F.regexp_replace(c, STRIP_PATTERN, "")


def to_str_or_empty(c: Column) -> Column:
    """``str(row.get(k, ""))`` for a missing-or-null field (both map to "")."""
    return F.coalesce(c.cast("string"), F.lit(""))


def seeded_key(seed: int, *cols: Column) -> Column:
    """Portable random order key: md5('<seed>-' || id [|| '-' || id2 ...]).

    Hash based, so a row keeps its key whatever the partitioning and on a
    task retry; DuckDB computes the same digest.
    """
    parts = [F.lit(f"{seed}-")]
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(c.cast("string"))
    return F.md5(F.concat(*parts))


def fmt2(c: Column) -> Column:
    """Python ``f"{x:.2f}"`` for |x| < 1000 (no grouping separators)."""
    return F.format_number(c, 2)
