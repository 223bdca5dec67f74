"""Text functions (SCL-07, SCL-08, SCL-09, SCL-10).

Whole texts are processed; nothing is truncated.  All are JVM expressions
inside whole-stage codegen (note: Spark rewrites ``regexp_count`` to
``size(regexp_extract_all(...))``, so a word count does build the token
array per text, on the executor).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a run of Unicode letters, digits, underscore or
# apostrophe (the same set as Python's ``[\w']+`` with re.UNICODE).
WORD_PATTERN = r"[\p{L}\p{N}_']+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_tokens(x) -> Column:
    """SCL-07: array of word tokens."""
    return F.regexp_extract_all(_col(x), F.lit(WORD_PATTERN), F.lit(0))


def word_count(x) -> Column:
    """SCL-07 + SCL-08: number of word tokens."""
    return F.regexp_count(_col(x), F.lit(WORD_PATTERN))


def newline_count(x) -> Column:
    x = _col(x)
    return F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit("")))


def split_line_count(x) -> Column:
    """SCL-09: ``len(text.split('\\n'))`` = newlines + 1 (empty text is 1,
    a trailing newline adds an empty last line)."""
    return newline_count(x) + F.lit(1)


def text_file_line_count(x) -> Column:
    """AGG-05 semantics: lines as a text reader sees them; a final newline
    ends the last line instead of starting an empty one; empty text has 0."""
    x = _col(x)
    n = newline_count(x)
    ends_nl = F.endswith(x, F.lit("\n"))
    return (F.when(F.length(x) == 0, F.lit(0))
            .when(ends_nl, n)
            .otherwise(n + F.lit(1)))


def utf8_text(b, strict: bool = False) -> Column:
    """SCL-10: bytes -> UTF-8 string.  The default is tolerant: invalid byte
    sequences give null instead of failing the task; ``strict=True`` raises."""
    b = _col(b)
    if strict:
        return F.decode(b, "UTF-8")
    return F.try_validate_utf8(b.cast("string"))
