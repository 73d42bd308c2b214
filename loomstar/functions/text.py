"""String predicates and repairs as built-in column expressions (X-01 .. X-05, X-13, X-21).

None of these is a UDF.  Each is available as SQL text (``*_sql``, taking a
column name) for operators that rewrite many columns in one ``selectExpr``,
and as a ``Column`` for direct use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstar.functions.sql import ident, text

# Fixed value: a junk cell is exactly ten upper-case letters or digits.  The
# optional final newline mirrors ``$`` in the original pattern, which also
# matches before a trailing newline; ``\z`` anchors at the true end.
JUNK_CODE = r"^[A-Z0-9]{10}\n?\z"


def junk_sql(name: str, dtype: T.DataType | None = None) -> str:
    """X-01 as SQL: the text form of the cell is a junk code (NULL -> false).

    With the column's type known the test is cheaper: an integer's text is a
    code exactly when it has ten digits, and fractional, temporal and boolean
    values never print as ten letters or digits.  Text is length-checked
    before the regular expression runs.
    """
    c = ident(name)
    if isinstance(dtype, T.IntegralType):
        return f"coalesce({c} BETWEEN 1000000000 AND 9999999999, false)"
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DateType, T.TimestampType,
                          T.TimestampNTZType, T.BooleanType)):
        return "false"
    t = f"CAST({c} AS STRING)"
    return f"coalesce(length({t}) BETWEEN 10 AND 11 AND {t} RLIKE {text(JUNK_CODE)}, false)"


def null_if_junk_sql(name: str, dtype: T.DataType | None = None) -> str:
    """F-03 for one cell as SQL: NULL when the cell is a junk code (type kept)."""
    return f"CASE WHEN NOT {junk_sql(name, dtype)} THEN {ident(name)} END"


def is_junk_code(name: str, dtype: T.DataType | None = None) -> Column:
    return F.expr(junk_sql(name, dtype))


def null_if_junk(name: str, dtype: T.DataType | None = None) -> Column:
    return F.expr(null_if_junk_sql(name, dtype))


def newlines_to_commas_sql(name: str) -> str:
    """X-02: every newline becomes ``", "``."""
    return f"replace({ident(name)}, {text(chr(10))}, ', ')"


def strip_literal_sql(name: str, value: str) -> str:
    """X-02: delete every occurrence of ``value`` (e.g. the pound sign)."""
    return f"replace({ident(name)}, {text(value)}, '')"


def strip_question_marks_sql(name: str) -> str:
    """X-03: delete runs of ``?``."""
    return f"regexp_replace({ident(name)}, {text('[?]+')}, '')"


def strip_letters_sql(name: str) -> str:
    """X-04: delete every run of ASCII letters, leaving digits and the rest."""
    return f"regexp_replace({ident(name)}, {text('[A-Za-z]+')}, '')"


def strip_leading_lower_sql(name: str) -> str:
    """X-05: delete one leading run of lower-case letters (``eeEurope`` -> ``Europe``)."""
    return f"regexp_replace({ident(name)}, {text('^[a-z]+')}, '')"


def equals_flag_sql(name: str, value: str) -> str:
    """X-13: ``c == value`` with a missing cell giving false, never NULL."""
    return f"{ident(name)} <=> {text(value)}"


def newlines_to_commas(name: str) -> Column:
    return F.expr(newlines_to_commas_sql(name))


def strip_literal(name: str, value: str) -> Column:
    return F.expr(strip_literal_sql(name, value))


def strip_question_marks(name: str) -> Column:
    return F.expr(strip_question_marks_sql(name))


def strip_letters(name: str) -> Column:
    return F.expr(strip_letters_sql(name))


def strip_leading_lower(name: str) -> Column:
    return F.expr(strip_leading_lower_sql(name))


def equals_flag(name: str, value: str) -> Column:
    return F.expr(equals_flag_sql(name, value))
