"""Helpers for writing column expressions as Spark SQL text.

Operators that touch every column build their expressions as SQL text and
apply them with one ``selectExpr``: the same built-in functions, analysed in
one step instead of one driver round trip per function call.
"""

from __future__ import annotations


def ident(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A Python string as a Spark SQL string literal (backslash escapes processed)."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r")
    return "'" + escaped + "'"


def as_col(sql: str, name: str) -> str:
    """``<sql> AS `name```, for ``selectExpr``."""
    return f"{sql} AS {ident(name)}"
