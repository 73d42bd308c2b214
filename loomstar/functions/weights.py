"""Product weight text -> kilograms (C-06: X-02, X-06 .. X-11, U-02).

``"12 x 100g"`` -> spaces removed, ``x`` -> ``*`` -> unit ``g``, number
``12*100`` -> 1200 -> 1.2 kg.  The number is the leftmost match of
*decimal* | *int\\*int* | *int*, tried in that order at each position, so a
decimal pack such as ``12*1.5kg`` reads as ``12*1`` (kept for compatibility;
``strict_multipack=True`` also accepts decimal factors).  Unknown units give
NULL and keep the row.  All built-in expressions, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomstar.functions.sql import ident, text

# Unit factors to kilograms (case-sensitive).
UNIT_TO_KG = {"g": 0.001, "ml": 0.001, "oz": 0.028349523125, "kg": 1.0}

# Extraction patterns.
UNIT_PATTERN = r"([a-zA-Z]+)"
NUMBER_PATTERN = r"([0-9]+\.[0-9]+|[0-9]+\*[0-9]+|[0-9]+)"
NUMBER_PATTERN_STRICT = r"([0-9]+(?:\.[0-9]+)?\*[0-9]+(?:\.[0-9]+)?|[0-9]+\.[0-9]+|[0-9]+)"


def normalised_text_sql(name: str) -> str:
    """Remove spaces and turn the multipack ``x`` into ``*``."""
    return f"replace(replace({ident(name)}, ' ', ''), 'x', '*')"


def weight_unit_sql(t: str) -> str:
    """X-06: first run of letters in SQL text ``t``; NULL when there is none."""
    return f"nullif(regexp_extract({t}, {text(UNIT_PATTERN)}, 1), '')"


def weight_number_sql(t: str, strict_multipack: bool = False) -> str:
    """X-07: the number part as text; NULL when there are no digits (Q-06)."""
    pattern = NUMBER_PATTERN_STRICT if strict_multipack else NUMBER_PATTERN
    return f"nullif(regexp_extract({t}, {text(pattern)}, 1), '')"


def multipack_sql(n: str) -> str:
    """X-08 / X-09: ``a*b`` -> a times b, plain numbers -> DOUBLE."""
    return (f"CASE WHEN instr({n}, '*') > 0 "
            f"THEN CAST(split_part({n}, '*', 1) AS DOUBLE) * CAST(split_part({n}, '*', 2) AS DOUBLE) "
            f"ELSE CAST({n} AS DOUBLE) END")


def unit_factor_sql(unit: str) -> str:
    """X-10: literal map lookup; a missing key gives NULL (even under ANSI)."""
    pairs = ", ".join(f"{text(k)}, CAST({v!r} AS DOUBLE)" for k, v in UNIT_TO_KG.items())
    return f"try_element_at(map({pairs}), {unit})"


def weight_kg_sql(name: str, strict_multipack: bool = False) -> str:
    """C-06 for one cell: weight text -> kilograms (DOUBLE) or NULL."""
    t = normalised_text_sql(name)
    number = multipack_sql(weight_number_sql(t, strict_multipack))
    return f"{unit_factor_sql(weight_unit_sql(t))} * ({number})"


def multipack_amount(name: str) -> Column:
    """The number of a weight text with packs multiplied out (no unit applied)."""
    return F.expr(multipack_sql(weight_number_sql(normalised_text_sql(name))))


def weight_kg(name: str, strict_multipack: bool = False) -> Column:
    return F.expr(weight_kg_sql(name, strict_multipack))
