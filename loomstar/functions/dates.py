"""Date and time construction (X-16, X-17, X-18, C-01's parser).

Free-form ("mixed") date text is read by a grammar, not by a list of layouts: the
time of day (with its zone) is taken out, words that say nothing more (weekdays,
ordinal endings, commas) go, and what is left are one to three tokens, numbers and
at most one month word.  Which number is the year, the month and the day follows from
their widths, sizes and places: ``03/04/2005`` is month first (4 March), ``13/04/2005``
can only be day first (13 April).  The work for a value does not depend on how
many layouts there are.  ISO dates and times take a short way of one test and one cast.

A time zone is accepted and the time kept as written.  Values outside 1677-2262 (the
range a nanosecond timestamp can hold in the original tool chain) are treated as
unparsable, and so is text without a year.  All built-ins: no UDF, one pass.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomstar.functions.sql import ident, text

MIN_YEAR, MAX_YEAR = 1677, 2262

# Month and weekday names, words that may stand between the parts of a date.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
          "november", "december")
WEEKDAYS = ("monday", "mon", "tuesday", "tues", "tue", "wednesday", "wed", "thursday", "thurs", "thur", "thu", "friday",
            "fri", "saturday", "sat", "sunday", "sun")
FILLERS = ("of", "at", "on", "and", "ad")

#: A month word and its number: the whole name, its first three letters, and ``sept``.
_MONTH_NUMBERS = {**{m[:3]: i for i, m in enumerate(MONTHS, 1)}, **{m: i for i, m in enumerate(MONTHS, 1)}, "sept": 9}

_ZONE = r"(?:\s*(?:z|utc|gmt))?(?:\s*[+-][0-9]{1,2}(?::?[0-9]{2})?)?(?![0-9a-z:])"
#: A time of day: with colons, by am/pm alone, in digits after a T, at the end of a digit run, or the hour after an ISO date.
_TIME = "|".join((
    r"(?:(?<=[0-9])t|(?<![0-9:.t]))([0-9]{1,2}):([0-9]{1,2})(?::([0-9]{1,2})(?:[.,]([0-9]+))?)?(?:\s*([ap])m?(?![a-z]))?" + _ZONE,
    r"(?<![0-9:.])([0-9]{1,2})\s*([ap])m(?![a-z])",
    r"(?<=[0-9])t([0-9]{2})([0-9]{2})?([0-9]{2})?" + _ZONE,
    r"(?<=^[0-9]{8})([0-9]{2})([0-9]{2})([0-9]{2})?$",
    r"(?<=^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2})\s([0-9]{1,2})$",
))
#: The time between marks, its fields apart: hour, minute, second, fraction, a or p.
_MARKED = "@$1$6$8$11$14:$2$9$12:$3$10$13:$4:$5$7@"
_NOISE = (rf"(?<![a-z])(?:{'|'.join(WEEKDAYS + FILLERS)})(?![a-z])[.]?|(?<=[0-9])(?:st|nd|rd|th)(?![a-z])|[,;]")
_TOKENS = r"^\s*[0-9a-z]+(?:[\s./-]*[0-9a-z]+)*[\s.]*$"
_ISO = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:[ T][0-9]{1,2}:[0-9]{1,2}(?::[0-9]{1,2}(?:[.][0-9]+)?)?Z?)?$"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``value``, evaluated once, as ``name``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _struct(**fields: str) -> str:
    return f"named_struct({', '.join(f'{text(k)}, {v}' for k, v in fields.items())})"


def _assembled(d: str, time: str) -> str:
    """The timestamp of tokens ``d`` (n: numbers, at: place of the month word from 1 or 0, month) and the time's fields."""
    a, b, c = (f"try_cast(get({d}.n, {i}) AS INT)" for i in range(3))
    wide = [f"length(get({d}.n, {i})) > 2" for i in range(3)]     # such a number can only be a year
    first, second, third = (f"get({d}.n, {i})" for i in range(3))

    def ymd(y: str, m: str, day: str) -> str:
        return f"array({y}, CAST({m} AS STRING), CAST({day} AS STRING))"

    # of two numbers beside a month word, the year is the wide one, else one that no day can be, else the last;
    # before a month word it is the first
    year_first = (f"CASE WHEN {wide[0]} THEN true WHEN {wide[1]} THEN false WHEN {d}.at = 3 THEN NOT {b} > 31 ELSE {a} > 31 END")
    by_word = (f"CASE size({d}.n) WHEN 1 THEN CASE WHEN {wide[0]} OR {a} > 31 THEN {ymd(first, f'{d}.month', '1')} END "
               f"WHEN 2 THEN CASE WHEN {wide[0]} AND {wide[1]} THEN NULL WHEN {year_first} THEN {ymd(first, f'{d}.month', second)} "
               f"ELSE {ymd(second, f'{d}.month', first)} END END")
    by_number = (
        f"CASE size({d}.n) "
        f"WHEN 1 THEN CASE length({first}) WHEN 4 THEN {ymd(first, '1', '1')} "
        f"WHEN 6 THEN {ymd(f'substr({first}, 1, 2)', f'substr({first}, 3, 2)', f'substr({first}, 5, 2)')} "
        f"WHEN 8 THEN {ymd(f'substr({first}, 1, 4)', f'substr({first}, 5, 2)', f'substr({first}, 7, 2)')} END "
        f"WHEN 2 THEN CASE WHEN {wide[0]} OR {a} > 31 THEN {ymd(first, second, '1')} "
        f"WHEN {wide[1]} OR {b} > 31 THEN {ymd(second, first, '1')} END "
        f"WHEN 3 THEN CASE WHEN {wide[0]} OR {a} > 31 THEN {ymd(first, second, third)} "
        f"WHEN {a} > 12 THEN {ymd(third, second, first)} ELSE {ymd(third, first, second)} END END")
    # two digits: the 100 years that end 49 years from now
    this = "year(current_date())"
    near = f"(({this} div 100) * 100 + try_cast(get(p, 0) AS INT))"
    year = (f"CASE WHEN length(get(p, 0)) > 2 THEN get(p, 0) WHEN {near} >= {this} + 50 THEN CAST({near} - 100 AS STRING) "
            f"WHEN {near} < {this} - 50 THEN CAST({near} + 100 AS STRING) ELSE CAST({near} AS STRING) END")
    hour = f"try_cast(get({time}, 0) AS INT)"
    half = f"get({time}, 4)"
    hour = (f"CASE WHEN {half} = '' THEN get({time}, 0) WHEN {hour} BETWEEN 0 AND 12 "
            f"THEN CAST({hour} % 12 + CASE {half} WHEN 'p' THEN 12 ELSE 0 END AS STRING) END")

    def field(i: int) -> str:
        return f"CASE WHEN get({time}, {i}) = '' THEN '0' ELSE get({time}, {i}) END"

    clock = (f"CASE WHEN {time} IS NULL THEN '' ELSE concat(' ', {hour}, ':', {field(1)}, ':', {field(2)}, "
             f"CASE WHEN get({time}, 3) = '' THEN '' ELSE concat('.', get({time}, 3)) END) END")
    joined = f"concat({year}, '-', get(p, 1), '-', get(p, 2), {clock})"
    parts = f"CASE WHEN {d}.at > 0 THEN {by_word} ELSE {by_number} END"
    return _let("p", parts, f"try_cast({joined} AS TIMESTAMP_NTZ)")


def _by_grammar(t: str) -> str:
    marked = f"split(regexp_replace(lower({t}), {text(_TIME)}, {text(_MARKED)}), '@')"
    # at most one time; what stands around it is the date
    date = f"CASE WHEN size(s) IN (1, 3) THEN regexp_replace(concat_ws(' ', get(s, 0), get(s, 2)), {text(_NOISE)}, ' ') END"
    tokens = f"CASE WHEN r RLIKE {text(_TOKENS)} AND NOT r RLIKE '^[0-9]{{1,2}}[.][0-9]+$' THEN regexp_extract_all(r, '[0-9]+|[a-z]+', 0) END"
    months = "map(" + ", ".join(f"{text(m)}, {i}" for m, i in _MONTH_NUMBERS.items()) + ")"
    word = "filter(w, x -> x RLIKE '^[a-z]')"
    split = _struct(n="filter(w, x -> x RLIKE '^[0-9]')", word=f"get({word}, 0)", words=f"size({word})",
                    at=f"coalesce(array_position(w, get({word}, 0)), 0)")
    # a quarter is the month that it begins with
    quarter = "size(w) = 3 AND get(w, 1) = 'q' AND length(get(w, 0)) = 4 AND get(w, 2) RLIKE '^[1-4]$'"
    of_quarter = _struct(n="array(get(w, 0))", at="CAST(2 AS BIGINT)", month="CAST(get(w, 2) AS INT) * 3 - 2")
    of_tokens = _let("k", split, "CASE WHEN size(w) <= 3 AND k.words <= 1 AND (k.words = 0 OR "
                     f"try_element_at({months}, k.word) IS NOT NULL) THEN "
                     + _struct(n="k.n", at="k.at", month=f"try_element_at({months}, k.word)") + " END")
    known = f"CASE WHEN {quarter} THEN {of_quarter} ELSE {of_tokens} END"
    time = "CASE WHEN size(s) = 3 THEN split(get(s, 1), ':') END"
    return _let("s", marked, _let("c", time, _let("r", date, _let("w", tokens, _let("d", known, _assembled("d", "c"))))))


def mixed_timestamp_sql(name: str) -> str:
    """X-16 as SQL: mixed text -> TIMESTAMP_NTZ, NULL when it is no date or out of range."""
    t = f"trim(CAST({ident(name)} AS STRING))"
    parsed = f"CASE WHEN {t} RLIKE {text(_ISO)} THEN try_cast({t} AS TIMESTAMP_NTZ) ELSE {_by_grammar(t)} END"
    return f"get(filter(array({parsed}), _p -> year(_p) BETWEEN {MIN_YEAR} AND {MAX_YEAR}), 0)"


def mixed_date_sql(name: str) -> str:
    """X-16 then truncation to DATE (the conformed type of every ``*date*`` column)."""
    return f"CAST({mixed_timestamp_sql(name)} AS DATE)"


def parse_mixed_timestamp(name: str) -> Column:
    return F.expr(mixed_timestamp_sql(name))


def parse_mixed_date(name: str) -> Column:
    return F.expr(mixed_date_sql(name))


# Fixed value: layout of the date-dimension parts joined as text.
DATETIME_PARTS_FORMAT = "yyyy-M-d H:m:s"


def datetime_from_parts_sql(year: str, month: str, day: str, time_of_day: str,
                            strict: bool = True) -> str:
    """X-17 / X-18: ``"{year}-{month}-{day} {time}"`` parsed as TIMESTAMP_NTZ.

    ``strict=True`` fails the job on the first unparsable row (ANSI parse);
    ``strict=False`` yields NULL for it instead.
    """
    parts = [f"CAST({ident(c)} AS STRING)" for c in (year, month, day, time_of_day)]
    joined = f"concat({parts[0]}, '-', {parts[1]}, '-', {parts[2]}, ' ', {parts[3]})"
    if strict:
        return f"to_timestamp_ntz({joined}, {text(DATETIME_PARTS_FORMAT)})"
    return f"CAST(try_to_timestamp({joined}, {text(DATETIME_PARTS_FORMAT)}) AS TIMESTAMP_NTZ)"


def datetime_from_parts(year: str, month: str, day: str, time_of_day: str,
                        strict: bool = True) -> Column:
    return F.expr(datetime_from_parts_sql(year, month, day, time_of_day, strict))
