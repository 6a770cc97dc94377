"""Regex and null helpers shared by every text function.

Patterns are always literals, so the JVM compiles each one once per task.
A failed match is NULL here, never the empty string Spark returns.
"""

from pyspark.sql import Column, functions as F

#: Spellings of "missing" met in landed text; compared after trim and lower.
MISSING = ("", "nan", "none", "null")


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(value: str) -> Column:
    return F.lit(value)


def null_str() -> Column:
    return F.lit(None).cast("string")


def let(value, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body reads it."""
    return F.get(F.transform(F.array(as_col(value)), lambda v: body(v)), F.lit(0))


def like(pattern: str):
    """Predicate for ``F.filter``. (A lambda with a default argument would get the index.)"""
    return lambda x: x.rlike(pattern)


def strip(c) -> Column:
    """Trim any Unicode blank at both ends (``trim`` only knows the space)."""
    return F.regexp_replace(as_col(c), r"(?U)^\s+|\s+$", "")


def blank_to_null(c) -> Column:
    c = as_col(c)
    return F.nullif(c, F.lit(""))


def present(c) -> Column:
    """The stripped value, or NULL when it is one of the missing spellings."""
    s = strip(as_col(c).cast("string"))
    return F.when(~F.lower(s).isin(*MISSING), s)


def is_blank(c) -> Column:
    return present(c).isNull()


def first_present(*cols) -> Column:
    return F.coalesce(*[present(c) for c in cols])


def grab(c, pattern: str, group: int = 1) -> Column:
    """Text of ``group`` in the first match, NULL when nothing matched."""
    return blank_to_null(F.regexp_extract(as_col(c), pattern, group))


def grab_all(c, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(as_col(c), F.lit(pattern), F.lit(group))


def grab_last(c, pattern: str, group: int = 1) -> Column:
    return blank_to_null(F.try_element_at(grab_all(c, pattern, group), F.lit(-1)))


def has(c, pattern: str) -> Column:
    return as_col(c).rlike(pattern)


def sub(c, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(as_col(c), pattern, replacement)


def sub_first(c, pattern: str, replacement: str = " ") -> Column:
    """Replace the leftmost match only (``pattern`` without inline flags but (?i))."""
    flags, body = ("(?is)", pattern[4:]) if pattern.startswith("(?i)") else ("(?s)", pattern)
    return F.regexp_replace(as_col(c), rf"{flags}\A(.*?)(?:{body})", "$1" + replacement)


def cut_before(c, separator: str) -> Column:
    """Everything before the first ``separator`` (a literal), else the whole value."""
    return F.substring_index(as_col(c), separator, 1)


def first_of(*cols) -> Column:
    return F.coalesce(*cols)


def lines_of(c, pattern: str = r"\r\n|\r|\n") -> Column:
    """Stripped non-empty lines, in order."""
    parts = F.transform(F.split(as_col(c), pattern), strip)
    return F.filter(parts, lambda x: x != "")
