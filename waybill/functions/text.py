"""String rules of the event model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes that decide what counts as blank.
_TRIMMED = r"^[\x00-\x20]+|[\x00-\x20]+$"
_WHITE_SPACE = r"^[\t-\r\x1C-\x20\u1680\u2000-\u2006\u2008-\u200A\u2028\u2029\u205F\u3000]*$"
_ID_SHAPE = r"\A[a-zA-Z0-9-]+\z"


def trimmed(text) -> Column:
    """Strip every character up to U+0020 at both ends (Spark's trim strips spaces only)."""
    return F.regexp_replace(text, _TRIMMED, "")


def is_empty(text) -> Column:
    """Null, or nothing left after ``trimmed``."""
    column = F.col(text) if isinstance(text, str) else text
    return column.isNull() | (trimmed(column) == "")


def is_blank(text) -> Column:
    """Null, or white space only in the Unicode sense; no-break spaces are not blank."""
    column = F.col(text) if isinstance(text, str) else text
    return column.isNull() | column.rlike(_WHITE_SPACE)


def folded(text) -> Column:
    """Case-insensitive form: upper, then lower, one character at a time as far as SQL allows."""
    return F.lower(F.upper(text))


def has_id_shape(text) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.rlike(_ID_SHAPE), F.lit(False))


def first_failure(*checks: tuple[Column, Column | str]) -> Column:
    """The message of the first check that is true, else null."""
    return F.coalesce(
        *[F.when(failed, message if isinstance(message, Column) else F.lit(message)) for failed, message in checks]
    )


def preview(text, length: int = 50) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.when(
        F.char_length(column) > length, F.concat(F.substring(column, 1, length), F.lit("..."))
    ).otherwise(column)


def one_of(text, allowed, default: str, ignore_case: bool = False) -> Column:
    """``text`` if it is one of ``allowed``, else ``default``."""
    column = F.col(text) if isinstance(text, str) else text
    value = F.upper(column) if ignore_case else column
    return F.when(value.isin(*allowed), value).otherwise(F.lit(default))
