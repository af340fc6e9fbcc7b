"""Text, number and time expressions.

None of them depends on ``spark.sql.ansi.enabled``: bad input gives NULL in
either mode, because every parse goes through a ``try_`` form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as part of a number inside free text, and the only
# clock format that is understood (HH:mm).
NOT_NUMERIC = r"[^0-9.\-]"
CLOCK = r"^([01][0-9]|2[0-3]):[0-5][0-9]\z"

# Shapes of text that a cast to a number accepts. A failed try_cast costs an
# exception per row, some ten times the cast itself, so the shape is tested
# first; try_cast remains for what the shape cannot tell, such as the range.
_DIGITS = r"([0-9]+\.?[0-9]*|\.[0-9]+)"
PLAIN_NUMBER = rf"^-?{_DIGITS}\z"
WHOLE_OR_DECIMAL = rf"^\s*[+-]?{_DIGITS}([eE][+-]?[0-9]+)?\s*\z"
_HEXADECIMAL = r"0x[0-9a-f.]+p[+-]?[0-9]+"
FLOATING = (
    rf"(?i)^\s*([+-]?({_DIGITS}(e[+-]?[0-9]+)?|{_HEXADECIMAL})[df]?|[+-]?inf(inity)?|nan)\s*\z"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize(c: Column | str) -> Column:
    """Lower case without surrounding spaces (other white space is kept)."""
    return F.trim(F.lower(_col(c)))


def blank_to_null(c: Column | str) -> Column:
    """Treat the empty string as missing, so both fall in one group."""
    return F.nullif(_col(c), F.lit(""))


def extract_number(c: Column | str) -> Column:
    """The number left after dropping every other character from a text.

    ``5.4 mmol/L`` gives 5.4 and ``1,200`` gives 1200; a text whose leftovers
    are no number (``3.5-5.0``, ``Negative``) gives NULL.
    """
    left = F.regexp_replace(_col(c), NOT_NUMERIC, "")
    return F.when(left.rlike(PLAIN_NUMBER), left.try_cast("double"))


def safe_int(c: Column | str) -> Column:
    """Integer from text, also from decimal text such as ``5.0``."""
    text = _col(c).cast("string")
    return F.when(text.rlike(WHOLE_OR_DECIMAL), text.try_cast("double").try_cast("int"))


def safe_cast(c: Column | str, data_type: str) -> Column:
    """Cast of text that yields NULL where the value does not fit."""
    if data_type in ("int", "integer"):
        return safe_int(c)
    if data_type in ("float", "double"):
        text = _col(c).cast("string")
        return F.when(text.rlike(FLOATING), text.try_cast(data_type))
    return _col(c).try_cast(data_type)


def try_date(c: Column | str) -> Column:
    """Leading ISO date of a text, NULL when there is none."""
    return _col(c).try_cast("date")


def clock_minutes(clock: Column | str) -> Column:
    """Minutes since midnight of an ``HH:mm`` text, NULL for any other text."""
    clock = _col(clock)
    minutes = F.substring(clock, 1, 2).try_cast("int") * 60 + F.substring(clock, 4, 2).try_cast("int")
    return F.when(clock.rlike(CLOCK), minutes)


def duration_minutes(day: Column | str, start: Column | str, end: Column | str) -> Column:
    """Whole minutes between two clock texts of one day.

    An end before the start gives a negative value; a text that is not
    ``HH:mm`` (``10:00:00``, ``9:30``) or a missing day gives NULL. Both clocks
    belong to the same day, so they are subtracted directly: a third of the
    cost of parsing two timestamps per row, and no time zone is involved.
    """
    return F.when(_col(day).isNotNull(), clock_minutes(end) - clock_minutes(start))
