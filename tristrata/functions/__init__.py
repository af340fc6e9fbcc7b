"""Column-to-column expressions; all of them stay inside the JVM."""

from tristrata.functions.keys import date_key, nk_concat, sk, sk_concat, sk_version
from tristrata.functions.scalars import (
    blank_to_null,
    clock_minutes,
    duration_minutes,
    extract_number,
    normalize,
    safe_cast,
    safe_int,
    try_date,
)

__all__ = [
    "blank_to_null",
    "clock_minutes",
    "date_key",
    "duration_minutes",
    "extract_number",
    "nk_concat",
    "normalize",
    "safe_cast",
    "safe_int",
    "sk",
    "sk_concat",
    "sk_version",
    "try_date",
]
