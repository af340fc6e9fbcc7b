"""Surrogate and natural keys.

A key depends on its own row only, so a fact gets its foreign keys without a
lookup join and dimension and fact can be built independently.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator between the parts of a composite key. It is not
# escaped, so ("a|b", "c") and ("a", "b|c") share a key.
SEPARATOR = "|"

_SMALLEST_NEGATABLE = -(2**63) + 1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _positive_hash(text: Column) -> Column:
    # abs() of the smallest BIGINT overflows (and raises under ANSI), so that
    # one hash value moves up by one first.
    return F.abs(F.greatest(F.xxhash64(text), F.lit(_SMALLEST_NEGATABLE)))


def sk(c: Column | str, null_key: bool = True) -> Column:
    """Surrogate key of a single id.

    The id is hashed as text so that the integer 42 and the text '42' share a
    key. A NULL id has a fixed key (the hash seed); ``null_key=False`` makes it
    NULL instead, which keeps rows without an id out of joins.
    """
    c = _col(c)
    key = _positive_hash(c.cast("string"))
    return key if null_key else F.when(c.isNotNull(), key)


def nk_concat(*parts: Column | str) -> Column:
    """Readable composite key; a missing part is written as empty."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(_col(p), F.lit("")) for p in parts])


def sk_concat(*parts: Column | str) -> Column:
    """Surrogate key of several text columns."""
    return _positive_hash(nk_concat(*parts))


def sk_version(key: Column | str, valid_from: Column | str) -> Column:
    """Surrogate key of one version of an entity.

    The time enters the hash as UTC text, so the key does not change with the
    time zone of the session that computes it.
    """
    seconds = F.unix_micros(_col(valid_from)).cast("decimal(18,0)") * F.lit(Decimal("0.000001"))
    since_epoch = F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    utc = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + since_epoch
    text = F.concat(_col(key).cast("string"), F.lit(SEPARATOR), utc.cast("string"))
    return _positive_hash(text)


def date_key(c: Column | str) -> Column:
    """Integer yyyymmdd of a date."""
    c = _col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.day(c)
