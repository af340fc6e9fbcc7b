"""Type-2 history: versions of an entity and joins to them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.functions import sk_version
from tristrata.operators.conform import run_stamp

VALID_FROM = "valid_from"
VALID_TO = "valid_to"
IS_CURRENT = "is_current"


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _merge(
    open_rows: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    carried: Sequence[str],
    now: Column,
    same_key: Callable[[Column, Column], Column],
) -> DataFrame:
    values = [*check_cols, *carried]
    old = open_rows.select(
        *[F.col(k).alias(f"old_{k}") for k in keys],
        F.struct(*values, VALID_FROM).alias("old"),
    )
    new = source.select(*[F.col(k).alias(f"new_{k}") for k in keys], F.struct(*values).alias("new"))
    joined = old.join(
        new, _all([same_key(F.col(f"old_{k}"), F.col(f"new_{k}")) for k in keys]), "full_outer"
    )

    def version(side: str, valid_from: Column, valid_to: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}_{k}").alias(k) for k in keys],
            *[F.col(f"{side}.{c}").alias(c) for c in values],
            valid_from.alias(VALID_FROM),
            valid_to.alias(VALID_TO),
        )

    never = F.lit(None).cast("timestamp")
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    unchanged = _all([F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_cols])
    changed = has_old & has_new & ~unchanged
    kept_or_closed = F.when(
        has_old, version("old", F.col(f"old.{VALID_FROM}"), F.when(changed, now).otherwise(never))
    )
    opened = F.when(has_new & (~has_old | changed), version("new", now, never))
    return joined.select(F.inline(F.array_compact(F.array(kept_or_closed, opened))))


def merge_open_versions(
    open_rows: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    run_ts: datetime | Column,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Versions that are open before or after one run.

    Both inputs hold at most one row per key, so the join cannot be skewed and
    yields each key once. It is one full outer join; every joined row then
    unfolds into the version it keeps or closes and the version it opens, so
    the join is not computed twice. A source that comes from ``latest_per_key``
    is already partitioned by key and is not shuffled again.

    A NULL key is an entity like any other. It is merged apart, since a
    null-safe comparison would cost the join that partitioning; the filters on
    the key reach the files of both inputs.
    """
    now = run_stamp(run_ts).cast("timestamp")
    keyed = _all([F.col(k).isNotNull() for k in keys])
    parts = [
        _merge(open_rows.where(c), source.where(c), keys, check_cols, carried, now, same)
        for c, same in ((keyed, Column.__eq__), (~keyed, Column.eqNullSafe))
    ]
    return parts[0].unionByName(parts[1])


def empty_history(
    source: DataFrame, keys: Sequence[str], check_cols: Sequence[str], carried: Sequence[str] = ()
) -> DataFrame:
    """A history without versions, shaped for ``source``."""
    never = F.lit(None).cast("timestamp")
    columns = [*keys, *check_cols, *carried]
    return source.where(F.lit(False)).select(
        *columns, never.alias(VALID_FROM), never.alias(VALID_TO)
    )


def apply_snapshot(
    state: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    run_ts: datetime | Column,
    carried: Sequence[str] = (),
) -> DataFrame:
    """History after comparing the open versions with the latest source rows.

    ``source`` has one row per key (see ``latest_per_key``). A key whose
    ``check_cols`` differ, NULLs compared as values, has its open version closed
    and a new one opened at ``run_ts``; a new key is opened; a key missing from
    the source stays open. ``carried`` columns are stored but not compared, so
    applying the same source again changes nothing.

    Closed versions are passed through without a shuffle. The state is read
    twice (open and closed rows); keep it in files partitioned by
    ``is_current`` and each read touches its own partitions only.
    """
    if state is None:
        state = empty_history(source, keys, check_cols, carried)
    business = [*keys, *check_cols, *carried]
    closed = state.where(F.col(VALID_TO).isNotNull()).select(*business, VALID_FROM, VALID_TO)
    open_rows = state.where(F.col(VALID_TO).isNull())
    merged = merge_open_versions(open_rows, source, keys, check_cols, run_ts, carried)
    return closed.unionByName(merged)


def version_dimension(
    history: DataFrame,
    key: str,
    sk_name: str,
    nk_name: str,
    attributes: Sequence[Column | str],
) -> DataFrame:
    """Dimension with one row per version, keyed by id and start of validity."""
    return history.select(
        sk_version(key, VALID_FROM).alias(sk_name),
        F.col(key).alias(nk_name),
        *[F.col(a) if isinstance(a, str) else a for a in attributes],
        F.col(VALID_FROM).cast("timestamp").alias(VALID_FROM),
        F.col(VALID_TO).cast("timestamp").alias(VALID_TO),
        F.col(VALID_TO).isNull().alias(IS_CURRENT),
    )


def as_of_join(
    fact: DataFrame,
    versions: DataFrame,
    fact_key: str,
    version_key: str,
    fact_time: Column,
    attributes: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Attach to each fact row the version that was valid at its time.

    Versions of a key do not overlap, so a row matches at most one of them and
    the result has one row per fact row. The equality part is the shuffle key;
    the time range is checked inside the join. A key gains at most one version
    per snapshot run, which bounds the rows a fact row is compared with; a key
    with very many fact rows is split by adaptive skew handling, as the fact is
    the streamed side.
    """
    t = F.col("__fact_time")
    right = versions.select(
        F.col(version_key).alias("__version_key"),
        F.col(VALID_FROM).alias("__from"),
        F.col(VALID_TO).alias("__to"),
        *attributes,
    )
    same_key = F.col(fact_key) == F.col("__version_key")
    in_force = (F.col("__from") <= t) & (F.col("__to").isNull() | (t < F.col("__to")))
    joined = fact.withColumn("__fact_time", fact_time).join(right, same_key & in_force, how)
    return joined.drop("__fact_time", "__version_key", "__from", "__to")
