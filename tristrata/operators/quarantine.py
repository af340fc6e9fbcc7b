"""Rows that can't be trusted, kept apart with the reason."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.operators.conform import LOADED_AT, Contract, conformed_columns, run_stamp

REASON, RECORD, SOURCE = "reason", "record", "source_file"
MALFORMED = "does not fit the header"
NO_KEY = "key missing or unreadable"


def bad_reason(raw: DataFrame, bad_row: str, contract: Contract | None = None, keyed: bool = False) -> Column:
    """Why a raw row is bad, or NULL. ``keyed`` also refuses rows whose key is empty or does not fit its type."""
    reason = F.when(F.col(bad_row).isNotNull(), MALFORMED) if bad_row in raw.columns else F.lit(None).cast("string")
    if keyed and contract is not None:
        values = dict(zip(contract.target_columns, conformed_columns(contract, raw.schema), strict=True))
        for key in contract.keys:
            reason = F.coalesce(reason, F.when(values[key].isNull(), NO_KEY))
    return reason


def split_rows(
    raw: DataFrame, contract: Contract, bad_row: str, source_file: str, run_ts: datetime | Column | None = None, keyed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(good, bad): raw rows to conform, and the others with reason, source file and what was read of them.

    Both are filters over the same rows, so each side reads only what it needs:
    where no key is asked for, the bad rows of a column store come from two of
    its columns.
    """
    reason = bad_reason(raw, bad_row, contract, keyed)
    fields = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns if c not in (bad_row, source_file)]))
    text = fields
    if bad_row in raw.columns:
        text = F.coalesce(F.col(bad_row), fields) if keyed else F.col(bad_row)
    origin = F.col(source_file) if source_file in raw.columns else F.lit(None).cast("string")
    bad = raw.where(reason.isNotNull()).select(
        reason.alias(REASON), origin.alias(SOURCE), text.alias(RECORD), run_stamp(run_ts).cast("timestamp").alias(LOADED_AT)
    )
    return raw.where(reason.isNull()), bad
