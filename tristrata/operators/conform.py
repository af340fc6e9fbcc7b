"""Typed projection of raw text onto a table contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.functions import safe_cast

LOADED_AT = "ingested_at"


@dataclass(frozen=True)
class Contract:
    """Target columns of a table and the raw columns they come from.

    ``columns`` lists ``raw->target:type`` (or ``name:type`` when both names
    agree) separated by commas; ``defaults`` replaces NULLs of a target column.
    """

    table: str
    raw: str
    columns: str
    keys: tuple[str, ...]
    defaults: Mapping[str, str] = field(default_factory=dict)

    def specs(self) -> list[tuple[str, str, str]]:
        out = []
        for item in self.columns.split(","):
            names, data_type = item.strip().split(":")
            source, _, target = names.partition("->")
            out.append((source, target or source, data_type))
        return out

    @property
    def raw_columns(self) -> list[str]:
        return [source for source, _, _ in self.specs()]

    @property
    def target_columns(self) -> list[str]:
        return [target for _, target, _ in self.specs()]

    def schema(self) -> T.StructType:
        """Stored schema, load time included."""
        ddl = ", ".join(f"{target} {data_type}" for _, target, data_type in self.specs())
        return T.StructType.fromDDL(f"{ddl}, {LOADED_AT} timestamp")


def run_stamp(run_ts: datetime | Column | None = None) -> Column:
    """The load time of a run: given, or the start of the query."""
    if run_ts is None:
        return F.current_timestamp()
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts)


def conformed_columns(contract: Contract, raw: T.StructType) -> list[Column]:
    """The contract's columns, as text is read or typed columns are narrowed."""
    text = {f.name.lower() for f in raw if isinstance(f.dataType, T.StringType)}
    out = []
    for source, target, data_type in contract.specs():
        value = F.col(f"`{source}`")
        if source.lower() in text:
            value = safe_cast(value, data_type)
        else:
            value = value.try_cast(data_type)
        if target in contract.defaults:
            value = F.coalesce(value, F.lit(contract.defaults[target]))
        out.append(value.alias(target))
    return out


def conform(
    raw: DataFrame,
    contract: Contract,
    run_ts: datetime | Column | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Cast, rename and stamp raw rows; a value that does not fit is NULL.

    One narrow projection: no shuffle, and only the raw columns named in the
    contract (plus ``carry``) are read from the files.
    """
    return raw.select(
        *conformed_columns(contract, raw.schema),
        run_stamp(run_ts).cast("timestamp").alias(LOADED_AT),
        *[F.col(c) for c in carry],
    )


def pack_and_expand(df: DataFrame, columns: Sequence[str], name: str = "record") -> DataFrame:
    """Pack columns in a struct and expand it again.

    Catalyst removes the round trip, so this equals a plain ``select``; it is
    here for callers that pass whole records between steps.
    """
    return df.select(F.struct(*columns).alias(name)).select(f"{name}.*")
