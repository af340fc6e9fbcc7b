"""Bronze to silver."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tristrata.operators.conform import LOADED_AT, conformed_columns, run_stamp
from tristrata.operators.quarantine import split_rows
from tristrata.plans.contracts import SILVER
from tristrata.sources.bronze import INGEST_DT, read_bronze
from tristrata.sources.landing import BAD_ROW, SOURCE_FILE
from tristrata.sources.sinks import WriteLayout, append_silver, ensure_db, ensure_table, reload_silver

REPORT = "table string, status string, rows long, error string, bad_rows long, misfits map<string, long>"


@dataclass(frozen=True)
class SilverConfig:
    """Where a silver run reads and writes.

    ``silver`` is a folder or a database. ``ingest_dt`` limits the run to the
    raw files of one day. ``replace`` makes the load idempotent: it replaces
    the load days it writes instead of appending to them.

    Rows that don't fit their header never enter silver; they go to
    ``quarantine/<table>`` (in a database ``quarantine_<table>``) with reason,
    source file and text. ``keyed`` does the same with rows whose key is empty
    or unreadable. A load with a larger share of bad rows than ``max_bad_share``
    fails before anything is stored in silver.
    """

    bronze: str
    silver: str
    ingest_dt: date | None = None
    tables: Sequence[str] = tuple(SILVER)
    replace: bool = False
    threads: int = 4
    layout: WriteLayout | None = None
    keyed: bool = False
    max_bad_share: float | None = None


@dataclass(frozen=True)
class Loaded:
    """What a load stored: rows, rows set apart, and by column the values that did not fit their type."""

    rows: int
    bad_rows: int
    misfits: dict[str, int]


class TooManyBadRows(Exception):
    """A load holds more bad rows than its configuration allows."""


def silver_target(silver: str, table: str) -> str:
    return f"{silver.rstrip('/')}/{table}" if "/" in silver else f"{silver}.{table}"


def quarantine_target(silver: str, table: str) -> str:
    return f"{silver.rstrip('/')}/quarantine/{table}" if "/" in silver else f"{silver}.quarantine_{table}"


def _set_apart(spark: SparkSession, cfg: SilverConfig, table: str, raw: DataFrame, bad: DataFrame) -> int:
    """Store the bad rows; returns their number, and raises if they are too many."""
    counts = Observation()
    if cfg.max_bad_share is not None:
        total = raw.count()
    target = quarantine_target(cfg.silver, table)
    if "/" not in cfg.silver:
        ensure_table(spark, target, bad.schema)
    bad = bad.observe(counts, F.count(F.lit(1)).alias("bad"))
    (reload_silver if cfg.replace else append_silver)(bad, target)
    found = counts.get["bad"]
    if cfg.max_bad_share is not None and found > cfg.max_bad_share * total:
        raise TooManyBadRows(f"{table}: {found} of {total} rows are bad")
    return found


def load_table(spark: SparkSession, cfg: SilverConfig, table: str, run_ts: datetime) -> Loaded:
    """Conform one raw entity and store it.

    The day of the raw file is kept beside the load time: several days that
    arrive in one run share the latter.
    """
    contract = SILVER[table]
    raw = read_bronze(spark, cfg.bronze, contract.raw, cfg.ingest_dt)
    good, bad_rows = raw, 0
    if BAD_ROW in raw.columns or cfg.keyed:
        good, bad = split_rows(raw, contract, BAD_ROW, SOURCE_FILE, run_ts, cfg.keyed)
        bad_rows = _set_apart(spark, cfg, table, raw, bad)
    counted, wrong = Observation(), contract.target_columns
    # Each value is cast once; rows are counted where they pass by on their way to the table.
    given = [F.col(f"`{source}`").isNotNull().alias(f"given_{i}") for i, source in enumerate(contract.raw_columns)]
    typed = good.select(*conformed_columns(contract, good.schema), *given, INGEST_DT)
    misfit = [F.count_if(F.col(f"given_{i}") & F.col(t).isNull()).alias(f"misfit_{t}") for i, t in enumerate(wrong)]
    typed = typed.observe(counted, F.count(F.lit(1)).alias("rows"), *misfit)
    rows = typed.select(*wrong, run_stamp(run_ts).cast("timestamp").alias(LOADED_AT), INGEST_DT)
    target = silver_target(cfg.silver, table)
    if "/" not in cfg.silver:
        ensure_table(spark, target, rows.schema)
    (reload_silver if cfg.replace else append_silver)(rows, target, cfg.layout)
    found = counted.get
    return Loaded(found["rows"], bad_rows, {t: found[f"misfit_{t}"] for t in wrong if found[f"misfit_{t}"]})


def run_silver(
    spark: SparkSession, cfg: SilverConfig, run_ts: datetime, raise_failed: bool = True
) -> DataFrame:
    """Load every silver table and report on each: (table, status, rows, error, bad_rows, misfits).

    The tables are independent, so a few are submitted at a time; one that
    fails does not stop the others, but once all were tried the run raises,
    unless ``raise_failed`` is off.
    """
    if "/" not in cfg.silver:
        ensure_db(spark, cfg.silver)

    def load(table: str) -> tuple:
        try:
            done = load_table(spark, cfg, table, run_ts)
            return (table, "ok", done.rows, None, done.bad_rows, done.misfits)
        except Exception as error:  # noqa: BLE001 - reported, the rest continue
            return (table, "failed", None, str(error).split("\n")[0], None, None)

    with ThreadPoolExecutor(cfg.threads) as pool:
        report = list(pool.map(load, cfg.tables))
    failed = [f"{row[0]}: {row[3]}" for row in report if row[1] == "failed"]
    if failed and raise_failed:
        raise RuntimeError(f"{len(failed)} of {len(report)} silver tables failed: {'; '.join(failed)}")
    return spark.createDataFrame(report, REPORT)
