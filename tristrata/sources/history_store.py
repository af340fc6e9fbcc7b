"""Stored type-2 history.

Layout: ``<base>/versions/run=<id>/is_current=<true|false>/``. A run writes its
own folder only: the versions it closed and all versions open after it. The
history after a run is every closed version up to it plus the open versions of
that run. Nothing that was written is read and replaced at the same time, a
repeated run replaces its own folder, and closed versions are never rewritten.
A run counts once its line is in ``<base>/ledger``, written last.

The open versions of older runs serve only to go back to such a run;
``expire_runs`` drops them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.operators.history import (
    IS_CURRENT,
    VALID_FROM,
    VALID_TO,
    empty_history,
    merge_open_versions,
)

RUN = "run"
LEDGER = "run string, opened long, closed long, open_versions long, expired boolean, mark timestamp"


def run_id(run_ts: datetime) -> str:
    """Sortable name of a run."""
    if run_ts.tzinfo is not None:
        run_ts = run_ts.astimezone(timezone.utc)
    return run_ts.strftime("%Y%m%dT%H%M%S%f")


def _ledger(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(LEDGER).json(f"{base}/ledger")


def _ledger_line(spark: SparkSession, values: dict[str, object]) -> DataFrame:
    fields = T.StructType.fromDDL(LEDGER)
    columns = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in fields]
    return spark.range(1).select(*columns)


def latest_run(spark: SparkSession, base: str, before: str | None = None) -> str | None:
    """Id of the newest finished run, optionally of those before another."""
    runs = _runs(spark, base)
    return max((r for r in runs if before is None or r < before), default=None)


def mark_before(spark: SparkSession, base: str, run: str) -> datetime | None:
    """Load time up to which the newest run before ``run`` had read its log; None without such a run or mark."""
    _start_ledger(spark, base)
    before = latest_run(spark, base, before=run)
    line = _ledger(spark, base).where((F.col(RUN) == before) & F.col("mark").isNotNull())
    found = line.agg(F.max(F.unix_micros("mark"))).first()[0] if before else None
    return None if found is None else datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=found)


def _start_ledger(spark: SparkSession, base: str) -> None:
    # Start an empty ledger on the first run; later this does nothing.
    _ledger_line(spark, {}).limit(0).write.mode("ignore").json(f"{base}/ledger")


def _runs(spark: SparkSession, base: str) -> dict[str, bool]:
    # One line per run, whatever the size of the history: run -> expired.
    runs = _ledger(spark, base).groupBy(RUN).agg(F.coalesce(F.bool_or("expired"), F.lit(False)))
    return {r[0]: r[1] for r in runs.collect()}


def _versions(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        parts = [T.StructField(RUN, T.StringType()), T.StructField(IS_CURRENT, T.BooleanType())]
        reader = reader.schema(T.StructType([*schema.fields, *parts]))
    return reader.parquet(f"{base}/versions").withColumns(
        {RUN: F.col(RUN).cast("string"), IS_CURRENT: F.col(IS_CURRENT).cast("boolean")}
    )


def read_history(spark: SparkSession, base: str, run: str | None = None) -> DataFrame:
    """All versions known after a run (default: the newest finished one).

    The finished runs enter the filter as literals, so only their folders are
    listed as inputs; what an unfinished run left behind is never read.
    """
    runs = _runs(spark, base)
    run = run or max(runs, default=None)
    if run not in runs:
        raise ValueError(f"no finished run {run or ''} under {base}")
    if runs[run]:
        raise ValueError(f"run {run} has expired")
    finished = sorted(r for r in runs if r <= run)
    closed = F.col(RUN).isin(finished) & ~F.col(IS_CURRENT)
    after = closed | ((F.col(RUN) == run) & F.col(IS_CURRENT))
    return _versions(spark, base).where(after).drop(RUN, IS_CURRENT)


def record_snapshot(
    source: DataFrame,
    base: str,
    keys: Sequence[str],
    check_cols: Sequence[str],
    run_ts: datetime,
    carried: Sequence[str] = (),
    mark: datetime | None = None,
) -> dict[str, int]:
    """Run one snapshot against the stored history; returns its counts.

    ``source`` may hold the keys that changed alone; the others keep their open
    version. ``mark`` notes how far its log was read, for ``mark_before``.

    Runs come in order of time: only the newest may be repeated, and an older
    one raises, as does one whose previous run has expired.

    Reads the open versions of the previous run and the source, joins them once
    and writes once. Cost does not grow with the number of closed versions.
    """
    spark = source.sparkSession
    run = run_id(run_ts)
    _start_ledger(spark, base)
    runs = _runs(spark, base)
    newest = max(runs, default=run)
    if run < newest:
        raise ValueError(f"run {run} is older than {newest}: history would overlap")
    previous = max((r for r in runs if r < run), default=None)
    if previous is not None and runs[previous]:
        raise ValueError(f"the run before {run} has expired: its open versions are gone")
    blank = empty_history(source, keys, check_cols, carried)
    if previous is None:
        open_rows = blank
    else:
        stored = _versions(spark, base, blank.schema)
        open_rows = stored.where((F.col(RUN) == previous) & F.col(IS_CURRENT))
    merged = merge_open_versions(open_rows, source, keys, check_cols, run_ts, carried)

    counts = Observation()
    is_open, now = F.col(VALID_TO).isNull(), F.lit(run_ts).cast("timestamp")
    merged.withColumn(IS_CURRENT, is_open).observe(
        counts,
        F.count_if(is_open & (F.col(VALID_FROM) == now)).alias("opened"),
        F.count_if(~is_open).alias("closed"),
        F.count_if(is_open).alias("open_versions"),
    ).write.mode("overwrite").partitionBy(IS_CURRENT).parquet(f"{base}/versions/{RUN}={run}")

    _ledger_line(spark, {RUN: run, "mark": mark, **counts.get}).write.mode("append").json(f"{base}/ledger")
    return counts.get


def expire_runs(spark: SparkSession, base: str, keep: int = 7) -> list[str]:
    """Drop the open versions of all but the newest ``keep`` runs, two at least.

    The run before the newest stays in any case, as repeating the newest needs it.

    Closed versions stay, so the history itself loses nothing; only going back
    to the state after an expired run is no longer possible. The ledger is
    marked before any file goes, so an interrupted call can be repeated.
    """
    runs = _runs(spark, base)
    old = sorted(runs)[: -max(keep, 2)]
    fresh = [r for r in old if not runs[r]]
    for run in fresh:
        _ledger_line(spark, {RUN: run, "expired": True}).write.mode("append").json(f"{base}/ledger")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for run in old:
        path = jvm.org.apache.hadoop.fs.Path(f"{base}/versions/{RUN}={run}/{IS_CURRENT}=true")
        path.getFileSystem(conf).delete(path, True)
    return fresh
