"""Facts kept up to date load by load.

For every fact two tables are stored, both split by the period of its date (a month by default):
``current`` holds the newest silver row per key, ``fact`` what is made of it.
A run reads the load days after the mark of the run before, looks up in which
periods their keys stand (one column is read for that), and rewrites these periods
and those the new rows belong to. Other periods are neither read nor written.

A period is replaced by dynamic partition overwrite, and the run counts once its
mark is written, last. A run that was stopped can be repeated: its rows are
found again and merged again. Until it is, a reader may see a period from before
and another from after it; ``Builds`` shows whole builds instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.functions import try_date
from tristrata.operators.conform import LOADED_AT
from tristrata.plans import facts
from tristrata.plans.dims import latest_rows
from tristrata.sources.bronze import INGEST_DT
from tristrata.sources.history_store import mark_before, record_snapshot, run_id
from tristrata.sources.sinks import INGEST_DAY, OVERWRITE_MODE
from tristrata.sources.workspace import fresh_folder

PERIOD = "period"
#: Period of rows whose date is missing or can't be read.
NO_PERIOD = "none"
#: The state is written twice a run and read once: smaller files are worth their time.
COMPRESSION = "zstd"
#: Keys of so many new rows are few megabytes, which Spark sends round.
FEW_ROWS = 200_000
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
MARKS = "mark timestamp, periods long, rows_read long, noted_at timestamp"


def period_of(day: Column, pattern: str) -> Column:
    return F.coalesce(F.date_format(day, pattern), F.lit(NO_PERIOD))


@dataclass(frozen=True)
class Upkeep:
    """How a fact is made from its silver log, and what tells its rows apart."""

    log: str
    key: str
    day: str
    columns: tuple[str, ...]
    build: Callable[..., DataFrame]
    period: str = "yyyy-MM"

    def period_of_row(self) -> Column:
        return period_of(try_date(self.day), self.period)

    def period_of_fact(self) -> Column:
        return period_of(F.col(self.day), self.period)


# Columns of the silver logs that the facts use.
FACTS = {
    "fact_appointments": Upkeep(
        "appointment", "appointment_id", "appointment_date",
        ("patient_id", "doctor_id", "appointment_date", "start_time", "end_time", "status", "appointment_type", "reason", "location", "phone"),
        facts.fact_appointments,
    ),
    "fact_billing": Upkeep(
        "hospital_fee", "fee_id", "fee_date",
        ("appointment_id", "patient_id", "fee_date", "amount", "service_type", "description"),
        facts.fact_billing,
    ),
    "fact_lab_results": Upkeep(
        "lab_results", "lab_result_id", "test_date",
        ("appointment_id", "patient_id", "test_date", "test_type", "parameter", "unit", "value", "interpretation"),
        facts.fact_lab_results,
    ),
    "fact_treatments": Upkeep(
        "treatments", "treatment_id", "treatment_date", ("patient_id", "doctor_id", "disease_id", "treatment_date"), facts.fact_treatments
    ),
    "fact_vitals": Upkeep(
        "vital_signs", "vital_id", "measurement_date",
        ("patient_id", "measurement_date", "blood_pressure", "heart_rate", "respiratory_rate", "temperature", "oxygen_saturation", "blood_sugar"),
        facts.fact_vitals,
    ),
}


def rows_after(log: DataFrame, low: datetime | None, high: datetime | None = None) -> DataFrame:
    """Rows loaded after ``low`` and up to ``high``; whole load days are left out by their folder."""
    loaded = F.col(LOADED_AT).cast("timestamp")
    by_day = INGEST_DAY in log.columns
    if low is not None:
        log = log.where(loaded > F.lit(low))
        log = log.where(F.col(INGEST_DAY) >= F.to_date(F.lit(low))) if by_day else log
    if high is not None:
        log = log.where(loaded <= F.lit(high))
        log = log.where(F.col(INGEST_DAY) <= F.to_date(F.lit(high))) if by_day else log
    return log


@dataclass(frozen=True)
class FactStore:
    """One fact under ``base``: ``current``, ``fact`` and ``marks``."""

    spark: SparkSession
    base: str
    upkeep: Upkeep

    def _path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def marks(self) -> DataFrame:
        """One row per finished run."""
        self.spark.createDataFrame([], MARKS).write.mode("ignore").json(self._path("marks"))
        return self.spark.read.schema(MARKS).json(self._path("marks"))

    def mark(self) -> datetime | None:
        """Load time up to which the fact is complete."""
        # As a number, so that the session's zone plays no part on the way.
        found = self.marks().agg(F.max(F.unix_micros("mark"))).first()[0]
        return None if found is None else _EPOCH + timedelta(microseconds=found)

    def read(self) -> DataFrame:
        """The fact as it stands."""
        return self.spark.read.parquet(self._path("fact")).drop(PERIOD)

    def _current(self) -> DataFrame:
        # Periods are text even where all of them look like numbers or dates.
        return self.spark.read.parquet(self._path("current")).withColumn(PERIOD, F.col(PERIOD).cast("string"))

    def _new_rows(self, log: DataFrame, low: datetime | None, high: datetime | None) -> DataFrame:
        order = [LOADED_AT, *([INGEST_DT] if INGEST_DT in log.columns else [])]
        rows = rows_after(log, low, high)
        return rows.select(self.upkeep.key, *self.upkeep.columns, *order).withColumn(PERIOD, self.upkeep.period_of_row())

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_rows(rows, [self.upkeep.key], self.upkeep.columns, keep_unkeyed=True).withColumn(PERIOD, self.upkeep.period_of_row())

    def touched_periods(self, new: DataFrame, low: datetime | None) -> list[str]:
        """Periods that hold a key of ``new`` or belong to one of its rows: a list as long as the calendar, not the data."""
        periods = new.select(PERIOD)
        if low is not None:
            keys = new.select(self.upkeep.key).distinct()
            periods = periods.unionAll(self._current().select(self.upkeep.key, PERIOD).join(keys, self.upkeep.key, "left_semi").select(PERIOD))
        return sorted(r[0] for r in periods.distinct().collect())

    def merged(self, new: DataFrame, periods: Sequence[str], low: datetime | None, new_rows: int = 0) -> DataFrame:
        """Rows of the touched periods after the new ones came in.

        Rows of other keys pass by without a shuffle where the new keys are few
        enough for Spark to send them round; only rows whose key came again are
        ranked. With more than ``FEW_ROWS`` new rows all are ranked, in one
        shuffle, as the joins would shuffle them too. Rows without a key are never merged: those that an earlier,
        stopped run already brought in make way for the ones read now.
        """
        if low is None:
            return self._newest(new)
        key = self.upkeep.key
        read_anew = F.col(key).isNull() & (F.col(LOADED_AT).cast("timestamp") > F.lit(low))
        held = self._current().where(F.col(PERIOD).isin(list(periods)) & ~F.coalesce(read_anew, F.lit(False)))
        if new_rows > FEW_ROWS:
            return self._newest(new.unionByName(held.select(new.columns))).select(new.columns)
        keys = new.where(F.col(key).isNotNull()).select(key).distinct()
        again = held.join(keys, key, "left_semi").select(new.columns)
        return held.join(keys, key, "left_anti").select(new.columns).unionByName(self._newest(new.unionByName(again)).select(new.columns))

    def update(self, log: DataFrame, up_to: datetime | None = None, overlap: timedelta = timedelta(0)) -> dict[str, object]:
        """Bring in the loads after the mark; returns (mark, periods, rows_read).

        ``up_to`` leaves later loads for another run. Loads that were still
        being written when the mark was taken are found if they are stamped less
        than ``overlap`` before it. Rows without a load time come in with the
        first run only, as nothing tells when they arrived.
        """
        mark = self.mark()
        low = None if mark is None else mark - overlap
        new = self._new_rows(log, low, up_to)
        facts = new.agg(F.count(F.lit(1)), F.max(F.unix_micros(F.col(LOADED_AT).cast("timestamp")))).first()
        if not facts[0]:
            return {"mark": mark, "periods": [], "rows_read": 0}
        periods = self.touched_periods(new, low)
        # Read and replaced at once would empty the table: the new state is stored apart first.
        # Files are sized by period; adaptive execution splits a period that holds many of the rows.
        # A first run reads nothing of it and stores it in place; it starts anew if it was stopped.
        if mark is None:
            self._delete(self._path("current"))
            scratch = self._path("current")
        else:
            scratch = fresh_folder(self.spark, "periods")
        self.merged(new, periods, low, facts[0]).hint("rebalance", PERIOD).write.option("compression", COMPRESSION).partitionBy(PERIOD).parquet(scratch)
        state = self.spark.read.parquet(scratch).withColumn(PERIOD, F.col(PERIOD).cast("string"))
        filled = {r[0] for r in state.select(PERIOD).distinct().collect()}
        made = self.upkeep.build(state, dedupe=False)
        made = made.withColumn(PERIOD, self.upkeep.period_of_fact())
        for df, name in ((made, "fact"), (state, "current")):
            if mark is None and name == "fact":
                self._delete(self._path(name))  # of a first run that was stopped
            if scratch != self._path(name):
                writer = df.write.mode("overwrite").option(OVERWRITE_MODE, "dynamic").option("compression", COMPRESSION)
                writer.partitionBy(PERIOD).parquet(self._path(name))
            self._drop_periods(name, [m for m in periods if m not in filled])
        reached = facts[1] if mark is None else max(facts[1] or 0, (mark - _EPOCH) // timedelta(microseconds=1))
        line = self.spark.range(1).select(
            F.timestamp_micros(F.lit(reached).cast("bigint")).alias("mark"), F.lit(len(periods)).cast("bigint").alias("periods"),
            F.lit(facts[0]).cast("bigint").alias("rows_read"), F.current_timestamp().alias("noted_at"),
        )
        line.write.mode("append").json(self._path("marks"))
        return {"mark": self.mark(), "periods": periods, "rows_read": facts[0]}

    def _drop_periods(self, name: str, periods: Sequence[str]) -> None:
        """An overwrite leaves alone what gets no row: periods that have become empty are taken away."""
        for period in periods:
            self._delete(f"{self._path(name)}/{PERIOD}={period}")

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def update_facts(
    spark: SparkSession, base: str, logs: Callable[[str], DataFrame], names: Sequence[str] = tuple(FACTS), up_to: datetime | None = None, overlap: timedelta = timedelta(0)
) -> dict[str, dict[str, object]]:
    """Bring several facts up to date; ``logs`` gives a silver log by name."""
    return {name: FactStore(spark, f"{base.rstrip('/')}/{name}", FACTS[name]).update(logs(FACTS[name].log), up_to, overlap) for name in names}


def record_changes(
    log: DataFrame,
    base: str,
    source: Callable[[DataFrame, datetime], DataFrame],
    keys: Sequence[str],
    check_cols: Sequence[str],
    run_ts: datetime,
    carried: Sequence[str] = (),
    overlap: timedelta = timedelta(0),
    full: bool = False,
) -> dict[str, int]:
    """``record_snapshot`` that reads the loads since the run before instead of the whole log.

    A key that did not come again keeps its open version, so the newest rows of
    the new loads are all a run needs: the log may grow without the run reading
    more. The mark is the greatest load time read; it is kept in the ledger line
    of the run, so a repeated run starts from the mark of the one before. Loads
    stamped less than ``overlap`` before the mark are read again, which changes
    nothing but finds late writers. ``full`` reads all of the log, for one that
    was rewritten under old load times; so does a history without a mark.
    """
    spark = log.sparkSession
    low = None if full else mark_before(spark, base, run_id(run_ts))
    rows = rows_after(log, None if low is None else low - overlap)
    reached = rows.agg(F.max(F.unix_micros(F.col(LOADED_AT).cast("timestamp")))).first()[0]
    seen = [m for m in (low, None if reached is None else _EPOCH + timedelta(microseconds=reached)) if m is not None]
    return record_snapshot(source(rows, run_ts), base, keys, check_cols, run_ts, carried, mark=max(seen, default=None))
