"""State of data-quality checks by load day, merged instead of rescanned.

Beside a table partitioned by load day lies one row per day (rows, NULLs by
column, newest load time, least and greatest key, rows of repeated keys) and
the keys of each day with their counts. A refresh reads the days that came or
grew since the last one; the answers for the whole table are sums and maxima
over days. Only a repeat across days needs keys: it can only lie in days whose
ranges of keys overlap, so just their keys are read, and none where every load
brings keys of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.operators.conform import LOADED_AT
from tristrata.sources.sinks import INGEST_DAY, OVERWRITE_MODE


@dataclass(frozen=True)
class CheckState:
    """The state under ``base`` for a table with one key column and some columns that must be filled."""

    spark: SparkSession
    base: str
    key: str
    key_type: str
    columns: tuple[str, ...]

    def _path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def _key_type(self) -> T.DataType:
        return T.StructType.fromDDL(f"key {self.key_type}")["key"].dataType

    def _days_schema(self) -> T.StructType:
        key_type = self._key_type()
        longs = [T.StructField(n, T.LongType()) for n in ("rows", "repeated", *(f"null_{c}" for c in self.columns))]
        ends = [T.StructField("low", key_type), T.StructField("high", key_type), T.StructField("newest", T.TimestampType())]
        return T.StructType([*longs, *ends, T.StructField(INGEST_DAY, T.DateType())])

    def refresh(self, table: DataFrame, since: date | None = None) -> list[date]:
        """Bring the state up to the table; returns the days that were read.

        Read are the newest day of the state, which may have grown, and all
        later ones; ``since`` names an earlier day, after a reload of old days.
        The keys of a day are written before its row, so a refresh that was
        stopped is repeated by the next one.
        """
        for name in ("days", "keys"):
            # Start an empty state on the first call; later this does nothing.
            self.spark.createDataFrame([], self._schema(name)).write.mode("ignore").partitionBy(INGEST_DAY).parquet(self._path(name))
        newest = self._read("days").agg(F.max(INGEST_DAY)).first()[0]
        start = min((d for d in (since, newest) if d is not None), default=None)
        rows = table if start is None else table.where(F.col(INGEST_DAY) >= F.lit(start))
        # One pass over the new days: NULLs ride along with the counts by key.
        nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in self.columns]
        per_key = rows.groupBy(INGEST_DAY, F.col(self.key).cast(self.key_type).alias("key")).agg(F.count(F.lit(1)).alias("n"), *nulls, F.max(F.col(LOADED_AT).cast("timestamp")).alias("newest"))
        self._write(per_key, "keys")
        # What was just written is narrow: one row per key and day.
        stored = self._read("keys")
        stored = stored if start is None else stored.where(F.col(INGEST_DAY) >= F.lit(start))
        days = stored.groupBy(INGEST_DAY).agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("key").isNotNull() & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("repeated"),
            *[F.sum(f"null_{c}").alias(f"null_{c}") for c in self.columns],
            F.min("key").alias("low"),
            F.max("key").alias("high"),
            F.max("newest").alias("newest"),
        )
        self._write(days.select(self._schema("days").names), "days")
        return [r[0] for r in self._read("days").where(F.lit(True) if start is None else F.col(INGEST_DAY) >= F.lit(start)).select(INGEST_DAY).orderBy(INGEST_DAY).collect()]

    def _write(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option(OVERWRITE_MODE, "dynamic").partitionBy(INGEST_DAY).parquet(self._path(name))

    def _schema(self, name: str) -> T.StructType:
        if name == "days":
            return self._days_schema()
        fields = [T.StructField("key", self._key_type()), T.StructField("n", T.LongType())]
        fields += [T.StructField(f"null_{c}", T.LongType()) for c in self.columns]
        return T.StructType([*fields, T.StructField("newest", T.TimestampType()), T.StructField(INGEST_DAY, T.DateType())])

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(self._schema(name)).parquet(self._path(name))

    def not_null(self) -> DataFrame:
        """NULLs per column over all days: (column, failures)."""
        days = self._read("days")
        totals = days.agg(*[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(c) for c in self.columns])
        return totals.unpivot([], list(self.columns), "column", "failures")

    def newest(self) -> DataFrame:
        """The newest load time over all days: (max_loaded_at)."""
        return self._read("days").agg(F.max("newest").alias("max_loaded_at"))

    def suspect_days(self) -> list[date]:
        """Days that may hold a repeated key: with repeats of their own, or a range of keys that overlaps another day's."""
        days = self._read("days")
        # One row per day, whatever the size of the table.
        ranges = sorted(((r.low, r.high, r[INGEST_DAY], r.repeated) for r in days.where("low IS NOT NULL").select("low", "high", INGEST_DAY, "repeated").collect()))
        suspects = {day for _, _, day, repeated in ranges if repeated}
        reach, owner = None, None
        for low, high, day, _ in ranges:
            if reach is not None and low <= reach:
                suspects |= {day, owner}
            if reach is None or high > reach:
                reach, owner = high, day
        return sorted(suspects)

    def unique(self) -> DataFrame:
        """Keys that occur more than once in the table: (key column, n_records). NULLs are ignored."""
        keys = self._read("keys")
        some = keys.where(F.col(INGEST_DAY).isin(self.suspect_days()) & F.col("key").isNotNull())
        totals = some.groupBy(F.col("key").alias(self.key)).agg(F.sum("n").alias("n_records"))
        return totals.where(F.col("n_records") > 1)


def check_states(spark: SparkSession, base: str, tables: dict[str, tuple[str, str, Sequence[str]]]) -> dict[str, CheckState]:
    """A state for each table: name -> (key, its type, columns that must be filled)."""
    return {name: CheckState(spark, f"{base.rstrip('/')}/{name}", key, kind, tuple(columns)) for name, (key, kind, columns) in tables.items()}
