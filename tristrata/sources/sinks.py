"""Writing silver and gold tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.operators.conform import LOADED_AT

INGEST_DAY = "ingest_day"
OVERWRITE_MODE = "partitionOverwriteMode"
# A file of about this size is written in seconds.
FILE_BYTES = 16 * 1024 * 1024
# What Spark estimates where nothing is known is near the largest BIGINT.
_UNKNOWN_BYTES = 2**62


@dataclass(frozen=True)
class WriteLayout:
    """How Parquet files are laid out. ``None`` keeps Spark's default.

    ``files`` limits the number of files of a small load without a shuffle; ``rebalance`` sizes
    files with a shuffle that adaptive execution splits and merges, by day when
    the rows of one write belong to many days.
    """

    compression: str = "snappy"
    row_group_bytes: int | None = None
    page_bytes: int | None = None
    dictionary: bool | None = None
    files: int | None = None
    rebalance: bool = False

    def arrange(self, df: DataFrame) -> DataFrame:
        if self.rebalance:
            by_day = [F.col(INGEST_DAY)] if INGEST_DAY in df.columns else []
            return df.hint("rebalance", *by_day)
        return coalesce_files(df, self.files) if self.files else df

    def apply(self, writer: DataFrameWriter) -> DataFrameWriter:
        options = {
            "compression": self.compression,
            "parquet.block.size": self.row_group_bytes,
            "parquet.page.size": self.page_bytes,
            "parquet.enable.dictionary": self.dictionary,
        }
        for name, value in options.items():
            if value is not None:
                writer = writer.option(name, value)
        return writer


def coalesce_files(df: DataFrame, n: int = 6) -> DataFrame:
    """At most ``n`` output files for a load that fits in them, without a shuffle.

    Fewer files are fewer tasks in the stage that feeds the write. A load that
    Spark estimates at more than ``n`` files of ``FILE_BYTES`` keeps its own
    tasks, so that no task grows with the load; one of unknown size is small.
    """
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.coalesce(n) if estimate <= n * FILE_BYTES or estimate >= _UNKNOWN_BYTES else df


def ensure_db(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create a namespace if it is absent."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def stored_schema(schema: T.StructType) -> T.StructType:
    """Schema of a silver table on disk: its day partition comes last."""
    if INGEST_DAY in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(INGEST_DAY, T.DateType())])


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str | None = None
) -> None:
    """Create a Parquet table with a fixed schema, partitioned by load day.

    An overwrite of the table replaces the load days it writes and no others.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored_schema(schema))
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"OPTIONS ('{OVERWRITE_MODE}' = 'dynamic') PARTITIONED BY ({INGEST_DAY}){where}"
    )


def with_load_day(df: DataFrame) -> DataFrame:
    return df.withColumn(INGEST_DAY, F.to_date(LOADED_AT))


def _is_path(target: str) -> bool:
    return "/" in target


def _require_dynamic(spark: SparkSession, table: str) -> None:
    # An insert takes the mode from the table or the session, not from the
    # writer; in static mode it would empty the whole table.
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    stored = described.where(F.col("data_type").contains(f"{OVERWRITE_MODE}=dynamic"))
    mode = spark.conf.get(f"spark.sql.sources.{OVERWRITE_MODE}")
    if mode.lower() != "dynamic" and stored.isEmpty():
        raise ValueError(f"{table} was not made by ensure_table: a reload would empty it")


def _write_days(df: DataFrame, target: str, layout: WriteLayout | None, replace: bool) -> None:
    layout = layout or WriteLayout()
    df = layout.arrange(with_load_day(df))
    if _is_path(target):
        writer = df.write.mode("overwrite" if replace else "append").partitionBy(INGEST_DAY)
    else:
        df = df.select(*df.sparkSession.table(target).columns)
        writer = df.write
    writer = layout.apply(writer)
    if _is_path(target):
        writer.option(OVERWRITE_MODE, "dynamic").parquet(target)
    else:
        if replace:
            _require_dynamic(df.sparkSession, target)
        writer.insertInto(target, overwrite=replace)


def append_silver(df: DataFrame, target: str, layout: WriteLayout | None = None) -> None:
    """Append a load to a silver table (a path, or a table made beforehand).

    The rows of one run share their load day, so every task writes to a single
    partition and no shuffle is needed before the write.
    """
    _write_days(df, target, layout, replace=False)


def reload_silver(df: DataFrame, target: str, layout: WriteLayout | None = None) -> None:
    """Write a load so that running it again replaces it.

    The load days present in ``df`` are replaced, all others stay.
    """
    _write_days(df, target, layout, replace=True)


def publish(df: DataFrame, target: str, layout: WriteLayout | None = None) -> None:
    """Full refresh of a table (a path or a catalog name)."""
    layout = layout or WriteLayout()
    writer = layout.apply(layout.arrange(df).write.mode("overwrite"))
    if _is_path(target):
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)
