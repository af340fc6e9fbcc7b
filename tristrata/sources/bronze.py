"""Reading dated raw data."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INGEST_DT = "ingest_dt"


def _iso(day: date | str) -> str:
    return day if isinstance(day, str) else day.isoformat()


def _dated(spark: SparkSession, root: str, day: date | str | None, name_glob: str | None) -> DataFrame:
    # Only the folder of the wanted day is listed; without basePath its date
    # would not become a column.
    # Days and files may differ in columns; a column that some lack is null there.
    reader = spark.read.option("basePath", root).option("mergeSchema", True)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    path = root if day is None else f"{root}/{INGEST_DT}={_iso(day)}"
    df = reader.parquet(path)
    return df.withColumn(INGEST_DT, F.col(INGEST_DT).cast("date"))


def read_bronze(
    spark: SparkSession, base: str, entity: str, ingest_dt: date | str | None = None
) -> DataFrame:
    """Raw rows of an entity, of one day or of all days, with ``ingest_dt``."""
    return _dated(spark, f"{base.rstrip('/')}/{entity}", ingest_dt, None)


def read_dated_files(
    spark: SparkSession, base: str, prefix: str, ingest_dt: date | str | None = None
) -> DataFrame:
    """Like ``read_bronze`` where one dated folder mixes the files of all
    entities and a file belongs to the entity its name starts with."""
    return _dated(spark, base.rstrip("/"), ingest_dt, f"{prefix}*.parquet")
