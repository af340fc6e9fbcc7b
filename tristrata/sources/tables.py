"""Tables by name, from a catalog namespace, a folder or given DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tristrata.sources.sinks import WriteLayout, ensure_db, publish


class Tables:
    """Maps the names used by table builders to DataFrames.

    ``place`` is a folder (it contains a slash) with one Parquet dataset per
    table, or a database of the session catalog. ``given`` overrides single
    names with DataFrames.
    """

    def __init__(
        self,
        spark: SparkSession,
        place: str | None = None,
        given: Mapping[str, DataFrame] | None = None,
    ):
        self.spark = spark
        self.place = place.rstrip("/") if place else None
        self.given = dict(given or {})
        if self.place and not self.is_folder:
            ensure_db(spark, self.place)

    @property
    def is_folder(self) -> bool:
        return self.place is not None and "/" in self.place

    def target(self, name: str) -> str:
        """Where a table of this name is stored."""
        if self.place is None:
            raise ValueError(f"no place to store {name}")
        return f"{self.place}/{name}" if self.is_folder else f"{self.place}.{name}"

    def source(self, name: str) -> DataFrame:
        if name in self.given:
            return self.given[name]
        if self.is_folder:
            return self.spark.read.parquet(self.target(name))
        return self.spark.table(self.target(name))

    ref = source

    def publish(self, df: DataFrame, name: str, layout: WriteLayout | None = None) -> DataFrame:
        """Replace a table and return it as stored."""
        publish(df, self.target(name), layout)
        self.given.pop(name, None)
        return self.source(name)
