"""Builds of a set of tables: written beside each other, shown by a switch.

In a database a build's tables are ``<name>__build_<run>`` and readers use the
view ``<name>``. In a folder a build is ``build=<run>``. Either way a build that
was judged gets a line in ``build_log``, and only a good one is shown: a view is
replaced in one catalog call, so a reader sees the old table or the new one, and
a build that fails its checks leaves everything as it was. Views are replaced
one after another; who needs several tables of one build opens it by
``Builds.tables``, which looks up the newest good build once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.sources.sinks import WriteLayout, ensure_db
from tristrata.sources.tables import Tables

LOG = "build_log"
LOG_SCHEMA = "build string, good boolean, failures bigint, dropped boolean, judged_at timestamp"
MARK = "__build_"


class BuildTables(Tables):
    """Tables of one build, by their plain names."""

    def __init__(self, spark: SparkSession, place: str, build: str):
        folder = "/" in place
        super().__init__(spark, f"{place.rstrip('/')}/build={build}" if folder else place)
        self.suffix = "" if folder else MARK + build.lower()

    def target(self, name: str) -> str:
        return super().target(name) + self.suffix


@dataclass(frozen=True)
class Builds:
    """All builds under a folder or in a database."""

    spark: SparkSession
    place: str

    @property
    def in_folder(self) -> bool:
        return "/" in self.place

    def _log_target(self) -> str:
        return f"{self.place.rstrip('/')}/{LOG}" if self.in_folder else f"{self.place}.{LOG}"

    def _add(self, build: str, good: bool | None, failures: int | None, dropped: bool) -> None:
        line = self.spark.range(1).select(
            F.lit(build).alias("build"),
            F.lit(good).cast("boolean").alias("good"),
            F.lit(failures).cast("bigint").alias("failures"),
            F.lit(dropped).alias("dropped"),
            F.current_timestamp().alias("judged_at"),
        )
        if self.in_folder:
            line.write.mode("append").json(self._log_target())
        else:
            ensure_db(self.spark, self.place)
            line.write.mode("append").format("parquet").saveAsTable(self._log_target())

    def log(self) -> DataFrame:
        """One row per build: (build, good, failures, dropped), as its last line says."""
        self._start()
        if self.in_folder:
            lines = self.spark.read.schema(LOG_SCHEMA).json(self._log_target())
        else:
            lines = self.spark.table(self._log_target())
        last = F.max_by(F.struct("good", "failures", "dropped"), "judged_at").alias("last")
        return lines.groupBy("build").agg(last).select("build", "last.*")

    def _start(self) -> None:
        empty = self.spark.createDataFrame([], LOG_SCHEMA)
        if self.in_folder:
            empty.write.mode("ignore").json(self._log_target())
        else:
            ensure_db(self.spark, self.place)
            empty.write.mode("ignore").format("parquet").saveAsTable(self._log_target())

    def _known(self) -> list:
        # One line per build, whatever the size of its tables.
        return sorted(self.log().collect(), key=lambda r: r["build"])

    def open(self, build: str) -> BuildTables:
        """The tables of one build, good or not."""
        return BuildTables(self.spark, self.place, build)

    def newest_good(self) -> str | None:
        return max((r["build"] for r in self._known() if r["good"] and not r["dropped"]), default=None)

    def tables(self) -> BuildTables:
        """All tables of the newest good build: they belong together."""
        build = self.newest_good()
        if build is None:
            raise ValueError(f"no good build under {self.place}")
        return self.open(build)

    def record(self, build: str, failures: int) -> None:
        """Write down the judgement of a build."""
        self._start()
        self._add(build, failures == 0, failures, False)

    def switch(self, build: str, names: Sequence[str]) -> None:
        """Show a build under the plain names. Only a database has them; a folder is shown by its log."""
        if self.in_folder:
            return
        source = self.open(build)
        for name in names:
            self._require_view(name)
        for name in names:
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.place}.{name} AS SELECT * FROM {source.target(name)}")

    def _require_view(self, name: str) -> None:
        catalog = self.spark.catalog
        if catalog.tableExists(f"{self.place}.{name}") and catalog.getTable(f"{self.place}.{name}").tableType != "VIEW":
            raise ValueError(f"{self.place}.{name} is a table, not a view: rename it before builds are switched")

    def publish(self, df: DataFrame, build: str, name: str, layout: WriteLayout | None = None) -> DataFrame:
        return self.open(build).publish(df, name, layout)

    def expire(self, names: Sequence[str], keep: int = 2) -> list[str]:
        """Drop the tables of all but the newest ``keep`` builds; the one shown stays in any case.

        The log is marked before tables go, so a call that was stopped can be repeated.
        """
        known = self._known()
        shown = self.newest_good()
        old = [r for r in known[: -max(keep, 1)] if r["build"] != shown]
        for r in old:
            if not r["dropped"]:
                self._add(r["build"], None, None, True)
        for r in old:
            self._drop(r["build"], names)
        return [r["build"] for r in old if not r["dropped"]]

    def _drop(self, build: str, names: Sequence[str]) -> None:
        if not self.in_folder:
            for name in names:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.open(build).target(name)}")
            return
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.open(build).place)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
