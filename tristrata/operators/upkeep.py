"""Small-file compaction of Parquet tables partitioned by load day."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tristrata.sources.sinks import INGEST_DAY
from tristrata.sources.workspace import cut_lineage

TARGET_BYTES = 128 * 1024 * 1024
#: Files of this share of the target or more stay as they are.
LARGE = 0.75
#: Calls to the file system at a time during a swap.
CALLS = 16
#: Prefix of the folder, hidden from readers, that a compaction writes to first.
STAGED = "_compacting-"
REPORT = (
    "table string, days int, files_before long, files_after long, "
    "bytes_before long, bytes_after long, rows long"
)


def _listing(spark: SparkSession, path: str, day: date | None = None) -> DataFrame:
    """Data files with their partition columns: (path, length, ...). Reads no data."""
    root = path.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("basePath", root)
        .option("pathGlobFilter", "*.parquet")
        .load(root if day is None else f"{root}/{INGEST_DAY}={day.isoformat()}")
    )
    return files.drop("content", "modificationTime").withColumn(INGEST_DAY, F.col(INGEST_DAY).cast("date"))


def _sizes(files: DataFrame, by: Sequence[str]) -> DataFrame:
    return files.groupBy(*by).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def day_files(spark: SparkSession, path: str, day: date | None = None) -> DataFrame:
    """Files and bytes per load day: (ingest_day, files, bytes). Reads no data."""
    return _sizes(_listing(spark, path, day), [INGEST_DAY])


def fragmented_days(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Days stored in more files than their bytes call for, with that number."""
    wanted = F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("int")
    return files.withColumn("wanted", wanted).where(F.col("files") > F.col("wanted"))


def small_files(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Files that a compaction may merge."""
    return files.where(F.col("length") < LARGE * target_bytes)


def _each(call: Callable, items: Iterable) -> None:
    """Calls that don't depend on each other, some at a time."""
    with ThreadPoolExecutor(CALLS) as pool:
        list(pool.map(call, items))


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path and the constructor of its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def finish_compactions(spark: SparkSession, path: str) -> None:
    """Complete the swap of compactions that were stopped in the middle.

    A compaction with a complete record has written all its files: what is not
    in place yet is moved there, then the replaced files go. One without a
    record has changed nothing, and its staged files are dropped. Each step can
    be repeated.
    """
    fs, make = _hadoop(spark, path)
    if not fs.exists(make(path)):
        return
    for stage in [s.getPath() for s in fs.listStatus(make(path)) if s.getPath().getName().startswith(STAGED)]:
        if fs.exists(make(stage, "_replaced/_SUCCESS")):
            replaced = spark.read.parquet(f"{stage.toString()}/_replaced").collect()
            data = make(stage, "data")
            base, moved = len(fs.makeQualified(data).toString()) + 1, _staged(fs, data)

            def move(file: str, base: int = base) -> None:
                target = make(path, file[base:])
                fs.mkdirs(target.getParent())
                if not fs.rename(make(file), target):
                    raise OSError(f"{file} could not be moved to {target.toString()}")

            _each(move, moved)
            _each(lambda r: fs.delete(make(r.path), False), replaced)
        fs.delete(stage, True)
    spark.catalog.refreshByPath(path)


def _staged(fs, data) -> dict[str, int]:
    """Paths and sizes of the data files under a folder."""
    out, found = {}, fs.listFiles(data, True)
    while found.hasNext():
        status = found.next()
        if status.getPath().getName().endswith(".parquet"):
            out[fs.makeQualified(status.getPath()).toString()] = status.getLen()
    return out


@dataclass(frozen=True)
class Rewritten:
    """What a compaction did: rows and files it read, and files it wrote, with their bytes."""

    rows: int = 0
    files_read: int = 0
    bytes_read: int = 0
    files_written: int = 0
    bytes_written: int = 0


def _replace_files(rows: DataFrame, path: str, files: dict[str, int], parts: Sequence[str]) -> Rewritten:
    spark = rows.sparkSession
    stage = f"{path.rstrip('/')}/{STAGED}{uuid.uuid4().hex}"
    counted = Observation()
    rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.partitionBy(*parts).parquet(f"{stage}/data")
    fs, make = _hadoop(spark, path)
    gone: list[str] = []
    _each(lambda f: None if fs.exists(make(f)) else gone.append(f), files)
    if gone or not counted.get["rows"]:
        fs.delete(make(stage), True)
        if gone:
            raise RuntimeError(f"{len(gone)} files of {path} were replaced during the compaction, e.g. {min(gone)}")
        return Rewritten()
    new = _staged(fs, make(stage, "data"))
    spark.createDataFrame([(f,) for f in files], "path string").coalesce(1).write.parquet(f"{stage}/_replaced")
    finish_compactions(spark, path)
    return Rewritten(counted.get["rows"], len(files), sum(files.values()), len(new), sum(new.values()))


def compact_day(
    spark: SparkSession, path: str, day: date, target_bytes: int = TARGET_BYTES
) -> int:
    """Rewrite the small files of one load day in files of about ``target_bytes``; returns their rows.

    Spark packs small files into scan tasks of bounded size, and merging those
    tasks needs no shuffle: the rows of a day are read and written once, by as
    many tasks as there are files to write. See ``compact`` for what happens to
    loads that arrive meanwhile.
    """
    finish_compactions(spark, path)
    return _compact(spark, path, _listing(spark, path, day), target_bytes, one_day=True).rows


def compact(
    spark: SparkSession,
    path: str,
    since: date | None = None,
    target_bytes: int = TARGET_BYTES,
) -> int:
    """Compact every fragmented day of a table in one job; returns rows rewritten.

    Only files clearly smaller than ``target_bytes`` are read and written: large
    ones stay, and so do days whose small files are few enough. Further
    partition columns (the batch of a streamed table) stay. The scan mixes
    days in a task, so rows are rebalanced by day first: adaptive execution
    merges small days into one task and splits a day that is large. The driver
    holds the paths of the files to be replaced, as the scan of them does.

    Only the files that were listed are read and replaced: a load appended
    meanwhile stays as it is. If one of them has gone when the new files are
    written, as after a reload of its day, nothing is changed and the
    compaction raises. New files are in place before old ones go, so a reader
    of that moment may see rows twice, but none is ever missing;
    ``finish_compactions`` completes a swap that was stopped. One compaction
    at a time may run on a table.
    """
    finish_compactions(spark, path)
    return _compact(spark, path, _since(_listing(spark, path), since), target_bytes).rows


def _since(files: DataFrame, since: date | None) -> DataFrame:
    return files if since is None else files.where(F.col(INGEST_DAY) >= F.lit(since))


def _compact(spark: SparkSession, path: str, files: DataFrame, target_bytes: int, one_day: bool = False) -> Rewritten:
    parts = [c for c in files.columns if c not in ("path", "length")]
    files = small_files(files, target_bytes)
    sizes = _sizes(files, parts)
    wanted = sizes if one_day else fragmented_days(sizes, target_bytes)
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"f.{c}")) for c in parts]
    chosen = files.alias("f").join(wanted.alias("w"), same, "left_semi").select("path", "length").collect()
    if len(chosen) < (2 if one_day else 1):
        return Rewritten()
    names = {r.path: r.length for r in chosen}
    rows = spark.read.option("basePath", path).option("mergeSchema", True).parquet(*names)
    if one_day:
        rows = rows.coalesce(max(1, math.ceil(sum(r.length for r in chosen) / target_bytes)))
    else:
        rows = rows.hint("rebalance", *(F.col(c) for c in parts))
    return _replace_files(rows, path, names, parts)


def maintain(
    spark: SparkSession,
    tables: dict[str, str],
    as_of: date,
    window_days: int | None = None,
    target_bytes: int = TARGET_BYTES,
) -> DataFrame:
    """Compact a list of tables and report files and bytes before and after.

    All days are considered; ``window_days`` limits that to the days loaded
    last, where earlier runs are known to have compacted the others.
    """
    since = None if window_days is None else as_of - timedelta(days=window_days)
    report = []
    for name, path in tables.items():
        finish_compactions(spark, path)
        files = cut_lineage(_listing(spark, path))  # listed once: one row per file
        days, count, size = _totals(_sizes(files, [INGEST_DAY]))
        done = _compact(spark, path, _since(files, since), target_bytes)
        after = count - done.files_read + done.files_written, size - done.bytes_read + done.bytes_written
        report.append((name, days, count, after[0], size, after[1], done.rows))
    return spark.createDataFrame(report, REPORT)


def _totals(files: DataFrame) -> Sequence[int]:
    return files.agg(
        F.count(F.lit(1)).cast("int"), F.coalesce(F.sum("files"), F.lit(0)),
        F.coalesce(F.sum("bytes"), F.lit(0)),
    ).first()
