"""Landing raw files as dated Parquet."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.sources.bronze import INGEST_DT
from tristrata.sources.sinks import WriteLayout

BAD_ROW = "_corrupt_record"
SOURCE_FILE = "_source_file"

# Texts that stand for a missing value in a raw CSV cell.
NULL_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Readers by file extension. Files of any other kind are kept as they are, one
# row with path, time, length and content per file.
READERS = {"csv": "csv", "json": "json", "orc": "orc", "parquet": "parquet", "txt": "text"}
OPAQUE = "binaryFile"
# Endings of compressed text that Spark's readers unpack by themselves.
PACKED = ("gz", "bz2", "deflate")
TEXT = ("csv", "json", "txt")

REPORT = "entity string, format string, status string, rows long, bad_rows long, error string"


def stringify(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast the given columns, where present, to text (default: all)."""
    wanted = set(df.columns if columns is None else columns)
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in df.columns if c in wanted})


def read_raw_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = False,
    source_file: bool = False,
) -> DataFrame:
    """CSV with a header line, every column as text.

    Types are not inferred: inference costs a pass over the data, reads a clock
    time as a timestamp of today and drops leading zeros. Given ``columns``, no
    job runs at all and the header is checked against them. Rows that do not fit
    the header are kept, with their text in ``_corrupt_record``. Files stay
    splittable unless ``multi_line`` allows line breaks inside quotes; files
    packed as a whole (``x.csv.gz``) are not. ``source_file`` adds the path each
    row comes from.
    """
    reader = (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_ROW)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("multiLine", multi_line)
    )
    paths = [path] if isinstance(path, str) else list(path)
    if columns is None:
        columns = reader.csv(paths).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, BAD_ROW]])
    df = reader.schema(schema).option("enforceSchema", False).csv(paths)
    missing = ["", *null_tokens]
    tidy = [F.when(~F.col(f"`{c}`").isin(missing), F.col(f"`{c}`")).alias(c) for c in columns]
    origin = [F.col("_metadata.file_path").alias(SOURCE_FILE)] if source_file else []
    return df.select(*tidy, BAD_ROW, *origin)


def read_raw(spark: SparkSession, path: str | Sequence[str], fmt: str, **kwargs) -> DataFrame:
    """Raw rows of files with the given extension; CSV as in ``read_raw_csv``."""
    if fmt == "csv":
        return read_raw_csv(spark, path, **kwargs)
    reader = spark.read.format(READERS.get(fmt, OPAQUE))
    if fmt in ("parquet", "orc"):
        # Files of one entity may differ in columns; none is lost.
        reader = reader.option("mergeSchema", True)
    return reader.load(path if isinstance(path, str) else list(path))


def discover(spark: SparkSession, root: str, entities: Sequence[str] = ()) -> DataFrame:
    """Data files under ``root``, at any depth, with the entity they belong to.

    Columns: path, entity, format, bytes, modified. A file belongs to the
    longest of ``entities`` that its name, else its folder, starts with; without
    any it is an entity of its own. Packed text counts as what it holds:
    ``x.csv.gz`` is CSV. Only file metadata is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    name = F.regexp_replace(name, rf"(\.(?:{'|'.join(TEXT)}))\.(?:{'|'.join(PACKED)})$", "$1")
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    folder = F.lower(F.try_element_at(F.split("path", "/"), F.lit(-2)))
    by_length = sorted(entities, key=len, reverse=True)
    matches = [F.when(part.startswith(e), F.lit(e)) for part in (stem, folder) for e in by_length]
    owner = F.coalesce(*matches, stem)
    return files.select(
        "path",
        owner.alias("entity"),
        F.regexp_extract(name, r"\.([^.]+)$", 1).alias("format"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def land(
    df: DataFrame,
    base: str,
    entity: str,
    ingest_dt: date,
    layout: WriteLayout | None = None,
) -> None:
    """Write raw rows under ``<base>/<entity>/ingest_dt=<day>/``.

    Only the partition of that day is replaced, so landing the same day again
    gives the same table. No shuffle.
    """
    day = F.lit(ingest_dt).cast("date")
    writer = df.withColumn(INGEST_DT, day).write.mode("overwrite").partitionBy(INGEST_DT)
    writer = (layout or WriteLayout()).apply(writer.option("partitionOverwriteMode", "dynamic"))
    writer.parquet(f"{base.rstrip('/')}/{entity}")


def header_groups(spark: SparkSession, paths: Sequence[str]) -> tuple[list[list[str]], list[str]]:
    """CSV files with the same first line, and those that have none or can't be opened.

    One distributed query whatever the number of files: each task keeps the
    hash of the first line of the files it begins, and one row per file is
    shuffled. Only the groups come back. Hashes are numbers, which an aggregate
    holds once a file; the least of a text would sort all lines of a task. Should
    two headers share one, the read of that group fails, as headers are checked.
    """
    groups = _first_lines(spark, paths).groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("paths").collect()
    given = {_plain_path(p): p for p in paths}
    found = [[given[_plain_path(unquote(p))] for p in g.paths] for g in groups]
    known = {p for group in found for p in group}
    return found, [p for p in paths if p not in known]


def _first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The hash of every file's first line: (path, header)."""
    lines = spark.read.option("ignoreCorruptFiles", True).text(list(paths)).select(
        "value", F.monotonically_increasing_id().alias("place"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )
    header = F.xxhash64(F.ltrim("value", F.lit("\ufeff")))
    return lines.where("start = 0").groupBy("path").agg(F.min_by(header, "place").alias("header"))


def _plain_path(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def _by_header(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """CSV files whose headers differ, lined up by column name.

    Files with the same header are read together. Also returns the files that
    could not be opened or are empty.
    """
    groups, unreadable = header_groups(spark, paths)
    if not groups:
        raise ValueError("no file could be read")
    columns = [spark.read.option("header", True).csv(group[0]).columns for group in groups]
    # In the order of their headers, which gives the columns their places.
    ordered = sorted(zip(columns, groups), key=lambda pair: ",".join(pair[0]))
    frames = [read_raw_csv(spark, group, names, source_file=True) for names, group in ordered]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), unreadable


def _land_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> tuple[int, int]:
    # The counts ride along with the write; nothing is read a second time.
    counts = Observation()
    bad = F.count(BAD_ROW) if BAD_ROW in df.columns else F.lit(0)
    write(df.observe(counts, F.count(F.lit(1)).alias("rows"), bad.cast("long").alias("bad")))
    return counts.get["rows"], counts.get["bad"]


def land_all(
    spark: SparkSession,
    root: str,
    base: str,
    ingest_dt: date,
    entities: Sequence[str] = (),
    layout: WriteLayout | None = None,
    threads: int = 4,
) -> DataFrame:
    """Land every entity found under ``root`` and report on each.

    An entity that fails is reported and the others continue; a few are
    submitted to Spark at a time. CSV files of one entity may differ in their
    columns. The driver holds the file
    names, as Spark's own file index does, and no data.
    """
    groups: dict[tuple[str, str], list[str]] = {}
    for file in discover(spark, root, entities).select("entity", "format", "path").collect():
        groups.setdefault((file.entity, file.format), []).append(file.path)
    owners = [entity for entity, _ in groups]

    def load(group: tuple[str, str]) -> tuple:
        entity, fmt = group
        paths = sorted(groups[group])
        # Two formats of one entity are two datasets, else one would replace
        # the other.
        target = entity if owners.count(entity) == 1 else f"{entity}_{fmt}"

        def store(df: DataFrame) -> tuple[int, int]:
            return _land_counted(df, lambda d: land(d, base, target, ingest_dt, layout))

        try:
            try:
                rows, bad = store(read_raw(spark, paths, fmt, **({"source_file": True} if fmt == "csv" else {})))
                return (target, fmt, "ok", rows, bad, None)
            except Exception:
                if fmt != "csv" or len(paths) == 1:
                    raise
            df, unreadable = _by_header(spark, paths)
            rows, bad = store(df)
            note = f"not read: {', '.join(unreadable[:20])}{' and more' if len(unreadable) > 20 else ''}" if unreadable else None
            return (target, fmt, "partial" if unreadable else "ok", rows, bad, note)
        except Exception as error:  # noqa: BLE001 - reported, the rest continue
            return (target, fmt, "failed", None, None, str(error).split("\n")[0])

    with ThreadPoolExecutor(threads) as pool:
        return spark.createDataFrame(list(pool.map(load, sorted(groups))), REPORT)
