"""Reading the given tables and writing intermediate ones."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import pickle
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tristrata.sources.workspace import fresh_folder


_shipped: set[str] = set()
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once for each application.

    Where the session does not bound the bytes of Arrow batches, they are held
    at 4 MB, or one row: a number of rows alone says nothing of texts.
    """
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, "4m")
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="tristrata-code-")) / "tristrata.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: it survives lost executors and its size is known to the planner."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def learned(rows: DataFrame, learn: Callable[[pa.Table], object]) -> object:
    """What ``learn`` makes of a bounded table, inside one task: neither rows nor training burden the driver.

    Only the pickled result comes back. An empty table is learned from as well.
    """

    def run(_: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).select(columns)
        result = pa.array([pickle.dumps(learn(table))], pa.binary())
        del table
        _give_back()
        yield pa.RecordBatch.from_arrays([result], ["learned"])

    columns = rows.columns
    found = rows.groupBy(F.lit(0).alias("_all")).applyInArrow(run, "learned binary").collect()
    return pickle.loads(found[0].learned) if found else learn(rows.limit(0).toArrow())


def frugal(per_batch: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``per_batch``, and what it has freed goes back to the system when a task ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from per_batch(batches)
        finally:
            _give_back()

    return run


def _give_back() -> None:
    """Return freed memory to the system: this worker goes on to serve other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether a document belongs to the fold that no model learns from; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def bounded_bytes(rows: DataFrame, column: str, order: list[str], most: int) -> DataFrame:
    """The rows of a bounded sample that come first and hold at most ``most`` bytes in ``column`` together."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_bytes", F.sum(F.octet_length(column)).over(before)).where(F.col("_bytes") <= most).drop("_bytes")


def bounded_sample(rows: DataFrame, key: str, stratum: str, most: int, seed: int = 7) -> DataFrame:
    """About ``most`` rows, spread evenly over the values of ``stratum``, chosen by the hash of ``key``.

    Only the number of rows per stratum reaches the driver. A first cut by the
    hash leaves about twice the rows wanted, so the exact cut behind it ranks a
    bounded number of rows however large the table is.
    """
    draw = F.abs(F.xxhash64(F.lit(seed), F.col(key))) / F.lit(float(2**63))
    counts = {r[0]: r[1] for r in rows.groupBy(stratum).count().collect()}
    if not counts:
        return rows.limit(0)
    each = max(1, most // len(counts))
    share = F.lit(0.0)
    for value, count in counts.items():
        share = F.when(F.col(stratum).eqNullSafe(F.lit(value)), F.lit(min(1.0, (2.0 * each + 50) / count))).otherwise(share)
    few = rows.withColumn("_draw", draw).where(F.col("_draw") <= share)
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy("_draw", key))
    return few.withColumn("_rank", rank).where(F.col("_rank") <= each).drop("_draw", "_rank")
