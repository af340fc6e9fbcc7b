"""Bronze to silver as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.operators.conform import Contract, conform
from tristrata.sources.sinks import INGEST_DAY, with_load_day

ARRIVED_AT = "arrived_at"
PART = "arrival_part"
BATCH = "batch"


def raw_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    **options,
) -> DataFrame:
    """Files of a folder as a stream, each row with the time its file arrived
    and a number that tells the parts of the input apart.

    Files are taken in order of arrival, so a watermark on ``arrived_at`` never
    passes rows that are still to come, whatever their business time is.
    """
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    arrived = F.col("_metadata.file_modification_time").alias(ARRIVED_AT)
    part = F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias(PART)
    return reader.load(path).select("*", arrived, part)


def silver_stream(
    raw: DataFrame,
    contract: Contract,
    keys: Sequence[str],
    run_ts: Column | None = None,
    horizon: str = "1 day",
    spread: int = 16,
) -> DataFrame:
    """Conformed rows, each key once within ``horizon`` of its first arrival.

    The state kept per key is its expiry time only, and is dropped once the
    watermark passes it. Repeats are removed in two steps, first per key and
    part of the input, in ``spread`` groups, then per key: a key that is
    delivered over and over spreads over that many tasks and reaches its single
    task at most ``spread`` times. ``spread=1`` leaves out the first step and
    its state, for sources that repeat rows evenly.
    """
    stamp = F.col(ARRIVED_AT) if run_ts is None else run_ts
    rows = conform(raw, contract, stamp, carry=[ARRIVED_AT, PART])
    rows = rows.withWatermark(ARRIVED_AT, horizon)
    if spread > 1:
        salted = rows.withColumn(PART, F.pmod(F.col(PART), F.lit(spread)))
        rows = salted.dropDuplicatesWithinWatermark([*keys, PART])
    return rows.drop(PART).dropDuplicatesWithinWatermark(list(keys))


# Settings of the state that newest rows wait in: files on local disk with changes kept in the
# checkpoint, not the heap of the executors, and sessions merged before rows are shuffled.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def keep_state_on_disk(spark: SparkSession) -> None:
    """Apply ``STATE`` where the session has nothing of its own; call it before the first run of a stream."""
    for name, value in STATE.items():
        own = spark.conf.get(name, None)
        if own is None or own in ("false", "") or own.endswith("HDFSBackedStateStoreProvider"):
            spark.conf.set(name, value)


def newest_stream(
    raw: DataFrame,
    contract: Contract,
    keys: Sequence[str],
    horizon: str = "1 day",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Conformed rows, of each key the newest once ``horizon`` has passed without another.

    Rows of a key that arrive within ``horizon`` of each other are one session;
    when it closes, its newest row comes out: the last by ``order_by``, then by
    arrival, then by the greatest values from left to right, as
    ``latest_per_key`` decides. A key that comes again later opens another
    session, so a table of these rows has a key once a session, and
    ``latest_per_key`` over its load time gives what it gives over all rows.

    The state holds one row per open session. Repeats in one part of the input
    are merged before the shuffle, so a key that is delivered over and over
    sends a row a task. Keep the state on disk by ``keep_state_on_disk``.
    """
    rows = conform(raw, contract, F.col(ARRIVED_AT), carry=[ARRIVED_AT]).withWatermark(ARRIVED_AT, horizon)
    rest = [c for c in rows.columns if c not in (*keys, *order_by, ARRIVED_AT)]
    place = F.struct(*order_by, ARRIVED_AT, *rest)
    sessions = rows.groupBy(*keys, F.session_window(ARRIVED_AT, horizon).alias("session")).agg(F.max(place).alias("newest"))
    return sessions.select(*[F.col(c) if c in keys else F.col(f"newest.{c}").alias(c) for c in rows.columns])


def stream_to_silver(rows: DataFrame, target: str, checkpoint: str) -> None:
    """Process everything available and stop.

    Each micro-batch owns the partitions ``ingest_day=../batch=<id>``; a batch
    that is run again after a failure replaces them, so every row is stored
    once. On a schedule this is an incremental load: the checkpoint remembers
    which files were taken.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            with_load_day(batch.drop(ARRIVED_AT))
            .withColumn(BATCH, F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(INGEST_DAY, BATCH)
            .parquet(target)
        )

    query = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
