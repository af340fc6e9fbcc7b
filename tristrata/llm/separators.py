"""Token counts from flat token files that have no index: a scan for end-of-document ids.

A file is a sequence of blocks of ids. Each block is searched by itself; what
it can't know (how many documents ended before it, where the last one ended)
comes from a prefix scan over blocks, in two levels so that no task sees more
than a bounded run of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tristrata.sources.workspace import fresh_folder

from .packing import id_rows
from .tables import ship
from .word_bpe import tokenizer_path, word_bpe

BLOCK_TOKENS = 1 << 16
RUN_BLOCKS = 1024
#: <|endoftext|> of the word tokenizer.
SEPARATOR = 49407


def write_flat(docs: DataFrame, tokenizer: str | None = None, separator: int = SEPARATOR, block: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Tokenise documents into flat files, one a task: (blocks, names).

    ``blocks`` (file, block, ids) holds nothing but ids, each document followed
    by the separator, cut every ``block`` ids wherever that falls. ``names``
    (file, ordinal, doc_id) lists which documents went into a file, in order.
    The separator's text inside a document is ordinary text; a null text is
    empty; repeated rows are written each.
    """
    path = tokenizer or tokenizer_path()
    ship(docs.sparkSession)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, file = word_bpe(path, special=False), TaskContext.get().partitionId()
        end = np.array([separator], np.uint16)
        wait: list[np.ndarray] = []
        size = number = ordinal = 0

        def rows(kind: str, blocks: list, ids: list, ordinals: list, names: pa.Array) -> pa.RecordBatch:
            n = max(len(ids), len(ordinals))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file] * n, pa.int32()),
                    pa.array(blocks or [None] * n, pa.int64()),
                    id_rows(ids, "<u2") if ids else pa.nulls(n, pa.binary()),
                    pa.array(ordinals or [None] * n, pa.int64()),
                    names,
                    pa.array([kind] * n),
                ],
                ["file", "block", "ids", "ordinal", "doc_id", "kind"],
            )

        kept = pa.int64()
        for batch in batches:
            names = batch.column("doc_id")
            kept = names.type
            if batch.num_rows:
                yield rows("name", [], [], list(range(ordinal, ordinal + batch.num_rows)), names)
                ordinal += batch.num_rows
            for ids in bpe.by_row(batch.column("text")):
                wait += [ids, end]
                size += len(ids) + 1
                if size >= 16 * block:
                    flat = np.concatenate(wait)
                    full = len(flat) // block
                    cuts = [flat[i * block : (i + 1) * block] for i in range(full)]
                    yield rows("block", list(range(number, number + full)), cuts, [], pa.nulls(full, kept))
                    number += full
                    wait, size = [flat[full * block :]], len(flat) - full * block
        if size:
            flat = np.concatenate(wait)
            cuts = [flat[i : i + block] for i in range(0, len(flat), block)]
            yield rows("block", list(range(number, number + len(cuts))), cuts, [], pa.nulls(len(cuts), kept))

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"file int, block bigint, ids binary, ordinal bigint, doc_id {dict(rows.dtypes)['doc_id']}, kind string"
    folder = fresh_folder(docs.sparkSession, "flat-tokens")
    rows.mapInArrow(tokenize, schema).write.partitionBy("kind").parquet(folder)
    store = docs.sparkSession.read.schema(schema).parquet(folder)
    return (
        store.where("kind = 'block'").select("file", "block", "ids"),
        store.where("kind = 'name'").select("file", "ordinal", "doc_id"),
    )


def scan(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = "<u2") -> DataFrame:
    """Every document of flat files: (file, ordinal, start, n_tokens, closed).

    ``blocks`` has file, block (their order) and ids (binary, of ``dtype``);
    blocks may differ in size, null or empty ones hold nothing. ``n_tokens``
    leaves out the separator. Ids after the last separator of a file are one
    more document with ``closed`` false; two separators in a row enclose one
    without ids. A null file or block is a key like any other.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, places = [], []
            for raw in batch.column("ids").to_pylist():
                ids = np.frombuffer(raw or b"", dtype)
                size.append(len(ids))
                places.append(np.flatnonzero(ids == separator))
            ends = np.cumsum([0] + [len(p) for p in places]).astype(np.int32)
            flat = np.concatenate(places) if places else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(size, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))],
                ["file", "block", "size", "places"],
            )

    ship(blocks.sparkSession)
    kinds = dict(blocks.dtypes)
    found = blocks.select("file", "block", "ids").mapInArrow(find, f"file {kinds['file']}, block {kinds['block']}, size bigint, places array<bigint>")
    found = found.withColumn("run", F.floor(F.coalesce(F.col("block"), F.lit(-1)) / RUN_BLOCKS)).withColumn("ends", F.size("places"))

    # Inside a run of blocks: ids and separators before each block, and the last separator, counted from the run's start.
    earlier = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    found = found.withColumn("ids_before", zero(F.sum("size").over(earlier))).withColumn("ends_before", zero(F.sum("ends").over(earlier)))
    found = found.withColumn("last_end", F.when(F.col("ends") > 0, F.col("ids_before") + F.element_at("places", -1)))
    found = found.withColumn("end_before", F.max("last_end").over(earlier))

    # The same over the runs of a file.
    runs = found.groupBy("file", "run").agg(F.sum("size").alias("size"), F.sum("ends").alias("ends"), F.max("last_end").alias("last_end"))
    earlier = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("run_ids", zero(F.sum("size").over(earlier))).withColumn("run_ends", zero(F.sum("ends").over(earlier)))
    runs = runs.withColumn("last_end", F.col("run_ids") + F.col("last_end"))
    runs = runs.withColumn("run_end", F.coalesce(F.max("last_end").over(earlier), F.lit(-1)))

    there = runs.select(F.col("file").alias("f"), F.col("run").alias("r"), "run_ids", "run_ends", "run_end")
    both = found.join(there, found["file"].eqNullSafe(there["f"]) & (found["run"] == there["r"]))
    both = both.select(
        "file",
        (F.col("run_ends") + F.col("ends_before")).alias("ordinal"),
        F.coalesce(F.col("run_ids") + F.col("end_before"), F.col("run_end")).alias("previous"),
        F.expr("transform(places, p -> p + run_ids + ids_before)").alias("places"),
    )
    closed = both.select(
        "file",
        "ordinal",
        F.posexplode(F.expr("transform(places, (p, i) -> struct(CASE WHEN i = 0 THEN previous ELSE places[i - 1] END + 1 AS start, p AS stop))")).alias("i", "at"),
    ).select("file", (F.col("ordinal") + F.col("i")).alias("ordinal"), F.col("at.start").alias("start"), (F.col("at.stop") - F.col("at.start")).alias("n_tokens"), F.lit(True).alias("closed"))
    files = runs.groupBy("file").agg(F.sum("size").alias("size"), F.sum("ends").alias("ordinal"), F.coalesce(F.max("last_end"), F.lit(-1)).alias("last"))
    left = files.where(F.col("last") + 1 < F.col("size")).select("file", "ordinal", (F.col("last") + 1).alias("start"), (F.col("size") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.union(left)


def document_counts(docs: DataFrame, tokenizer: str | None = None, separator: int = SEPARATOR, block: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_tokens, file, ordinal, start): flat files of the documents, scanned, with the names put back by their order."""
    blocks, names = write_flat(docs, tokenizer, separator, block)
    counted = scan(blocks, separator).withColumnsRenamed({"file": "f", "ordinal": "o"})
    return names.join(counted, (names["file"] == counted["f"]) & (names["ordinal"] == counted["o"])).select("doc_id", "n_tokens", "file", "ordinal", "start")
