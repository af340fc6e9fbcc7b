"""Resampling towards a target corpus by importance weights, summed over bit planes.

Every run of one to three words is a feature, hashed to one of ``BUCKETS``
buckets. A bucket's gain is a whole number: a thousand times the log-ratio of
its smoothed share in the target corpus and in the raw one. A document's weight
is the sum of the gains of its features, repeats counted.

That sum is taken over planes of bits. Bit i of all bucket counts of a document
is one plane of ``BUCKETS`` bits; bit j of all gains is another, for positive
and for negative gains apart. The bits set in the AND of both count 2^(i+j)
each, so a weight is exact in whole numbers whatever the order of the sum.

A Gumbel number drawn from the hash of the id is added, and the documents with
the highest scores are drawn: sampling without replacement in proportion to the
weights, the same in every run.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import ship, written
from .text import ASCII_LOWER, ragged, word_slices

BUCKETS = 10_000
LONGEST_RUN = 3
#: Words are letters and digits of ASCII and all longer code points.
GAPS = np.ones(256, bool)
GAPS[48:58] = GAPS[65:91] = GAPS[97:123] = GAPS[128:] = False
#: Features hashed at once, and documents whose planes are held at once.
PIECE = 1 << 19
GROUP = 256
_LANES = -(-BUCKETS // 64)
_BYTEWISE = 48


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()


def extended(crc: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, space: bool) -> np.ndarray:
    """``zlib.crc32`` carried on over the words ``data[start:end]``, with a space before each if asked for."""
    state = ~crc.astype(np.uint32)
    if space:
        state = _CRC[(state ^ np.uint32(32)) & 255] ^ (state >> 8)
    length = end - start
    short = np.flatnonzero(length <= _BYTEWISE)
    order = short[np.argsort(-length[short], kind="stable")]
    alive = np.searchsorted(-length[order], -np.arange(_BYTEWISE + 1), "left")  # words longer than k
    at, some = start[order], state[order]
    for k in range(int(length[order[0]]) if len(order) else 0):
        n = alive[k]
        some[:n] = _CRC[(some[:n] ^ data[at[:n] + k]) & 255] ^ (some[:n] >> 8)
    state[order] = some
    state = ~state
    for i in np.flatnonzero(length > _BYTEWISE).tolist():
        state[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(state[i]))
    return state


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each word, row of each feature, bucket of each feature), a slice of the texts at a time.

    A text longer than a slice goes on in the next one: the checksums of its
    last runs are carried over.
    """
    tail: tuple[int, list[np.ndarray]] = (-1, [])
    for words in word_slices(column, GAPS):
        data = ASCII_LOWER[words.data]
        n = len(words.start)
        # crc[k] are checksums of the runs of k + 1 words that end at each word, and of those that came before.
        rows = np.concatenate([np.full(len(tail[1][0]), tail[0]), words.row]) if tail[1] else words.row
        skip = len(rows) - n
        crc = [extended(np.zeros(n, np.uint32), data, words.start, words.end, False)]
        before = np.concatenate([tail[1][0], crc[0]]) if skip else crc[0]
        ends = [before]
        row, bucket = [words.row], [crc[0] % BUCKETS]
        for k in range(1, LONGEST_RUN):
            # Runs of k words that end one word earlier, in the same text.
            i = np.arange(n) + skip
            reaches = i >= k
            reaches[reaches] = rows[i[reaches] - k] == words.row[reaches]
            here = np.flatnonzero(reaches)
            longer = np.zeros(n, np.uint32)
            longer[here] = extended(ends[-1][i[here] - 1], data, words.start[here], words.end[here], True)
            row.append(words.row[here])
            bucket.append(longer[here] % BUCKETS)
            ends.append(np.concatenate([tail[1][k], longer]) if skip else longer)
        yield words.row, np.concatenate(row), np.concatenate(bucket).astype(np.int64)
        last = int((rows == words.last).sum())
        keep = min(last, LONGEST_RUN - 1)
        tail = (words.last, [e[len(e) - keep :] for e in ends]) if keep else (-1, [])


def bucket_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(bucket, n): features of all texts in each bucket that has any.

    A task sums its part first and gives one row per bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, bucket in features(batch.column(0)):
                total += np.bincount(bucket, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counted = texts.select(F.col(text_col).cast("string")).mapInArrow(count, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log-ratio of smoothed shares, rounded down."""
    whole = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1) * whole[0] / ((s + 1) * whole[1]))) for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of rows of whole numbers from zero on: (plane, row, lane of 64 buckets)."""
    bits = max(1, int(values.max(initial=0)).bit_length())
    out = np.zeros((bits, len(values), _LANES * 8), np.uint8)
    for i in range(bits):
        packed = np.packbits((values >> i & 1).astype(np.uint8), axis=1)
        out[i, :, : packed.shape[1]] = packed
    return out.view(np.uint64)


def weights(counts: np.ndarray, gain_planes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Exact sums of counts times gains: popcounts of planes of both, each worth its power of two."""
    out = np.zeros(len(counts), np.int64)
    for i, plane in enumerate(planes(counts)):
        rows = np.flatnonzero(plane.any(axis=1))
        for sign, of_sign in ((1, gain_planes[0]), (-1, gain_planes[1])):
            for j, gain in enumerate(of_sign[:, 0]):
                set_bits = np.bitwise_count(plane[rows] & gain).sum(axis=1, dtype=np.int64)
                out[rows] += sign * (set_bits << (i + j))
    return out


def gumbel_score(weight: Column, id_col: Column, seed: int) -> Column:
    """Weight plus a Gumbel number drawn from the id's hash, in thousandths."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_col.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return weight + F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with their place (rank, from 1) in one order over all of them.

    Rows are dealt into ranges of that order; the sizes of the ranges, one
    number each, tell where a range begins. No task sees more than its range.
    """
    dealt = written(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_inside", inside).join(starts, "_range").withColumn("rank", F.col("_inside") + F.col("_before")).drop("_range", "_inside", "_before")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; ``rank`` is null for those not drawn.

    Drawn are ``percent`` of a hundred of the documents with ``least_words``
    words or more, rounded down, by highest score; ties go to the smaller id,
    then to the smaller weight and fewer features. Null and empty texts have no features, weight 0 and are not
    drawn if any word is asked for. A null id has no score and is never drawn.
    Repeated rows count each time and are ranked each; other columns are not
    looked at. Empty tables: no documents give no rows, an empty target gives
    gains against equal shares of all buckets.

    The texts are read twice, for the counts of the corpus and for the weights;
    what reaches the driver are the counts of ``BUCKETS`` buckets.
    """
    spark = docs.sparkSession
    ship(spark)
    given = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    totals = []
    for counted in (bucket_counts(given, "text"), bucket_counts(target, target_col)):
        total = np.zeros(BUCKETS, np.int64)
        found = counted.toArrow()
        total[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
        totals.append(total)
    gain = gains(*totals)
    shared = spark.sparkContext.broadcast((planes(np.maximum(gain, 0)[None]), planes(np.maximum(-gain, 0)[None])))
    names = ["doc_id", "n_words", "n_features", "weight"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for word_row, row, bucket in features(batch.column("text")):
                if not len(row):
                    continue
                n_words += np.bincount(word_row, minlength=batch.num_rows)
                n_features += np.bincount(row, minlength=batch.num_rows)
                order = np.argsort(row, kind="stable")
                row, bucket = row[order], bucket[order]
                for at in range(int(row[0]), int(row[-1]) + 1, GROUP):
                    here = slice(*np.searchsorted(row, [at, at + GROUP]))
                    size = min(GROUP, int(row[-1]) + 1 - at)
                    counts = np.bincount((row[here] - at) * BUCKETS + bucket[here], minlength=size * BUCKETS).reshape(size, BUCKETS)
                    weight[at : at + size] += weights(counts, shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words), pa.array(n_features), pa.array(weight)], names)

    weighed = given.mapInArrow(weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    scored = written(weighed.withColumn("score", gumbel_score(F.col("weight"), F.col("doc_id"), seed)), "weights")
    eligible = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    # As many as count, ids or not: a document without id takes no one's place.
    drawn = percent * scored.where(F.col("n_words") >= least_words).count() // 100
    order = [F.desc("score"), F.asc("doc_id"), F.asc("weight"), F.asc("n_features"), F.asc("n_words")]
    places = ranked(scored.where(eligible), order)
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("bigint")
    rest = scored.where(~eligible).withColumn("rank", F.lit(None).cast("bigint"))
    columns = [*names, "score", "rank"]
    return places.withColumn("rank", rank).select(columns).unionByName(rest.select(columns))
