"""Jaccard join of documents on word n-grams: rare-first prefix filtering.

Documents with equal sets are one class from the start, so copies never meet.
Classes are joined on the rarest n-grams of their sets; candidate pairs pass
length, positional, parity and suffix filters and are verified once on their
sets. The join gives every link and counts the links of each document. Callers
that want groups alone get them by a shorter way: each n-gram first links its
classes to one leader, and whatever is still apart afterwards is compared pair
by pair, so that no group is expanded into all of its pairs.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from .components import components
from .packing import id_rows
from .tables import frugal, ship, written
from .text import ASCII_LOWER, mix, words_by_row

#: Counters of the table that tells rare n-grams from frequent ones. Its size is
#: fixed (32 MB); n-grams that share a counter only seem more frequent than they
#: are, which costs time but no result, as does the end of a counter's range.
COUNTER_BITS = 24
COUNTERS = 1 << COUNTER_BITS
COUNTER_ROWS = 256
#: Bits of the parity filter, a multiple of 64.
PARITY_BITS = 512
_FOLD = np.uint64(0x9FB21C651E98DF25)
_SEEN = 1 << 17
#: Classes of one n-gram that meet in one part of the join; more are dealt into blocks.
BLOCK = 1024


def ngram_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``n`` words; with fewer words, of the whole; without words, none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    run = min(n, len(words))
    out = np.full(len(words) - run + 1, run, np.uint64)
    for k in range(run):
        out = mix(out * _FOLD + words[k : len(words) - run + 1 + k])
    return np.unique(out)


def signature(grams: np.ndarray) -> int:
    """64 bits that stand for a set; sets are the same if these and their sizes are."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def parities(grams: np.ndarray) -> np.ndarray:
    """For each of the classes that hashes fall into, whether their number is odd, as 64-bit words.

    An element that only one of two sets has flips one bit, so the sets differ
    in at least as many elements as these bits do.
    """
    odd = np.bincount((grams & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def counter_of(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def rare_first(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The set in the one order that all documents share: by counted frequency, then by value."""
    return grams[np.lexsort((grams, counts[counter_of(grams)]))]


@dataclass
class Counters:
    """The table of counters in compressed parts (part, counts), which every Python worker expands once."""

    parts: list[tuple[int, bytes]]

    @cached_property
    def table(self) -> np.ndarray:
        counts, step = np.zeros(COUNTERS, np.uint16), COUNTERS // COUNTER_ROWS
        for part, raw in self.parts:
            counts[part * step : (part + 1) * step] = np.frombuffer(zlib.decompress(raw), "<u2")
        return counts


def least_overlap(percent: int, x, y):
    """The smallest overlap with 100 * overlap >= percent * union."""
    return -(-percent * (x + y) // (100 + percent))


def suffix_apart(x: np.ndarray, y: np.ndarray, most: int, depth: int = 3) -> bool:
    """Whether two sorted sets differ in more than ``most`` elements for sure, seen from the sizes of their parts.

    A pivot splits both; elements on different sides never match, so the
    differences in size of the parts add up to a lower bound.
    """
    bound = abs(len(x) - len(y))
    parts = [(x, y)]
    for _ in range(depth):
        if bound > most:
            return True
        halves = []
        for a, b in parts:
            if not len(a) or not len(b):
                halves.append((a, b))
                continue
            pivot = a[len(a) // 2]
            i, j = np.searchsorted(a, pivot), np.searchsorted(b, pivot)
            halves += [(a[:i], b[:j]), (a[i:], b[j:])]
        parts = halves
        bound = sum(abs(len(a) - len(b)) for a, b in parts)
    return bound > most


@dataclass
class Joined:
    """What the join found.

    ``members``: (doc_id, n_shingles, class, component_id) of every row, and
    n_links unless groups alone were asked for. ``links``: all pairs (a, b) of
    similar classes; for groups alone, as many as hold the groups together.
    """

    members: DataFrame
    links: DataFrame


def jaccard_join(docs: DataFrame, n: int = 5, percent: int = 80, groups_only: bool = False, block: int = BLOCK) -> Joined:
    """Links and groups of documents whose sets of word n-grams have a Jaccard similarity of ``percent`` / 100 or more.

    ``docs`` has doc_id (integer) and text; other columns are not read. ASCII
    letters are lowered, words end at ASCII white space. A null text, or one
    without words, has an empty set and links with nothing, not even with
    another empty one: its class is null and its component itself. Rows with
    the same doc_id are the same document; if their texts differ, all of them
    count for it. ``n_links`` counts the other documents that a document is
    linked to, copies included, each once; rows with a null doc_id are a
    document each. ``groups_only`` leaves out ``n_links`` and the links that
    groups don't need. An empty table gives empty results.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(texts.dtypes)["doc_id"]

    def sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        return (ngram_set(words, n) for words in words_by_row(batch.column("text"), fold=ASCII_LOWER))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint16)
        names = ["doc_id", "sig", "n", "bits", "part", "counts"]
        words = PARITY_BITS // 64
        word_lists = pa.list_(pa.int64())
        none = None
        for batch in batches:
            sigs, sizes, bits = [], [], [np.zeros(0, np.int64)]
            none = batch.column("doc_id").type
            for grams in sets(batch):
                at = counter_of(grams)
                counts[at] += counts[at] < np.iinfo(np.uint16).max
                sigs.append(signature(grams))
                sizes.append(len(grams))
                bits.append(parities(grams))
            k = len(sigs)
            ends = pa.array(np.arange(0, words * k + 1, words, dtype=np.int32))
            packed = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(bits), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sigs, pa.int64()), pa.array(sizes, pa.int32()), packed, pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
        if none is not None:
            step = COUNTERS // COUNTER_ROWS
            rows = [(i, counts[i * step : (i + 1) * step]) for i in range(COUNTER_ROWS)]
            rows = [(i, c) for i, c in rows if c.any()]
            k = len(rows)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, none), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, word_lists), pa.array([i for i, _ in rows], pa.int32()), pa.array([zlib.compress(c, 1) for _, c in rows], pa.binary())], names)

    # As many tasks as run at a time, twice: each writes its own counters, whose size does not depend on its share.
    few = texts.coalesce(2 * spark.sparkContext.defaultParallelism)
    signed = written(few.mapInArrow(frugal(sign), f"doc_id {kind}, sig bigint, n int, bits array<bigint>, part int, counts binary"), "signatures")
    members_of = signed.where("part IS NULL").select("doc_id", "sig", "n", "bits")
    members = members_of.select("doc_id", "sig", "n")

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS // COUNTER_ROWS, np.int64)
        for batch in batches:
            for raw in batch.column("counts").to_pylist():
                total += np.frombuffer(zlib.decompress(raw), "<u2")
        done = np.minimum(total, np.iinfo(np.uint16).max).astype("<u2")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(done, 1)], pa.binary())], ["part", "counts"])

    # One row per part of the counters: 32 MB in all before compression, whatever the input. They are sent on as they are:
    # the driver and every executor keep a copy on disk.
    summed = signed.where("part IS NOT NULL").select("part", "counts").groupBy("part").applyInArrow(add, "part int, counts binary").collect()
    counts = spark.sparkContext.broadcast(Counters([(r.part, bytes(r.counts)) for r in summed]))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value.table
        seen: set[int] = set()  # of this task: a copy has the prefix of the first
        for batch in batches:
            grams_out, sigs, sizes, places = [], [], [], []
            for grams in sets(batch):
                size = len(grams)
                if not size or (sig := signature(grams)) in seen:
                    continue
                if len(seen) < _SEEN:
                    seen.add(sig)
                first = rare_first(grams, table)[: size + percent * size // -100 + 1]
                grams_out.append(first)
                sigs.append(np.full(len(first), sig, np.int64))
                sizes.append(np.full(len(first), size, np.int32))
                places.append(np.arange(len(first), dtype=np.int32))
            if sigs:
                # What differs from row to row comes first and side by side, so that shuffled rows compress.
                columns = [np.concatenate(c) for c in (grams_out, places, sizes, sigs)]
                for at in range(0, len(columns[0]), 1 << 18):
                    part = [c[at : at + (1 << 18)] for c in columns]
                    yield pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), *map(pa.array, part[1:])], ["gram", "place", "n", "sig"])

    found = texts.select("text").mapInArrow(frugal(prefixes), "gram bigint, place int, n int, sig bigint").repartition("gram")
    # Rows of one n-gram are together now: copies from other tasks go, then n-grams that only one class has.
    found = found.groupBy("gram", "sig").agg(F.min("n").alias("n"), F.min("place").alias("place"))
    by_gram = Window.partitionBy("gram")
    leader = F.min(F.struct(F.xxhash64("sig").alias("h"), "sig", "n", "place")).over(by_gram)
    found = found.withColumn("lead", leader).withColumn("k", F.count("*").over(by_gram)).where("k > 1")
    found = written(found.select("gram", "sig", "n", "place", F.col("lead.sig").alias("l_sig"), F.col("lead.n").alias("l_n"), F.col("lead.place").alias("l_place")), "prefixes")

    need = lambda x, y: F.ceil((F.col(x) + F.col(y)) * percent / F.lit(100.0 + percent) - 1e-9)

    def promising(a_n: str, a_place: str, b_n: str, b_place: str):
        """Length filter, and positional filter: what both have before the common n-gram, itself, and what may follow.

        Some common n-gram is among the first of the smaller set that can be
        missing from a set of at least its size, which is a shorter prefix.
        """
        lengths = (F.col(a_n) * 100 >= F.col(b_n) * percent) & (F.col(b_n) * 100 >= F.col(a_n) * percent)
        most = F.least(a_place, b_place) + 1 + F.least(F.col(a_n) - F.col(a_place) - 1, F.col(b_n) - F.col(b_place) - 1)
        small, place = F.least(a_n, b_n), F.when(F.col(a_n) < F.col(b_n), F.col(a_place)).when(F.col(b_n) < F.col(a_n), F.col(b_place)).otherwise(F.least(a_place, b_place))
        short = place <= small - F.ceil(small * (2 * percent) / F.lit(100.0 + percent) - 1e-9)
        return lengths & (most >= need(a_n, b_n)) & short

    # One row a class: its size, its parities and the first document that has its set.
    classes = written(members_of.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("bits").alias("bits")), "classes")

    def close(a: str, b: str):
        """Parity filter: no more bits differ than elements of similar sets may."""
        differ = sum((F.bit_count(F.col(f"{a}_bits")[i].bitwiseXOR(F.col(f"{b}_bits")[i])) for i in range(PARITY_BITS // 64)), F.lit(0))
        return differ <= F.col(f"{a}_n") + F.col(f"{b}_n") - 2 * need(f"{a}_n", f"{b}_n")

    def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(signature(grams), grams) for grams in sets(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.int64()), id_rows([g for _, g in rows], "<u8")], ["sig", "grams"])

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that are similar: parity filter, then suffix filter on the sets, then the overlap itself."""
        left, right = (classes.select(F.col("sig").alias(k), *(F.col(c).alias(f"{k}_{c}") for c in ("n", "bits", "doc"))) for k in "ab")
        near = pairs.join(left, "a").join(right, "b").where(close("a", "b"))
        near = written(near.select("a", "b", "a_doc", "b_doc"), "near-pairs")
        # Only the documents of these pairs are read again. Spark broadcasts their ids while the files are small.
        wanted = written(near.select(F.col("a_doc").alias("doc_id")).union(near.select("b_doc")).distinct().sort("doc_id"), "near-documents")
        found_sets = texts.join(wanted, "doc_id", "left_semi").select("text").mapInArrow(frugal(set_rows), "sig bigint, grams binary")
        found_sets = written(found_sets, "near-sets")
        # Both sides are the same shuffled sets, which Spark sends once.
        left, right = (found_sets.select(F.col("sig").alias(k), F.col("grams").alias(f"{k}_grams")) for k in "ab")

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = []
                for x, y in zip(batch.column("a_grams").to_pylist(), batch.column("b_grams").to_pylist()):
                    x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                    least = least_overlap(percent, len(x), len(y))
                    if suffix_apart(x, y, len(x) + len(y) - 2 * least):
                        good.append(False)
                        continue
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    good.append(int((y[at] == x).sum()) >= least)
                keep = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

        return near.select("a", "b").join(left, "a").join(right, "b").mapInArrow(frugal(verify), "a bigint, b bigint").distinct()

    def pair(x: str, y: str) -> list:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    def placed_in(root: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
        """``rows`` with the component of each class column."""
        for c in columns:
            rows = rows.join(root.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")), c, "left")
            rows = rows.withColumn(f"{c}_root", F.coalesce(f"{c}_root", c))
        return rows

    def hung(root: DataFrame) -> DataFrame:
        return root.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))

    def all_links() -> DataFrame:
        """Every similar pair of classes. A pair comes out at its first common n-gram: where both have the same one before, it came out there or is dissimilar."""
        rows = found.select("gram", "sig", "n", "place", F.lag("gram").over(Window.partitionBy("sig").orderBy("place")).alias("before"))
        rows = rows.withColumn("m", F.ceil(F.count("*").over(by_gram) / block).cast("int")).join(classes.select("sig", "bits"), "sig")
        rows = written(rows.withColumn("part", F.pmod(F.xxhash64("sig"), "m").cast("int")), "prefixes-in-blocks")
        # Every block of an n-gram meets every other one and itself, each pair of blocks on its own.
        met = F.explode(F.sequence(F.lit(0), F.col("m") - 1))
        left, right = (
            rows.withColumn("other", met).select("gram", F.col(i).alias("i"), F.col(j).alias("j"), *(F.col(c).alias(f"{k}_{c}") for c in ("sig", "n", "place", "before", "bits")))
            for k, i, j in (("x", "part", "other"), ("y", "other", "part"))
        )
        new = ~F.col("x_before").eqNullSafe(F.col("y_before")) | F.col("x_before").isNull()
        keys = [left[c] == right[c] for c in ("gram", "i", "j")]
        near = left.join(right, [*keys, (F.col("x_sig") < F.col("y_sig")) & new & promising("x_n", "x_place", "y_n", "y_place") & close("x", "y")])
        return written(verified(near.select(F.col("x_sig").alias("a"), F.col("y_sig").alias("b")).distinct()), "links")

    def group_links() -> tuple[DataFrame, DataFrame]:
        """Links between different components, as they are found: enough for the groups. And edges with the same components.

        Components that are known stand for the links they come from: each member hangs on the smallest one.
        """
        to_leader = found.where(F.col("sig") != F.col("l_sig")).where(promising("n", "place", "l_n", "l_place"))
        tried = written(to_leader.select(*pair("sig", "l_sig")).distinct(), "leader-pairs")
        links = written(verified(tried), "leader-links")

        # A second round where an n-gram still has several components: other leaders,
        # a different one for each eighth of the n-grams, so that a group whose members
        # are not all similar to one leader hangs together through several.
        root = components(links)
        rows = placed_in(root, found.select("gram", "sig", "n", "place"), "sig")
        rows = rows.withColumn("mixed", F.min("sig_root").over(by_gram) != F.max("sig_root").over(by_gram)).where("mixed")
        second = F.min(F.struct(F.xxhash64("sig", F.pmod("gram", F.lit(8))).alias("h"), "sig", "n", "place", "sig_root")).over(by_gram)
        rows = written(rows.withColumn("lead", second).select("gram", "sig", "n", "place", *(F.col(f"lead.{c}").alias(f"l_{c}") for c in ("sig", "n", "place", "sig_root")), "sig_root"), "mixed-prefixes")
        again = rows.where(F.col("sig_root") != F.col("l_sig_root")).where(promising("n", "place", "l_n", "l_place")).select(*pair("sig", "l_sig")).distinct()
        again = written(again.join(tried, ["a", "b"], "left_anti"), "second-pairs")
        second_links = written(verified(again), "second-links")
        links = links.union(second_links)
        tried = tried.union(again)

        # What is still apart: pairs of one n-gram whose components differ, at least one outside the leader's.
        # The parity filter works inside this join, so that only pairs that are close come out of it. Where both
        # have the same n-gram before this one, the pair comes out there, or some filter has proved it dissimilar.
        root = components(hung(root).union(second_links))
        placed = placed_in(root, rows.select("gram", "sig", "n", "place", "l_sig"), "sig", "l_sig")
        placed = placed.withColumn("out", F.col("sig_root") != F.col("l_sig_root")).withColumn("any_out", F.max("out").over(by_gram)).where("any_out").drop("any_out", "l_sig_root")
        placed = placed.withColumn("before", F.lag("gram").over(Window.partitionBy("sig").orderBy("place")))
        placed = written(placed.join(classes.select("sig", "bits"), "sig"), "apart-prefixes")
        outside, others = (side.select("gram", *(F.col(c).alias(f"{k}_{c}") for c in ("sig", "n", "place", "sig_root", "out", "before", "bits"))) for k, side in (("x", placed.where("out")), ("y", placed.where("sig != l_sig"))))
        new = ~F.col("x_before").eqNullSafe(F.col("y_before")) | F.col("x_before").isNull()
        apart = outside.join(
            others,
            (outside["gram"] == others["gram"])
            & (F.col("x_sig_root") != F.col("y_sig_root"))
            & (~F.col("y_out") | (F.col("x_sig") < F.col("y_sig")))
            & new
            & promising("x_n", "x_place", "y_n", "y_place")
            & close("x", "y"),
        )
        rest = apart.select(*pair("x_sig", "y_sig")).distinct().join(tried, ["a", "b"], "left_anti")
        other_links = written(verified(rest), "other-links")
        return links.union(other_links), hung(root).union(other_links)

    if groups_only:
        links, edges = group_links()
    else:
        links = edges = all_links()

    # From classes back to documents. A document with several texts joins their components.
    texts_of = members.where("n > 0").select(F.col("sig").alias("a"), F.min("sig").over(Window.partitionBy("doc_id")).alias("b"))
    node = texts_of.where("a != b")
    root = components(edges.union(node))
    placed = members.join(root.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.when(F.col("n") > 0, F.coalesce("root", "sig")))
    least = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    placed = placed.join(least, "root", "left")
    columns = ["doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.when(F.col("n") > 0, F.col("sig")).alias("class"), F.coalesce("least", "doc_id").alias("component_id")]
    if groups_only:
        return Joined(placed.select(columns), links)
    return Joined(_count_links(placed, links).select(*columns, F.coalesce("n_links", F.lit(0)).alias("n_links")), links)


def _count_links(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with n_links, the number of other documents in the class of a document or in linked ones.

    Documents with one class are counted as numbers by class; those with
    several, whose classes may have the same neighbours, one by one.
    """
    own = members.where("n > 0").select("doc_id", "sig")
    own = own.where("doc_id IS NOT NULL").distinct().union(own.where("doc_id IS NULL"))
    of_doc = Window.partitionBy("doc_id")
    own = own.withColumn("several", F.col("doc_id").isNotNull() & (F.min("sig").over(of_doc) != F.max("sig").over(of_doc)))
    own = written(own, "classes-of-documents")
    single = own.where("NOT several").groupBy(F.col("sig").alias("other")).agg(F.count("*").alias("copies"))
    several = own.where("several").select("doc_id", "sig")
    met_by = several.select(F.col("sig").alias("other"), F.col("doc_id").alias("met"))
    near = links.select(F.col("a").alias("sig"), F.col("b").alias("other")).union(links.select(F.col("b"), F.col("a")))
    near = near.union(own.select("sig", F.col("sig").alias("other")).distinct())

    counted = near.join(single, "other").groupBy("sig").agg(F.sum("copies").alias("singles"))
    others = near.join(met_by, "other").select("sig", "met").distinct().groupBy("sig").agg(F.count("*").alias("severals"))
    by_class = own.select("sig").distinct().join(counted, "sig", "left").join(others, "sig", "left")
    by_class = by_class.select("sig", (F.coalesce("singles", F.lit(0)) + F.coalesce("severals", F.lit(0)) - 1).alias("class_links"))

    reached = several.join(near, "sig").select("doc_id", "other").distinct()
    counted = reached.join(single, "other").groupBy("doc_id").agg(F.sum("copies").alias("singles"))
    others = reached.join(met_by, "other").select("doc_id", "met").distinct().groupBy("doc_id").agg((F.count("*") - 1).alias("severals"))
    by_doc = others.join(counted, "doc_id", "left").select("doc_id", (F.col("severals") + F.coalesce("singles", F.lit(0))).alias("doc_links"))
    return members.join(by_class, "sig", "left").join(by_doc, "doc_id", "left").withColumn("n_links", F.coalesce("doc_links", F.when(F.col("n") > 0, F.col("class_links"))))


def kept_documents(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, the one with the smallest doc_id; its columns unchanged.

    Documents without words stay. Of rows with the same doc_id the one with the
    smallest text, then the smallest other values stays; a null doc_id can't be
    told apart from another and all such rows stay.
    """
    joined = jaccard_join(docs, n, percent, groups_only=True).members
    keep = joined.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    # By value, so that a task that runs again chooses the same row.
    values = [F.col(f"`{f.name}`") for f in docs.schema if isinstance(f.dataType, AtomicType) and f.name not in ("doc_id", "text")]
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text", *values))
    known = docs.join(keep, "doc_id", "left_semi").withColumn("_kept_rank", first).where(F.col("_kept_rank") == 1).drop("_kept_rank")
    return known.unionByName(docs.where(F.col("doc_id").isNull())).select(docs.columns)
