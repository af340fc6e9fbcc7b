"""Mixing sources to target weights by temperature, without any Python on the rows.

Token shares are raised to an exponent and normalised. The exponent is bisected
until the mix reaches a target entropy, or as far as a limit on repetition
allows. Weights turn into a budget of tokens for each source. A source's
documents are dealt into blocks; in every epoch the blocks come in another
order, and the last epoch stops at the block that meets the budget.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

#: Blocks of a source; a power of two. Budgets are met to about one block.
BLOCKS = 1024
#: Halvings of the interval that one pass over the source table decides.
STEPS = 5
PASSES = 10


def words(text: Column) -> Column:
    """The token measure: runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _draw(*parts: Column) -> Column:
    """A number below 2^32 that depends on the parts alone."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 8), 16, 10).cast("bigint")


@dataclass
class Mix:
    """``exponent`` found; ``sources`` (source, tokens, weight, budget, whole, stop); ``rows`` of documents with their uses."""

    exponent: float
    sources: DataFrame
    rows: DataFrame


def find_exponent(sizes: DataFrame, entropy: float, repeats: float) -> float:
    """The exponent in [0, 1] for source sizes (source, tokens).

    The larger of two: the one whose mix has the share ``entropy`` of the
    largest possible entropy (0 if even equal weights don't need less), and the
    least one that repeats no source more than ``repeats`` times while the
    largest source is used once.
    """
    some = sizes.where("tokens > 0")
    total, most, least, n = some.agg(F.sum("tokens"), F.max("tokens"), F.min("tokens"), F.count("*")).first()
    if not n or n == 1:
        return 1.0
    target = entropy * math.log(n)

    def flat_enough(exponents: list[float]) -> list[bool]:
        columns = []
        for i, e in enumerate(exponents):
            power = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(e))
            columns += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log(power)).alias(f"s{i}")]
        r = some.agg(*columns).first()
        return [math.log(r[f"z{i}"]) - r[f"s{i}"] / r[f"z{i}"] >= target for i in range(len(exponents))]

    low, high = 0.0, 1.0  # the mix at low is flat enough; at high it need not be
    if flat_enough([1.0])[0]:
        low = 1.0
    else:
        for _ in range(PASSES):
            inner = [low + (high - low) * i / 2**STEPS for i in range(1, 2**STEPS)]
            good = flat_enough(inner)
            a, b = 0, 2**STEPS
            while b - a > 1:  # bisection over the points this pass has measured
                middle = (a + b) // 2
                a, b = (middle, b) if good[middle - 1] else (a, middle)
            points = [low, *inner, high]
            low, high = points[a], points[b]
    by_entropy = low
    low, high = 0.0, 1.0
    if (most / least) ** (1 - low) <= repeats:
        return max(by_entropy, low)
    for _ in range(STEPS * PASSES):
        middle = (low + high) / 2
        low, high = (low, middle) if (most / least) ** (1 - middle) <= repeats else (middle, high)
    return max(by_entropy, high)


def mix_sources(docs: DataFrame, entropy: float = 0.98, repeats: float = 2.0, seed: int = 0, blocks: int = BLOCKS, keep: list[str] | None = None) -> Mix:
    """Every use of every document in a mix of sources.

    ``docs`` has doc_id, source and text. ``Mix.rows`` holds the columns
    ``keep`` (doc_id and source by default) and tokens, epoch (from 0), block and
    place, the position of the block in its source's order; a kept column of one
    of these names stays in its stead. The budget is the
    smallest at which the largest weight per token is met by using each of its
    source's documents once: every document is used, and those of smaller sources
    up to ``repeats`` times, rounded to a block. Null is a source like any other;
    a source without tokens is used once. Rows of equal doc_id fall into the same
    block and are used alike; a null doc_id is a value like any other. An empty
    table gives an empty mix with exponent 1.
    """
    keep = keep or ["doc_id", "source"]
    if blocks & (blocks - 1):
        raise ValueError("blocks must be a power of two")
    salt = str(seed)
    block = (_draw(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) % blocks).cast("int")
    # Kept columns go by names of their own, so that none is taken for one of the plan's.
    kept = {c: f"_kept_{i}" for i, c in enumerate(keep)}
    every = docs.select(*[docs[c].alias(k) for c, k in kept.items()], "source", words(F.col("text")).alias("tokens"), block.alias("block"))
    # Counts by source and block: combined on the map side, and all that the plan needs.
    counts = docs.select("source", words(F.col("text")).alias("tokens"), block.alias("block"))
    counts = written(counts.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "block-tokens")
    sizes = written(counts.groupBy("source").agg(F.sum("tokens").alias("tokens")), "source-tokens")
    exponent = find_exponent(sizes, entropy, repeats)
    total, most = sizes.agg(F.sum("tokens"), F.max("tokens")).first()
    share = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(exponent))).otherwise(0.0)
    norm = sizes.agg(F.sum(share)).first()[0] or 1.0
    # How often a source is used, if the largest is used once.
    uses = F.when(F.col("tokens") > 0, F.pow(F.lit(float(most or 1)) / F.col("tokens"), F.lit(1 - exponent))).otherwise(1.0)
    uses = F.round(uses, 9)
    sources = sizes.select("source", "tokens", (share / norm).alias("weight"), F.floor(uses).cast("int").alias("whole"), F.round(F.col("tokens") * uses).cast("bigint").alias("budget"))

    # Place of a block in the order of an epoch: an odd multiple plus a shift, modulo the number of blocks.
    def place(source: Column, epoch: Column, of: Column) -> Column:
        name = F.coalesce(source, F.lit("null"))
        step = _draw(F.lit(salt), name, epoch.cast("string"), F.lit("step")) * 2 + 1
        shift = _draw(F.lit(salt), name, epoch.cast("string"), F.lit("shift"))
        return ((of * (step % blocks) + shift) % blocks).cast("int")

    # The last epoch takes blocks in their order while the tokens before them are below what is left of the budget.
    named = sources.withColumnsRenamed({"source": "of", "tokens": "of_tokens"})
    named = named.withColumn("left", F.col("budget") - F.col("whole") * F.col("of_tokens"))
    ordered = counts.join(named.select("of", "whole", "left"), F.col("source").eqNullSafe(F.col("of")))
    ordered = ordered.withColumn("place", place(F.col("source"), F.col("whole"), F.col("block")))
    before = F.coalesce(F.sum("tokens").over(Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    stops = ordered.withColumn("before", before).where("before < left").groupBy("source").agg((F.max("place") + 1).alias("stop"))
    stops = stops.withColumnRenamed("source", "at")
    plan = named.join(stops, F.col("of").eqNullSafe(F.col("at")), "left").select(F.col("of").alias("source"), F.col("of_tokens").alias("tokens"), "weight", "budget", "whole", F.coalesce("stop", F.lit(0)).alias("stop"))
    plan = written(plan, "mix-plan")

    # The plan has a row for each source: Spark broadcasts it while its files are small, and joins by a shuffle otherwise.
    short = plan.select(F.col("source").alias("of"), "whole", "stop")
    used = every.join(short, F.col("source").eqNullSafe(F.col("of")))
    last = F.when(place(F.col("source"), F.col("whole"), F.col("block")) < F.col("stop"), F.col("whole")).otherwise(F.col("whole") - 1)
    used = used.withColumn("epoch", F.explode(F.sequence(F.lit(0), last)))
    own = {"tokens": F.col("tokens"), "epoch": F.col("epoch"), "block": F.col("block"), "place": place(F.col("source"), F.col("epoch"), F.col("block"))}
    rows = used.select(*[F.col(k).alias(c) for c, k in kept.items()], *[c.alias(n) for n, c in own.items() if n not in kept])
    return Mix(exponent, plan, rows)
