"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from heapq import heapify, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfcast.llm.rows import text_key
from shelfcast.session import materialize

#: Words of a block, about; the blocks of a shard differ by a word at most.
BLOCK_WORDS = 64
#: Documents of a shard, about: its running sum is one task's work.
SHARD_ROWS = 2_000
#: The plan has a row per source on the driver; more sources than this are refused, not cut.
MOST_SOURCES = 1_000_000
#: Weights in the order of the sources, starting again after the last; the mix has SHARE of all words, a source at most
#: CEILING of its own.
WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
CEILING = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def apportion(votes: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Sainte-Lague: every seat goes to the highest quotient votes / (2 * seats held + 1); ties to the earlier one.

    Nobody gets more than `most`; seats that nobody can take are left over. The bulk is dealt at once by a common
    divisor that deals no seat too many, the rest one by one.
    """
    votes, most = np.asarray(votes, float), np.asarray(most, np.int64)
    seats = int(min(seats, most[votes > 0].sum()))

    def dealt(divisor: float) -> np.ndarray:
        return np.minimum(np.floor(votes / divisor + 0.5), most).astype(np.int64)

    if seats <= 0:
        return [0] * len(votes)
    low, high = votes.sum() / seats / 4, votes.max() * 4
    while dealt(low).sum() < seats:
        low /= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if dealt(middle).sum() > seats else (low, middle)
    held = dealt(high)
    queue = [(-votes[i] / (2 * held[i] + 1), i) for i in range(len(votes)) if held[i] < most[i] and votes[i] > 0]
    heapify(queue)
    for _ in range(seats - int(held.sum())):
        _, i = queue[0]
        held[i] += 1
        heapreplace(queue, (-votes[i] / (2 * held[i] + 1) if held[i] < most[i] else float("inf"), i))
    return held.tolist()


def targets(sizes: Sequence[int], weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, ceiling: int = CEILING) -> list[float]:
    """Words each source should give: `share` of all by weight, none above `ceiling` times its size, the excess
    shared again by weight among the others until none is above."""
    order = [Fraction(weights[i % len(weights)]) for i in range(len(sizes))]
    goal, full = [Fraction(0)] * len(sizes), set()
    while len(full) < len(sizes):
        left = share * sum(sizes) - sum(ceiling * sizes[i] for i in full)
        total = sum(w for i, w in enumerate(order) if i not in full)
        goal = [Fraction(ceiling * s) if i in full else left * order[i] / total for i, s in enumerate(sizes)]
        above = {i for i, s in enumerate(sizes) if i not in full and goal[i] > ceiling * s}
        if not above:
            break
        full |= above
    return [float(g) for g in goal]


def mix(
    documents: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0,
    weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, ceiling: int = CEILING,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row: the words of each document that the mix takes.

    Size is the number of runs between ASCII blanks, 0 for a null text. Sources are ordered by code point, a null source
    last and a source of its own; `targets` says what each should give. Each source's documents are dealt to shards and
    laid end to end there in a seeded order; every shard's line is cut into equal blocks. Sainte-Lague apportionment
    gives each source, and then each of its shards, a whole number of blocks; a shard's blocks are all taken as
    often as that allows and the rest evenly from a seeded offset. `taken` counts repeats, up to `ceiling` times the
    size. Reruns agree. Repeated rows and null ids are rows like any other; an empty table gives an empty mix.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col(doc).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc), text_key(F.col(text))).alias("place"),
    )
    rows = materialize(rows)
    sums = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    sums = sums.limit(MOST_SOURCES + 1).collect()
    if len(sums) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    sums.sort(key=lambda r: (r.source is None, r.source or ""))
    goal = targets([r.words for r in sums], weights, share, ceiling)
    plan = spark.createDataFrame(
        [(r.source, r.words, g, 1 + r.n // SHARD_ROWS) for r, g in zip(sums, goal)],
        "p_source string, source_size long, target double, shards long",
    )
    # One row per source, at most MOST_SOURCES; a hot source is not shuffled by its name.
    planned = rows.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("p_source"))).drop("p_source")
    sharded = planned.withColumn("shard", F.pmod("place", "shards"))

    lines = sharded.groupBy("source", "shard").agg(F.sum("size").alias("line"))
    lines = lines.withColumn("blocks", F.when(F.col("line") > 0, F.greatest(F.lit(1), F.round(F.col("line") / BLOCK_WORDS))).otherwise(0).cast("long"))
    lines = materialize(lines)
    held = {r.source: r.blocks for r in lines.groupBy("source").agg(F.sum("blocks").alias("blocks")).collect()}
    blocks = [held[r.source] for r in sums]
    wanted = [g * b / r.words if r.words else 0.0 for g, b, r in zip(goal, blocks, sums)]
    seats = apportion(wanted, round(sum(wanted)), [ceiling * b for b in blocks])
    of_source = spark.createDataFrame([(r.source, q) for r, q in zip(sums, seats)], "q_source string, seats long")

    def deal(shards: pd.DataFrame) -> pd.DataFrame:
        shards = shards.sort_values("shard")
        quota = apportion(shards["blocks"], int(shards["seats"].iloc[0]), ceiling * shards["blocks"])
        return shards.assign(quota=quota)[["source", "shard", "line", "blocks", "quota"]]

    quotas = (
        lines.join(F.broadcast(of_source), F.col("source").eqNullSafe(F.col("q_source")))
        .groupBy("source")
        .applyInPandas(deal, "source string, shard long, line long, blocks long, quota long")
    )
    quotas = materialize(quotas).select(F.col("source").alias("s"), F.col("shard").alias("h"), "line", "blocks", "quota")

    along = Window.partitionBy("source", "shard").orderBy("place", "doc_id", "size")
    stop = F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    laid = sharded.withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("size"))
    laid = laid.join(quotas, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")))
    offset = F.pmod(F.xxhash64(F.lit(seed), F.col("source"), F.col("shard")), F.expr("nullif(blocks, 0)"))
    laid = laid.withColumn("offset", offset).withColumn("line", F.expr("nullif(line, 0)"))
    return laid.select("doc_id", "source", "size", "source_size", "target", F.expr(_TAKEN).alias("taken"))


# Block k of a line has the words from k * line / blocks up to (k + 1) * line / blocks. Each is taken quota / blocks
# times, and once more where the running share of the remaining quota, from the offset on, passes a whole number.
_TAKEN = """
CASE WHEN size = 0 THEN 0L ELSE aggregate(
  transform(
    sequence(((start + 1) * blocks + line - 1) div line - 1, (stop * blocks + line - 1) div line - 1),
    k -> (least(stop, (k + 1) * line div blocks) - greatest(start, k * line div blocks)) * (
      quota div blocks
      + (pmod(k + offset, blocks) + 1) * (quota % blocks) div blocks
      - pmod(k + offset, blocks) * (quota % blocks) div blocks
    )
  ),
  0L, (total, words) -> total + words
) END
"""
