"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words.

Targets follow the weights, capped at a multiple of what a source has, the excess reshared. A source's
target is a number of blocks: seats, given by highest quotients target / (2 seats + 1), so the blocks
of all sources sum to the size of the mix. The same rule then gives each shard of a source an integer
quota. A shard lays its documents one after the other in a seeded order, as often as needed, and its
first ``quota`` blocks are taken; so a document is taken some whole number of times, and one document
of a shard possibly in part.

The driver holds a few sums. Sources and shards are tables; a source's shards are at most
``most_shards`` rows and one task apportions them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipeline.llm.common import WORD, numbered, stored, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)
QUOTAS = "source string, shard long, words long, quota long"


def words_in(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def targets(sources: DataFrame, total: int, most: float) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``: shares of ``total`` by weight, at most
    ``most`` times source_size, the excess reshared by weight until none is above."""
    cap = F.col("source_size") * F.lit(most)
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) >= cap
        row = sources.agg(
            F.sum(F.when(over, 1).otherwise(0)).alias("n"),
            F.sum(F.when(over, cap).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if row["n"] == capped or not row["weight"]:
            break
        capped, level = row["n"], (total - row["fixed"]) / row["weight"]
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)).cast("double"))


def seats(parties: DataFrame, votes: str, most: str, house: int, key: str) -> DataFrame:
    """``parties`` with ``seats`` that sum to ``house`` by highest quotients votes / (2 s + 1).

    With a divisor d, a party's seats are those whose quotient is at least d: floor(votes / d + 1/2).
    Each pass tries 64 divisors in one aggregate and keeps the interval in which the house is filled;
    the seats still missing there go to the highest quotients, ties to the smaller ``key``. ``most``
    bounds a party's seats; the house is at most the sum of these.
    """

    def taken(divisor: float) -> Column:
        return F.least(F.col(most), F.floor(F.col(votes) / F.lit(divisor) + F.lit(0.5)))

    total = parties.agg(F.sum(votes)).first()[0] or 0
    if house <= 0 or total <= 0:
        return parties.withColumn("seats", F.lit(0).cast("long"))
    low, high = 0.0, 2.0 * total + 1
    for _ in range(12):
        grid = np.geomspace(max(low, high * 1e-12), high, 66)[1:-1].tolist()
        row = parties.agg(*[F.sum(taken(d)).alias(f"d{i}") for i, d in enumerate(grid)]).first()
        enough = [i for i in range(len(grid)) if (row[i] or 0) >= house]
        if enough:
            low = grid[enough[-1]]
            high = grid[enough[-1] + 1] if enough[-1] + 1 < len(grid) else high
            if row[enough[-1]] == house:
                return parties.withColumn("seats", taken(low).cast("long"))
        else:
            high = grid[0]
        if high / max(low, 1e-300) < 1 + 1e-13:
            break
    base = taken(high)
    given = parties.withColumn("seats", base.cast("long"))
    short = house - (given.agg(F.sum("seats")).first()[0] or 0)
    next_seats = given.where(F.col("seats") < F.least(F.col(most), taken(low) if low else F.col(most)))
    spare = next_seats.select(
        F.col(key).alias("_key"),
        F.explode(F.sequence(F.col("seats"), F.least(F.col(most), taken(low) if low else F.col(most)) - 1)).alias("s"),
        F.col(votes).alias("v"),
    )
    # Between the two divisors there are only quotients that agree in 12 digits.
    extra = (
        spare.orderBy((F.col("v") / (2 * F.col("s") + 1)).desc(), "_key", "s")
        .limit(int(short))
        .groupBy("_key")
        .agg(F.count("*").alias("more"))
    )
    return (
        given.join(extra, given[key].eqNullSafe(extra["_key"]), "left")
        .withColumn("seats", F.col("seats") + F.coalesce("more", F.lit(0)))
        .drop("_key", "more")
    )


def apportion(votes: np.ndarray, most: np.ndarray, house: int) -> np.ndarray:
    """Sainte-Lague seats of a few thousand parties at most, ties to the first."""
    house = int(min(house, most.sum()))
    if house <= 0:
        return np.zeros(len(votes), np.int64)
    taken = lambda d: np.minimum(most, np.floor(votes / d + 0.5)).astype(np.int64)
    low, high = 1e-12, 2.0 * votes.sum() + 1
    while high / low > 1 + 1e-12:
        middle = np.sqrt(low * high)
        low, high = (middle, high) if taken(middle).sum() >= house else (low, middle)
    out, top = taken(high), taken(low)
    short = house - int(out.sum())
    rows = np.repeat(np.arange(len(votes)), top - out)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(top - out) - (top - out), top - out)
    quotient = votes[rows] / (2 * (out[rows] + nth) + 1)
    order = np.lexsort((rows, -quotient))[:short]
    np.add.at(out, rows[order], 1)
    return out


def _quotas(block: int, most: float):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("shard", kind="stable")
        words = part["words"].to_numpy().astype(float)
        cap = np.ceil(words * most / block).astype(np.int64)
        quota = apportion(words, cap, int(part["seats"].iloc[0]))
        return part[["source", "shard", "words"]].assign(quota=quota)

    return run


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = 3.0,
    block: int = 64,
    seed: int = 42,
    docs_per_shard: int = 128,
    most_shards: int = 4096,
) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every row.

    ``size`` is the number of words (0 for a null text), ``taken`` how many words of the row the mix
    takes, repeats counted: at most ``most`` times its size. Sources, null one of them, weigh
    ``weights`` in turn in order of code points. Ties are broken by source, shard, then the seeded
    order of rows; rows that agree in doc_id and text are alike, so reruns agree. An empty table gives no rows, sources
    without words get and give nothing. Other columns are not read.
    """
    sized = stored(
        docs.select("doc_id", "source", words_in().alias("size"), F.xxhash64("doc_id", F.lit(seed)).alias("draw")), "sizes"
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    order = [F.col("source").isNull(), F.col("source")]
    ranked = numbered(per_source, order, "rank")
    values = F.array(*[F.lit(float(w)) for w in weights])
    sources = stored(ranked.withColumn("weight", F.element_at(values, (F.col("rank") % len(weights) + 1).cast("int"))), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    aimed = stored(targets(sources, total, most).withColumn("most", F.ceil(F.col("source_size") * F.lit(most) / block)), "targets")
    possible = aimed.agg(F.sum("most")).first()[0] or 0
    given = stored(seats(aimed, "target", "most", min(possible, -(-total // block)), "source"), "seats")
    shards = F.least(F.lit(most_shards), F.ceil(F.col("rows") / docs_per_shard))
    named = given.select(
        F.col("source").alias("s"), "source_size", "target", "seats", F.greatest(shards, F.lit(1)).alias("shards")
    )
    # One row per source; Spark broadcasts it only below its size limit.
    rows = sized.join(named, sized["source"].eqNullSafe(named["s"])).withColumn("shard", F.pmod("draw", "shards"))
    sums = rows.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.first("seats").alias("seats"))
    quotas = stored(sums.groupBy("source").applyInPandas(_quotas(block, most), QUOTAS), "quotas")
    held = quotas.select(F.col("source").alias("qs"), F.col("shard").alias("qn"), "words", "quota")
    before = Window.partitionBy("source", "shard").orderBy("draw", "doc_id", "size")
    placed = rows.join(held, rows["source"].eqNullSafe(held["qs"]) & (rows["shard"] == held["qn"])).withColumn(
        "at", F.coalesce(F.sum("size").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    goal = F.least(F.col("quota") * block, F.floor(F.col("words") * F.lit(most)).cast("long"))
    rounds = F.when(F.col("words") > 0, F.floor(F.col("goal") / F.col("words"))).otherwise(0)
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("goal") - F.col("rounds") * F.col("words") - F.col("at")))
    return (
        placed.withColumn("goal", goal)
        .withColumn("rounds", rounds)
        .select(
            "doc_id", "source", "size", "source_size", "target",
            (F.col("rounds") * F.col("size") + part).cast("long").alias("taken"),
        )
    )
