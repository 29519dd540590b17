"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words.

Each source has a weight and a target: its share of all words, at most `max_repeats` times its own words; what a source cannot
take is shared again by weight. The words to take are handed out in blocks. Sainte-Laguë gives block after block to the source
with the highest quotient target / (2 * blocks + 1); the result is that of rounding target / divisor for a common divisor, which is
found by counting, so neither blocks nor sources pass through one task. The blocks of a source are apportioned to its shards the
same way. A shard lays its documents out as one stream of words in seeded order and takes its quota from the stream, again from
its start when it ends. A document's share of the stream is what the mix takes of it, repeats counted.

Null text: no words. Null source: a source of its own, last in order. Sources without words have target zero. An empty table
gives an empty result. Repeated rows are documents of their own; a null id is an id like any other. Reruns agree, as all orders
come from hashes of ids and sizes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.rules import split_words
from plumbline.sources.tables import materialize, number_rows

BLOCK_WORDS = 16
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 11
# Documents of one shard, until a source has MAX_SHARDS shards; the shards of a source are apportioned in one task.
SHARD_ROWS = 1024
MAX_SHARDS = 8192
# Divisors that one pass over the sources tries.
PROBES = 32


def sizes(documents: DataFrame, *, id_col: str, source: str, text: str, carry: bool) -> DataFrame:
    count = F.size(split_words(F.coalesce(F.col(text), F.lit("")))).cast("bigint")
    row = [F.struct(*[F.col(c) for c in documents.columns]).alias("_row")] if carry else []
    return documents.select(F.col(id_col).alias("_id"), F.col(source).alias("_source"), count.alias("size"), *row)


def with_target(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add `target` to (weight, source_size).

    Each round shares what the full sources leave among the others by weight; sources that this fills stop there. The level
    (words per weight) only rises, so the rounds end when no more sources are full. Only sums go to the driver.
    """
    cap = F.col("source_size") * F.lit(max_repeats).cast("double")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, known = 0.0, -1
    while True:
        full = (cap == 0) | (F.col("weight") * F.lit(level) > cap)
        taken, weight, count = sources.agg(
            F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.count(F.when(full, 1)),
        ).first()
        if not weight or count == known:
            return sources.withColumn("target", F.when(full, cap).otherwise(F.col("weight") * F.lit(level)))
        level, known = (total - taken) / weight, count


def apportioned(parties: DataFrame, seats: int) -> DataFrame:
    """Add `blocks`: Sainte-Laguë's seats for the votes in `target`. Equal quotients go by `rank`.

    The divisor is searched by passes that count the seats for many divisors at once.
    """
    votes = F.col("target")
    count, total, most = parties.agg(F.count("*"), F.sum(votes), F.max(votes)).first()
    if seats <= 0 or not total:
        return parties.withColumn("blocks", F.lit(0).cast("bigint"))
    seats_at = lambda d: F.floor(votes / F.lit(float(d)) + 0.5)
    # Rounding moves the sum of the seats by half a seat per party at most.
    over = total / (seats + count / 2 + 1)
    fits = total / (seats - count / 2 - 1) if seats > count / 2 + 1 else 2 * most + 1
    while fits / over > 1 + 1e-13:
        tried = np.geomspace(over, fits, PROBES)[1:].tolist()
        counted = parties.agg(*[F.sum(seats_at(d)) for d in tried]).first()
        at = next((i for i, n in enumerate(counted) if n <= seats), len(tried) - 1)
        over, fits = (tried[at - 1] if at else over), tried[at]
        if counted[at] == seats:
            break
    placed = parties.withColumn("blocks", seats_at(fits).cast("bigint"))
    rest = seats - int(placed.agg(F.sum("blocks")).first()[0])
    if rest <= 0:
        return placed
    # What is left are quotients that tie at the divisor, one block each.
    ahead = placed.orderBy((votes / (2 * F.col("blocks") + 1)).desc(), "rank").limit(rest).select(F.col("rank").alias("_ahead"))
    met = placed.join(ahead, F.col("rank") == F.col("_ahead"), "left")
    return met.withColumn("blocks", F.col("blocks") + F.col("_ahead").isNotNull().cast("int")).drop("_ahead")


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats of each party; equal quotients go to the earlier one."""
    votes = votes.astype(np.float64)
    if seats <= 0 or not votes.sum():
        return np.zeros(len(votes), dtype=np.int64)
    over, fits = 0.0, 2 * votes.max() + 1
    while (middle := (fits + over) / 2) not in (fits, over):
        counted = np.floor(votes / middle + 0.5).sum()
        over, fits = (middle, fits) if counted > seats else (over, middle)
        if counted == seats:
            break
    given = np.floor(votes / fits + 0.5).astype(np.int64)
    for _ in range(seats - int(given.sum())):  # ties
        given[np.argmax(votes / (2 * given + 1))] += 1
    return given


def shard_quotas(shards: pd.DataFrame) -> pd.DataFrame:
    """Blocks of a source's shards (at most MAX_SHARDS rows), by their words."""
    shards = shards.sort_values("shard", kind="stable")
    blocks = sainte_lague(shards["words"].to_numpy(), int(shards["blocks"].iloc[0]))
    return pd.DataFrame({"rank": shards["rank"], "shard": shards["shard"], "words": shards["words"], "quota": blocks})


def laid_out(
    documents: DataFrame, *, id_col: str, source: str, text: str, weights: tuple[int, ...], block_words: int, max_repeats: int, seed: int,
    carry: bool,
) -> DataFrame:
    rows = materialize(sizes(documents, id_col=id_col, source=source, text=text, carry=carry), "sizes")
    counted = rows.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    ranked = number_rows(counted, [F.col("_source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    targets = with_target(ranked.withColumn("weight", weight), max_repeats)
    total = targets.agg(F.sum("target")).first()[0] or 0
    sources = materialize(apportioned(targets, round(total / block_words)), "sources")

    shards = F.least(F.ceil(F.col("n") / SHARD_ROWS), F.lit(MAX_SHARDS))
    known = sources.select(F.col("_source").alias("_of"), "rank", "source_size", "target", "blocks", shards.alias("_shards"))
    place = F.xxhash64(F.lit(seed), F.col("_id"), F.col("size"))
    placed = rows.join(known, F.col("_source").eqNullSafe(F.col("_of"))).withColumns({
        "_place": place, "shard": F.pmod(F.xxhash64(place, F.lit(seed)), F.col("_shards")).cast("int"),
    })
    words = placed.groupBy("rank", "shard", "blocks").agg(F.sum("size").alias("words"))
    quotas = words.groupBy("rank").applyInPandas(shard_quotas, "rank bigint, shard int, words bigint, quota bigint")
    # A shard gives a document at most max_repeats times, whatever its quota was rounded to.
    due = F.least(F.col("quota") * block_words, F.col("words") * max_repeats)
    due = materialize(quotas.select("rank", "shard", "words", due.alias("due")), "quotas")
    stream = Window.partitionBy("rank", "shard").orderBy("_place", "size", "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = placed.withColumn("_end", F.sum("size").over(stream)).join(due, ["rank", "shard"])
    passes = F.coalesce(F.expr("try_divide(due - due % greatest(words, 1), words)").cast("bigint"), F.lit(0))
    rest = F.col("due") - passes * F.col("words") - (F.col("_end") - F.col("size"))
    return laid.withColumns({"passes": passes, "part": F.greatest(F.least(rest, F.col("size")), F.lit(0))})


def mix(
    documents: DataFrame, *, id_col: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS,
    block_words: int = BLOCK_WORDS, max_repeats: int = MAX_REPEATS, seed: int = SEED,
) -> DataFrame:
    """One row per document: the id, size, source_size, target (of its source) and taken (words)."""
    laid = laid_out(
        documents, id_col=id_col, source=source, text=text, weights=weights, block_words=block_words, max_repeats=max_repeats, seed=seed,
        carry=False,
    )
    taken = F.col("passes") * F.col("size") + F.col("part")
    return laid.select(F.col("_id").alias(id_col), "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def mixed(
    documents: DataFrame, *, id_col: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS,
    block_words: int = BLOCK_WORDS, max_repeats: int = MAX_REPEATS, seed: int = SEED,
) -> DataFrame:
    """The rows of the mix with their own columns, each whole and as often as the mix takes its words, rounded.

    Only the last document that a shard's quota reaches is rounded. A document without words does not come.
    """
    laid = laid_out(
        documents, id_col=id_col, source=source, text=text, weights=weights, block_words=block_words, max_repeats=max_repeats, seed=seed,
        carry=True,
    )
    copies = F.when(F.col("size") > 0, F.col("passes") + (2 * F.col("part") >= F.col("size")).cast("int")).otherwise(0)
    often = laid.select("_row", copies.cast("int").alias("_copies")).filter("_copies > 0")
    return often.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
