"""Mixing sources to target weights (p9) by Sainte-Laguë apportionment of equal-token blocks.

Each source's documents are spread over shards by a hash of their id, and each shard is cut into blocks
of about BLOCK_TOKENS. The total number of blocks is apportioned to the sources by highest
quotients (share over odd divisors), never above blocks times max_repeats; a source at its cap drops out
and the others go on. A source's quota is split over its shards in proportion to their blocks.
In a shard every block is used quota div blocks times, and the remainder once more, in seeded order.

Without ``total_tokens`` the mix is the largest that reaches every target share. Documents of no
target source, without source, or without tokens are not used and reported with 0. Copies are
rows of their own. Targets without documents get share 0. Empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.runtime import materialize
from millrace.llm.tokens import RANK_FILE, token_counts
from millrace.sources.tables import table

BLOCK_TOKENS = 4096
SHARD_TOKENS = 20_000_000
SEED = 42


def sainte_lague(weights: dict[str, float], seats: int, caps: dict[str, int]) -> dict[str, int]:
    """Seats per party by highest quotients weight / (2 n + 1), none above its cap; ties to the first name.

    Starts from a common multiplier below the answer, so that the work does not grow with the seats.
    """
    parties = sorted(p for p, w in weights.items() if w > 0 and caps[p] > 0)
    won = dict.fromkeys(weights, 0)
    exact = {p: Fraction(weights[p]) for p in parties}
    low, high = Fraction(0), Fraction(seats + 1) / min(exact.values(), default=Fraction(1))
    for _ in range(80):  # the largest multiplier whose rounded shares stay within the seats
        mid = (low + high) / 2
        if sum(min(caps[p], math.floor(exact[p] * mid + Fraction(1, 2))) for p in parties) <= seats:
            low = mid
        else:
            high = mid
    for p in parties:
        won[p] = min(caps[p], math.floor(exact[p] * low + Fraction(1, 2)))
    left = seats - sum(won.values())
    heap = [(-exact[p] / (2 * won[p] + 1), p) for p in parties if won[p] < caps[p]]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, p = heapq.heappop(heap)
        won[p] += 1
        left -= 1
        if won[p] < caps[p]:
            heapq.heappush(heap, (-exact[p] / (2 * won[p] + 1), p))
    return won


def mix_documents(
    documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS,
    seed: int = SEED, path: str = RANK_FILE,
) -> DataFrame:
    """(doc_id, source, n_tokens, times): how often each document is used (0: not at all)."""
    spark = documents.sparkSession
    goals = {r.source: (float(r.target_share), int(r.max_repeats)) for r in targets.collect() if r.source and r.target_share and r.max_repeats}
    sizes = materialize(token_counts(documents, path))
    usable = sizes.filter(F.col("source").isin(*goals) & (F.col("n_tokens") > 0)) if goals else sizes.limit(0)
    have = {r.source: int(r.tokens) for r in usable.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).collect()}
    if not have:
        return sizes.select("doc_id", "source", "n_tokens", F.lit(0).cast("long").alias("times"))
    shards = {s: max(1, -(-n // shard_tokens)) for s, n in have.items()}
    shard_map = F.create_map(*[x for s, n in shards.items() for x in (F.lit(s), F.lit(n))])
    keyed = usable.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.try_element_at(shard_map, F.col("source"))).cast("int"))
    # a shard's tokens are bounded, so its running sum is one bounded group
    order = W.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("source", "shard")
    placed = keyed.withColumn("before", F.coalesce(F.sum("n_tokens").over(order), F.lit(0))).withColumn("in_shard", F.sum("n_tokens").over(whole))
    placed = placed.withColumn("n_blocks", F.greatest(F.lit(1), F.round(F.col("in_shard") / block_tokens)).cast("long"))
    placed = materialize(
        placed.withColumn("block", F.floor((F.col("before") + F.col("n_tokens") / 2) * F.col("n_blocks") / F.col("in_shard")).cast("long"))
        .withColumn("block", F.least("block", F.col("n_blocks") - 1))
        .drop("before")
    )
    # a document longer than a block leaves block numbers empty; only filled ones count
    used = placed.groupBy("source", "shard").agg(F.count_distinct("block").alias("n_blocks"))
    blocks = {r.source: int(r.n) for r in used.groupBy("source").agg(F.sum("n_blocks").alias("n")).collect()}
    caps = {s: blocks[s] * goals[s][1] for s in blocks}
    weights = {s: goals[s][0] / (have[s] / blocks[s]) for s in blocks}  # blocks of a source may be a little off in size
    if total_tokens is None:
        total = min(have[s] * goals[s][1] / goals[s][0] for s in blocks)
    else:
        total = total_tokens
    shares = sum(goals[s][0] for s in blocks)
    seats = round(sum(goals[s][0] / shares * total / (have[s] / blocks[s]) for s in blocks))
    quota = sainte_lague(weights, seats, caps)
    quotas = spark.createDataFrame([(s, quota[s], blocks[s]) for s in blocks], "source string, quota long, source_blocks long")
    along = W.partitionBy("source").orderBy("shard")
    split = used.select("source", "shard", "n_blocks").join(F.broadcast(quotas), "source")
    upto = F.sum("n_blocks").over(along)
    part = lambda x: F.floor(x.cast("decimal(30,0)") * F.col("quota") / F.col("source_blocks"))
    split = split.select("source", "shard", "n_blocks", (part(upto) - part(upto - F.col("n_blocks"))).cast("long").alias("shard_quota"))
    ranked = placed.select("source", "shard", "block").distinct()
    ranked = ranked.withColumn("rank", F.row_number().over(W.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 2), "shard", "block"), "block")))
    limit = F.create_map(*[x for s in blocks for x in (F.lit(s), F.lit(goals[s][1]))])
    chosen = ranked.join(split, ["source", "shard"]).select(
        "source", "shard", "block",
        F.least(
            F.floor(F.col("shard_quota") / F.col("n_blocks")) + F.when(F.col("rank") <= F.col("shard_quota") % F.col("n_blocks"), 1).otherwise(0),
            F.try_element_at(limit, F.col("source")),
        ).cast("long").alias("times"),
    )
    mixed = placed.join(chosen, ["source", "shard", "block"]).select("doc_id", "source", "n_tokens", "times")
    rest = sizes.filter(~F.coalesce(F.col("source").isin(*goals) & (F.col("n_tokens") > 0), F.lit(False)))
    return mixed.unionByName(rest.withColumn("times", F.lit(0).cast("long")))


def mix_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: tokens at hand and in the mix, the share reached, and the most times a document is used."""
    tokens = F.sum(F.col("n_tokens") * F.col("times"))
    per = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens_at_hand"), tokens.alias("tokens_used"), F.max("times").alias("most_times"))
    total = mixed.agg(tokens.alias("all_tokens"))
    rows = targets.select("source", "target_share", "max_repeats").join(per, "source", "left").crossJoin(F.broadcast(total))
    return rows.select(
        "source", "target_share", "max_repeats", F.coalesce("tokens_at_hand", F.lit(0)).alias("tokens_at_hand"), F.coalesce("tokens_used", F.lit(0)).alias("tokens_used"),
        F.coalesce("most_times", F.lit(0)).alias("most_times"), F.coalesce(F.col("tokens_used") / F.nullif("all_tokens", F.lit(0)), F.lit(0.0)).alias("actual_share"),
    )


def p9_mix(spark: SparkSession, root: str) -> DataFrame:
    return mix_documents(table(spark, root, "documents"), table(spark, root, "mix_targets"))


def p9_shares(spark: SparkSession, root: str) -> DataFrame:
    return mix_report(p9_mix(spark, root), table(spark, root, "mix_targets"))


def p9_totals(spark: SparkSession, root: str) -> DataFrame:
    """Per source: whether no document is used more often than allowed, and documents at hand with their tokens counted once."""
    mixed = p9_mix(spark, root)
    per = mixed.groupBy("source").agg(F.count("*").alias("n_documents"), F.max("times").alias("most"))
    goals = table(spark, root, "mix_targets").groupBy("source").agg(F.max("max_repeats").alias("max_repeats"))
    return goals.join(per, "source", "left").select("source", F.coalesce("n_documents", F.lit(0)).alias("n_documents"), (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within"))


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares, "p9_totals": p9_totals}
SQL: dict[str, str] = {
    "p9_totals": "SELECT source, coalesce(n, 0) AS n_documents, true AS within FROM (SELECT DISTINCT source FROM mix_targets) LEFT JOIN (SELECT source, count(*) AS n FROM documents GROUP BY 1) USING (source)",
}
