"""Filling fixed-capacity containers with documents (p8) by sum-of-squares online packing.

Items come one by one. An array holds how many open containers stand at each fill level; an item goes
to the level (or a new container) for which the sum of the squared counts grows least, ties to the
fullest. An item above the capacity is cut into full containers and one remainder, no other is cut.

Documents are spread over shards of about SHARD_ITEMS by a hash of their id, whatever their source,
and each shard is packed on its own: only ids and sizes are shuffled. A shard leaves few containers open,
so the loss against one long run is small and does not grow with the data.

Null or empty texts take no room and appear in no container. Copies are items of their own. An empty
table gives an empty result. Capacities must be positive.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.runtime import materialize
from millrace.llm.tokens import RANK_FILE, token_counts
from millrace.sources.tables import table

SHARD_ITEMS = 20_000


class Packer:
    """Sum-of-squares packing into containers of one capacity."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)  # open containers by fill level; 0 and the capacity stay 0
        self.at: dict[int, list[int]] = {}
        self.made = 0

    def place(self, size: int) -> int:
        """The container of an item of 1 to ``capacity`` tokens."""
        c, n = self.capacity, self.count
        room = c - size
        here = np.flatnonzero(n[1 : room + 1]) + 1  # levels with an open container and room
        level = 0
        cost = 2 * n[size] + 1 if size < c else 0
        if len(here):
            after = here + size
            change = np.where(after < c, 2 * n[after] + 1, 0) - 2 * n[here] + 1
            best = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[best] <= cost:
                level = int(here[best])
        if level:
            n[level] -= 1
            box = self.at[level].pop()
        else:
            box = self.made
            self.made += 1
        if level + size < c:
            n[level + size] += 1
            self.at.setdefault(level + size, []).append(box)
        return box


def pack(sizes: list[int], capacity: int) -> list[tuple[int, int, int, int]]:
    """(item, piece, container, tokens) for items in the given order."""
    packer, out = Packer(capacity), []
    for i, size in enumerate(sizes):
        piece = 0
        while size > 0:
            part = min(size, capacity)
            out.append((i, piece, packer.place(part), part))
            size -= part
            piece += 1
    return out


def pack_documents(documents: DataFrame, containers: DataFrame, path: str = RANK_FILE, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """(container_kind, shard, container_no, doc_id, piece_no, n_tokens): every document once for each kind of container."""
    import pandas as pd

    sizes = materialize(token_counts(documents, path).filter("n_tokens > 0").select("doc_id", "n_tokens"))
    shards = max(1, -(-sizes.count() // shard_items))
    kinds = containers.select(F.col("container_kind").cast("string"), F.col("capacity_tokens").cast("int")).filter("capacity_tokens > 0").distinct()
    items = sizes.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    # kinds of containers are a short list given by the user; each shard of each kind is one bounded group
    keyed = items.crossJoin(F.broadcast(kinds))
    # a task for about each group; adaptive execution would put many small ones into one
    keyed = keyed.repartition(shards * max(1, kinds.count()), "container_kind", "shard")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "n_tokens"], kind="stable", ignore_index=True)
        order = np.random.default_rng(0).permutation(len(frame))  # ids may follow size or source
        frame = frame.iloc[order].reset_index(drop=True)
        rows = np.array(pack(frame["n_tokens"].tolist(), int(frame["capacity_tokens"].iloc[0])), np.int64).reshape(-1, 4)
        return pd.DataFrame(
            {
                "container_kind": frame["container_kind"].iloc[0],
                "shard": frame["shard"].iloc[0],
                "container_no": rows[:, 2],
                "doc_id": frame["doc_id"].to_numpy()[rows[:, 0]],
                "piece_no": rows[:, 1],
                "n_tokens": rows[:, 3],
            }
        )

    schema = "container_kind string, shard int, container_no long, doc_id long, piece_no long, n_tokens long"
    return keyed.groupBy("container_kind", "shard").applyInPandas(run, schema)


def fill_report(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """Per kind: containers used, tokens, and the share of room filled."""
    boxes = packed.groupBy("container_kind", "shard", "container_no").agg(F.sum("n_tokens").alias("n_tokens"))
    total = boxes.groupBy("container_kind").agg(F.count("*").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("fullest"))
    kinds = containers.select("container_kind", F.col("capacity_tokens").cast("long")).distinct()
    return total.join(F.broadcast(kinds), "container_kind").withColumn("fill_share", F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")))


def p8_packed(spark: SparkSession, root: str) -> DataFrame:
    return pack_documents(table(spark, root, "documents"), table(spark, root, "containers"))


def p8_fill_report(spark: SparkSession, root: str) -> DataFrame:
    return fill_report(p8_packed(spark, root), table(spark, root, "containers"))


def p8_totals(spark: SparkSession, root: str) -> DataFrame:
    """Per kind: documents packed, those packed twice or cut without need, and whether a container is above capacity."""
    packed = materialize(p8_packed(spark, root))
    kinds = table(spark, root, "containers").select("container_kind", F.col("capacity_tokens").cast("long")).distinct()
    docs = packed.groupBy("container_kind", "doc_id").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_pieces"), F.count_distinct("piece_no").alias("n_numbers"))
    docs = docs.join(F.broadcast(kinds), "container_kind").groupBy("container_kind").agg(
        F.count("*").alias("n_documents"), F.count_if(F.col("n_pieces") > F.col("n_numbers")).alias("n_twice"), F.count_if((F.col("n_pieces") > 1) & (F.col("n_tokens") <= F.col("capacity_tokens"))).alias("n_cut")
    )
    fill = fill_report(packed, kinds).select("container_kind", (F.col("fullest") > F.col("capacity_tokens")).alias("overfull"))
    return docs.join(fill, "container_kind")


QUERIES = {"p8_packed": p8_packed, "p8_fill_report": p8_fill_report, "p8_totals": p8_totals}
SQL: dict[str, str] = {
    "p8_totals": """SELECT container_kind, (SELECT count(*) FROM documents WHERE length(text) > 0) AS n_documents, 0::BIGINT AS n_twice, 0::BIGINT AS n_cut, false AS overfull
      FROM (SELECT DISTINCT container_kind FROM containers)""",
}
