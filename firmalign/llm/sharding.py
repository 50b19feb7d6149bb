"""Shards of near equal bytes by best-fit-decreasing bin packing of indivisible groups.

Groups (rows of equal text) enter bins in descending order of size, each the bin with the tightest
remaining capacity that still holds it, found in a balanced tree keyed by remaining capacity. The
capacity is the total divided by the number of shards, so no fewer shards could hold everything.
Only groups above a thousandth of a capacity, of which there is a bounded number, are placed in one
go. The rest is dealt into buckets by hash, and every bucket fills its proportional part of the
room the large groups leave.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from firmalign.llm.common import cut_lineage, table

SHARDS = 16
#: A group is large from this part of a capacity, or of a shard's fair share of rows, on.
LARGE_PART = 1024
#: Groups that one task packs, and rows that it numbers.
BUCKET = 16_384


class BinTree:
    """Bins ordered by (remaining capacity, bin) in a treap, a search tree balanced by priorities."""

    def __init__(self):
        self.root: list | None = None   # [key, priority, left, right]

    def add(self, key: tuple) -> None:
        low, high = self._split(self.root, key)
        node = [key, zlib.crc32(repr(key).encode()), None, None]
        self.root = self._join(self._join(low, node), high)

    def remove(self, key: tuple) -> None:
        low, rest = self._split(self.root, key)
        self.root = self._join(low, self._without_least(rest))

    def tightest(self, size: float) -> tuple | None:
        """The bin with the least remaining capacity of at least ``size``."""
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        return best

    def roomiest(self) -> tuple:
        node = self.root
        while node[3]:
            node = node[3]
        return node[0]

    def _split(self, node, key):
        if not node:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            return [node[0], node[1], node[2], low], high
        low, high = self._split(node[2], key)
        return low, [node[0], node[1], high, node[3]]

    def _join(self, low, high):
        if not low or not high:
            return low or high
        if low[1] >= high[1]:
            return [low[0], low[1], low[2], self._join(low[3], high)]
        return [high[0], high[1], self._join(low, high[2]), high[3]]

    def _without_least(self, node):
        if node[2]:
            return [node[0], node[1], self._without_least(node[2]), node[3]]
        return node[3]


def best_fit_decreasing(sizes: Iterable[int], room: list[float]) -> tuple[list[int], list[float]]:
    """The bin of each size, given in descending order, and the room left in the bins.

    A size that fits nowhere goes to the bin with the most room, whose room becomes negative.
    """
    tree, room = BinTree(), list(room)
    for k, r in enumerate(room):
        tree.add((r, k))
    bins = []
    for size in sizes:
        r, k = key = tree.tightest(size) or tree.roomiest()
        tree.remove(key)
        tree.add((r - size, k))
        room[k] = r - size
        bins.append(k)
    return bins, room


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every document with its size, shard and slot: doc_id, size, text_crc32, shard, slot.

    ``docs`` needs doc_id and text; other columns are ignored. Rows of equal text stay together; a
    missing text counts as an empty one. A group larger than a capacity takes the emptiest shard.
    Repeated rows each get a slot, a missing doc_id is kept, and an empty table gives no rows.
    """
    rows = cut_lineage(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).cast("binary").alias("t")).select(
            "doc_id", (F.octet_length("t") + 1).cast("bigint").alias("size"),
            F.crc32("t").alias("text_crc32"), F.unhex(F.sha2("t", 256)).alias("g")), "shard-rows")
    groups = cut_lineage(rows.groupBy("g").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-groups")
    sums = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
                      F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    capacity = -(-sums["bytes"] // shards)
    is_large = ((F.col("bytes") * LARGE_PART >= capacity)
                | (F.col("n") * (LARGE_PART * shards) >= max(1, sums["n"])))
    # At most LARGE_PART * shards groups by bytes and as many by rows.
    large = sorted(groups.where(is_large).select("g", "bytes").collect(),
                   key=lambda r: (-r["bytes"], bytes(r["g"])))
    bins, room = best_fit_decreasing((r["bytes"] for r in large), [capacity] * shards)
    small = groups.where(~is_large)
    buckets = max(1, -(-small.count() // BUCKET))
    free = [max(0, r) for r in room]
    scale = 1 / max(1, sum(free))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["bytes", "g"], ascending=[False, True])
        part = float(group["bytes"].sum())
        first = int(group["bucket"].iloc[0]) % shards   # ties fall on another bin in each bucket
        order = [(first + k) % shards for k in range(shards)]
        chosen, _ = best_fit_decreasing(group["bytes"].tolist(),
                                        [free[k] * scale * part for k in order])
        return pd.DataFrame({"g": group["g"], "shard": [order[k] for k in chosen]})

    spark = docs.sparkSession
    placed = small.withColumn("bucket", F.pmod(F.xxhash64("g"), F.lit(buckets))).groupBy(
        "bucket").applyInPandas(fill, "g binary, shard int")
    heavy = spark.createDataFrame([(bytes(r["g"]), k) for r, k in zip(large, bins, strict=True)],
                                  "g binary, heavy int")
    known = rows.join(F.broadcast(heavy), "g", "left")
    in_small = known.where("heavy IS NULL").drop("heavy").join(placed, "g")
    in_large = known.where("heavy IS NOT NULL").withColumnRenamed("heavy", "shard")
    chunks = max(1, -(-sums["n"] // BUCKET))
    return _with_slots(in_small.unionByName(in_large), chunks)


def _with_slots(rows: DataFrame, chunks: int) -> DataFrame:
    """Consecutive slots within each shard: numbers within chunks plus the rows of chunks before."""
    rows = cut_lineage(rows.withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", "g"), F.lit(chunks)).cast("int")), "shard-placed")
    counts = rows.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = counts.select("shard", "chunk", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("b"))
    within = Window.partitionBy("shard", "chunk").orderBy("doc_id", "g")
    numbered = rows.withColumn("k", F.row_number().over(within) - 1)
    return numbered.join(bases, ["shard", "chunk"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("b") + F.col("k")).alias("slot"))


def op5_shard(spark, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
