"""Joins that keep hot keys spread over many tasks.

A key with more rows than a fair share of the shuffle partitions is split into salts, in
proportion to its share. Nothing is dropped: the other side repeats its rows for that key once per
salt. The sketch that looks for hot keys grows with the number of shuffle partitions, up to the
million items Spark's own sketch can track; below 62,500 partitions every key above a fair share
is found and split, beyond that the 62,500 most frequent ones. The salts add up to no more than
twice the number of partitions, however large the data is.

Hot keys are found by one sketch pass over the key column before the join is planned. They only
decide where rows go, never which rows match, so an estimate is good enough. A key counts as hot
from ``spark.firmalign.hotKeyMinRows`` rows on (100,000 unless set), below which a task has little
to gain. Rows without a key, which match nothing, are spread by a salt of their own in the same
join, so the large side is read once.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..sources.versions import cut_lineage

MIN_HOT_ROWS = "spark.firmalign.hotKeyMinRows"
#: Fixed value: the most items Spark's sketch tracks. It needs several for each key asked for.
_MOST_TRACKED, _TRACKED_PER_KEY = 1_000_000, 16


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str) -> dict:
    """Hot key -> number of salts. A bounded result: at most one entry per shuffle partition."""
    parts = _partitions(df)
    min_rows = int(df.sparkSession.conf.get(MIN_HOT_ROWS, "100000"))
    top = min(max(parts, 16), _MOST_TRACKED // _TRACKED_PER_KEY)
    row = df.select(F.col(key).alias("k")).where("k IS NOT NULL").agg(
        F.expr(f"approx_top_k(k, {top}, {max(16384, _TRACKED_PER_KEY * top)})").alias("top"),
        F.count(F.lit(1)).alias("n")).first()
    fair = max(row["n"] / parts, min_rows)
    return {t["item"]: -(-t["count"] * parts // row["n"]) for t in row["top"] if t["count"] > fair}


def store_counted(counts: DataFrame, key: str, name: str, *columns: str) -> tuple:
    """Write a table of exact counts per key; returns it and the hot keys by each count column.

    The largest and the total counts are observed while the table is written. Only if some key can be
    hot is it read for them, and fewer keys than partitions can lie above a fair share.
    """
    parts = _partitions(counts)
    min_rows = int(counts.sparkSession.conf.get(MIN_HOT_ROWS, "100000"))
    seen = Observation(name)
    stored = cut_lineage(counts.observe(seen, *[f(F.coalesce(F.col(c), F.lit(0))).alias(f"{c}_{f.__name__}")
                                                for c in columns for f in (F.max, F.sum)]), name)
    facts, found = seen.get, []
    for c in columns:
        fair = max((facts[f"{c}_sum"] or 0) / parts, min_rows)
        hot = []
        if (facts[f"{c}_max"] or 0) > fair:
            hot = stored.where(F.col(key).isNotNull() & (F.col(c) > fair)).select(key, c).collect()
        found.append({r[0]: -(-r[1] * parts // facts[f"{c}_sum"]) for r in hot})
    return stored, *found


def salts_of(hot: dict, key: Column) -> Column:
    """Number of salts of a key: 1 unless it is hot.

    Entries lie in a literal array of small maps, by a checksum of the key, so that looking one
    up takes the same time however many there are.
    """
    if not hot:
        return F.lit(1)
    cells: list[list] = [[] for _ in range(1 << max(0, (len(hot) - 1).bit_length()))]
    place = lambda k: zlib.crc32(str(k).encode()) % len(cells)
    for pair in hot.items():
        cells[place(pair[0])] += pair
    # An empty cell holds a key that belongs to another cell and so is never looked up in it.
    spare = next(iter(hot.items()))
    maps = [F.create_map(*[F.lit(x) for x in cell or spare]) for cell in cells]
    at = F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(len(cells))).cast("int")
    cell = maps[0] if len(maps) == 1 else F.get(F.array(*maps), at)
    return F.coalesce(F.try_element_at(cell, key), F.lit(1)).cast("int")


def one_salt(n: Column, by: str) -> Column:
    return F.pmod(F.xxhash64(by), n).cast("int")


def every_salt(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def lookup(left: DataFrame, right: DataFrame, key: str, by: str, how: str = "left",
           hot: dict | None = None, keyless: bool = True) -> DataFrame:
    """Join to a side holding at most one row per key, splitting the keys hot on the left.

    ``by`` is a column of the left side that tells rows of one key apart. Rows without a key
    match nothing; ``keyless=False`` states that there are none.
    """
    if keyless and how in ("inner", "left_semi"):
        left, keyless = left.where(F.col(key).isNotNull()), False
    if hot is None:
        hot = hot_keys(left, key)
    if not hot and not keyless:
        return left.join(right, key, how)
    n = salts_of(hot, F.col(key))
    salt = one_salt(n, by) if hot else F.lit(0)
    if keyless:
        salt = F.when(F.col(key).isNull(), one_salt(F.lit(_partitions(left)), by)).otherwise(salt)
    right = right.withColumn("_s", every_salt(n) if hot else F.lit(0))
    return left.withColumn("_s", salt).join(right, [key, "_s"], how).drop("_s")


def grid_join(left: DataFrame, right: DataFrame, key: str, left_by: str,
              right_by: str, hot: dict | None = None) -> DataFrame:
    """Many-to-many inner join: a key hot on either side is cut into a grid of tasks.

    ``hot`` are the hot keys where those of both sides are known to be among them.
    """
    left, right = left.where(F.col(key).isNotNull()), right.where(F.col(key).isNotNull())
    left_hot, right_hot = (hot, hot) if hot is not None else (hot_keys(left, key), hot_keys(right, key))
    on = [key]
    if left_hot:
        n = salts_of(left_hot, F.col(key))
        on.append("_l")
        left = left.withColumn("_l", one_salt(n, left_by))
        right = right.withColumn("_l", every_salt(n))
    if right_hot:
        n = salts_of(right_hot, F.col(key))
        on.append("_r")
        left = left.withColumn("_r", every_salt(n))
        right = right.withColumn("_r", one_salt(n, right_by))
    return left.join(right, on).drop("_l", "_r")
