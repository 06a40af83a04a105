"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows lie in P source partitions.  How many rows of partition p go to shard s is drawn
first, as one exact multivariate hypergeometric matrix whose column sums are the shard
sizes.  Each partition then permutes its rows locally and deals them out by its row of
the matrix, the rows are exchanged, and each shard permutes what it received.  The
result is a uniform random permutation of all rows cut into shards whose counts differ
by one at most, and no step sees more than one partition's or sub-range's rows.
"""
from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargoline.llm.common import written


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def draw_hypergeometric(rng: random.Random, good: int, bad: int, n: int) -> int:
    """One hypergeometric draw by inversion, walking outwards from the mode."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    p = math.exp(_log_choose(good, mode) + _log_choose(bad, n - mode) - _log_choose(good + bad, n))
    u = rng.random() - p
    up = down = mode
    p_up = p_down = p
    while u > 0:
        if up < high:
            p_up *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - n + down) / ((good - down + 1) * (n - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
        if (up == high or p_up < 1e-300) and (down == low or p_down < 1e-300):
            return mode  # rounding left a remainder of the total mass
    return mode


def communication_matrix(row_counts: list[int], shard_sizes: list[int], seed: int) -> list[list[int]]:
    """Rows from each partition to each shard: a uniform table with these margins."""
    rng = random.Random(seed)
    left = list(shard_sizes)
    matrix = []
    for n in row_counts:
        pool, row = sum(left), []
        for s, size in enumerate(left):
            k = draw_hypergeometric(rng, size, pool - size, n)
            row.append(k)
            pool, n = pool - size, n - k
        left = [a - b for a, b in zip(left, row)]
        matrix.append(row)
    return matrix


def shard_rows(df: DataFrame, n_shards: int, seed: int = 17, rows_per_partition: int = 5000,
               max_partitions: int = 4096) -> DataFrame:
    """``df`` with ``shard`` (0 .. n_shards - 1) and ``slot`` (gapless from 0 in its shard).

    Shard counts differ by one at most (the first ``rows % n_shards`` shards hold one
    more).  The rows are written once with a row number, so every later step, and every
    retry, sees the same rows; repeated rows and NULLs are rows like any other, and an
    empty frame gives an empty result.  Columns of ``df`` named shard or slot are
    replaced.  The matrix has at most ``max_partitions`` x ``n_shards`` entries.
    """
    rows = written(df.select(F.struct("*").alias("row")).withColumn("rid", F.monotonically_increasing_id()), "shard")
    total = rows.count()
    n_parts = max(1, min(max_partitions, math.ceil(total / rows_per_partition)))
    part = F.pmod(F.xxhash64("rid"), F.lit(n_parts)).cast("int")
    counts = {r["part"]: r["n"] for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    sizes = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    parts = sorted(counts)
    matrix = communication_matrix([counts[p] for p in parts], sizes, seed)
    ends = []
    for p, row in zip(parts, matrix):
        acc, cut = 0, []
        for k in row:
            acc += k
            cut.append(acc)
        ends.append({"part": p, "ends": cut})
    deal = df.sparkSession.range(1).select(
        F.explode(F.from_json(F.lit(json.dumps(ends)), "array<struct<part:int,ends:array<bigint>>>")).alias("d")
    ).select("d.part", "d.ends")

    # local permutation, then the matrix row says where each rank goes
    local = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), "rid"), "rid")
    dealt = (
        rows.withColumn("part", part)
        .withColumn("rank", F.row_number().over(local) - 1)
        .join(F.broadcast(deal), "part")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("rank"))))
        .select("row", "rid", "shard")
    )
    # second permutation: ranges of a second key, so one shard is many sorts
    n_ranges = max(1, min(1 << 16, math.ceil(total / n_shards / rows_per_partition)))
    key = F.xxhash64(F.lit(seed + 1), "rid")
    dealt = dealt.withColumn("key", key).withColumn(
        "range", F.shiftright(F.shiftrightunsigned("key", 48) * F.lit(n_ranges), 16).cast("int"))
    before = (
        dealt.groupBy("shard", "range").agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("range")) - F.col("n"))
        .drop("n")
    )
    inside = Window.partitionBy("shard", "range").orderBy("key", "rid")
    out = dealt.withColumn("place", F.row_number().over(inside) - 1).join(before, ["shard", "range"])
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c not in ("shard", "slot")]
    return out.select(*kept, F.col("shard").cast("int").alias("shard"),
                      (F.col("before") + F.col("place")).cast("long").alias("slot"))
