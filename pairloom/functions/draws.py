"""Random draws that depend on the row alone: never on partitions, retries or order."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def uniform(seed: int, stream: str, *keys) -> Column:
    """In 0..1, from a hash of seed, stream and the row's keys (53 bits)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(stream), *keys), 11) / float(1 << 53)


def normal(seed: int, stream: str, *keys) -> Column:
    """Standard normal, by Box and Muller."""
    u = F.greatest(uniform(seed, stream + "/radius", *keys), F.lit(2.0**-53))
    return F.sqrt(-2.0 * F.log(u)) * F.cos(2 * math.pi * uniform(seed, stream + "/angle", *keys))


def between(low: float, high: float, seed: int, stream: str, *keys) -> Column:
    return low + (high - low) * uniform(seed, stream, *keys)


def gate(p: float, seed: int, stream: str, *keys) -> Column:
    return uniform(seed, stream, *keys) < p


def choice(options: list[tuple[str, float]], draw: Column) -> Column:
    """The option whose share of the total weight holds the draw."""
    whole = sum(w for _, w in options)
    if whole <= 0:
        raise ValueError("weights must add up to more than 0")
    out, upto = None, 0.0
    for name, weight in options[:-1]:
        upto += weight / whole
        out = F.when(draw < upto, name) if out is None else out.when(draw < upto, name)
    return F.lit(options[-1][0]) if out is None else out.otherwise(options[-1][0])


def shuffled_shards(rows: DataFrame, key: str, epoch: int, ratio: int, ranks: int) -> DataFrame:
    """
    Each row ratio times, in an order that the epoch alone determines, dealt to ranks in turn. The order is found by a
    hash bucket, then within it, so that no task holds all rows.
    """
    many = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(ratio - 1)))).withColumn("_h", F.xxhash64(F.lit(epoch), F.col(key), F.col("copy")))
    parts = many.sparkSession.conf.get("spark.sql.shuffle.partitions")
    cut = many.withColumn("_b", F.pmod(F.shiftright("_h", 32), F.lit(int(parts))))
    starts = cut.groupBy("_b").agg(F.count("*").alias("_n")).withColumn("_s", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_b", "_s")
    at = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key, "copy")) - 1
    out = cut.withColumn("_k", at).join(F.broadcast(starts), "_b").withColumn("place", F.col("_k") + F.col("_s"))
    return out.withColumn("rank", F.pmod("place", F.lit(ranks)).cast("int")).drop("_h", "_b", "_k", "_s")


def shard_length(n: Column, ratio: int, ranks: int) -> Column:
    return F.ceil(n * ratio / ranks)
