"""Aggregates over metrics, losses, scenes and benchmark rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mean_by(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))


def weighted_mean(rows: DataFrame, keys: list[str], value: Column, weight: Column) -> DataFrame:
    return rows.groupBy(*keys).agg((F.sum(value * weight) / F.sum(weight)).alias("mean"))


def clip_count(frames: DataFrame, scene: str, size: int) -> DataFrame:
    return frames.groupBy(scene).count().agg(F.sum(F.greatest(F.lit(0), F.col("count") - size + 1)).alias("clips"), F.count("*").alias("scenes"))


def enlarge_ratio(n: Column, batch: int) -> Column:
    return F.greatest(F.floor(F.lit(2000 * batch) / n), F.lit(1))


def epochs(n: Column, ratio: Column, batch: int, accumulate: int, world: int, total: int) -> tuple[Column, Column]:
    per = F.floor(n * ratio / (batch * accumulate * world))
    return per, F.ceil(F.lit(total) / per)


def spread(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("low"), F.max(value).alias("high"))


def rescaled(rows: DataFrame, value: str, low: float, high: float, name: str) -> DataFrame:
    """value stretched from its range to low..high. The range is one row, joined back, so no window holds all rows."""
    ends = rows.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    return rows.crossJoin(F.broadcast(ends)).withColumn(name, low + (F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * (high - low)).drop("_lo", "_hi")


def noise_levels(pixels: Column) -> Column:
    """Distinct values, rounded up to a power of two."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(F.size(F.array_distinct(pixels)).cast("double"))))


def norm_of_norms(rows: DataFrame, keys: list[str], values: str) -> DataFrame:
    square = F.aggregate(values, F.lit(0.0), lambda s, x: s + x * x)
    return rows.groupBy(*keys).agg(F.sqrt(F.sum(square)).alias("norm"))


def speed_tier(fps: Column) -> Column:
    return F.when(fps > 24, "fast").when(fps >= 2, "medium").otherwise("slow")


def better_layout(base: Column, other: Column) -> Column:
    return F.when(base > other, "base").otherwise("channels_last")


def top(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n in a total order: each task keeps n rows, so nothing is sorted as a whole."""
    return rows.orderBy(*order).limit(n)


def latest(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def batches(rows: DataFrame, key: str, order: list[str], size: int) -> DataFrame:
    """Batch numbers within each key; the last partial batch is dropped."""
    k = F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1
    cut = rows.withColumn("batch", F.floor(k / size))
    full = F.count("*").over(Window.partitionBy(key, "batch"))
    return cut.withColumn("_n", full).where(F.col("_n") == size).drop("_n")
