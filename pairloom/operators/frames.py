"""Sequences: clips, border indices, running bests, block means, moving averages, tiles and schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.pairing import settled


def clips(frames: DataFrame, scene: str, order: list[str], item: str, size: int) -> DataFrame:
    """Every full window of size frames of a scene: scene, start (from 0), clip (array) and its centre."""
    w = Window.partitionBy(scene).orderBy(*order)
    out = frames.withColumn("clip", F.collect_list(item).over(w.rowsBetween(0, size - 1))).withColumn("start", (F.row_number().over(w) - 1).cast("long"))
    return out.where(F.size("clip") == size).select(scene, "start", "clip", F.element_at("clip", size // 2 + 1).alias("centre"))


def border_index(i: Column, last: Column, mode: str, centre: Column, half: int) -> Column:
    """
    Where an index outside 0..last goes: replicate (the nearest end), reflection, reflection_circle (the far side of the
    window) or circle (the far side, shifted).
    """
    if mode == "replicate":
        low, high = F.lit(0), last
    elif mode == "reflection":
        low, high = -i, 2 * last - i
    elif mode == "reflection_circle":
        low, high = centre + half - i, centre - half + (last - i)
    elif mode == "circle":
        low, high = i + (2 * half + 1), i - (2 * half + 1)
    else:
        raise ValueError(f"unknown border mode {mode}")
    return F.when(i < 0, low).when(i > last, high).otherwise(i)


def frame_indices(df: DataFrame, index: str, count: str, half: int, mode: str) -> DataFrame:
    """indices: the 2 * half + 1 frames around each index."""
    last = F.col(count) - 1
    if mode == "reflection_circle":
        low = lambda i: F.col(index) + half - i
        high = lambda i: F.col(index) - half + (last - i)
        at = lambda i: F.when(i < 0, low(i)).when(i > last, high(i)).otherwise(i)
    else:
        at = lambda i: border_index(i, last, mode, F.col(index), half)
    return df.withColumn("indices", F.transform(F.sequence(F.col(index) - half, F.col(index) + half), at))


def _cut(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """_part: ranges of (keys, order), so that a key of many rows is many tasks' work."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settled(rows.repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()))


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    on = a["_part"] == b["_part"]
    for k in keys:
        on &= a[k].eqNullSafe(b[k])
    return on


def best_so_far(rows: DataFrame, keys: list[str], value: str, order: str, higher: bool = True) -> DataFrame:
    """The best value up to each row and when it came; of equals the later one. Rows of one key and order share a result. Parts of a key meet only by their bests."""
    signed = F.col(value) if higher else -F.col(value)
    cut = _cut(rows.withColumn("_v", F.struct(signed.alias("v"), F.col(order).alias("at"))), keys, [order])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    found = cut.groupBy("_part", *keys).agg(F.max("_v").alias("_m")).withColumn("_m", F.max("_m").over(before))
    within = cut.withColumn("_w", F.max("_v").over(Window.partitionBy("_part", *keys).orderBy(order)))
    out = within.join(found, _same(within, found, keys), "left").select(within["*"], found["_m"])
    out = out.withColumn("_b", F.greatest("_w", "_m"))
    return out.withColumn("best", F.col("_b.v") if higher else -F.col("_b.v")).withColumn("best_at", F.col("_b.at")).drop("_b", "_v", "_w", "_m", "_part")


def best(rows: DataFrame, keys: list[str], value: str, order: str, higher: bool = True) -> DataFrame:
    """The final best of each key: an aggregate with partial sums, no sort."""
    signed = F.col(value) if higher else -F.col(value)
    out = rows.groupBy(*keys).agg(F.max(F.struct(signed.alias("v"), F.col(order).alias("at"))).alias("b"))
    return out.select(*keys, (F.col("b.v") if higher else -F.col("b.v")).alias("best"), F.col("b.at").alias("best_at"))


def block_means(rows: DataFrame, keys: list[str], cents: str, order: list[str], window: int) -> DataFrame:
    """Running mean that begins anew after window + 1 records. cents are whole numbers, so the mean is exact."""
    numbered = rows.withColumn("_block", F.floor((F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1) / (window + 1)))
    w = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return numbered.withColumn("running_mean", F.sum(cents).over(w).cast("double") / (100 * F.count("*").over(w))).drop("_block")


def ema(rows: DataFrame, keys: list[str], value: str, order: list[str], decay: float, threshold: float = 1.0) -> DataFrame:
    """
    Of each key the moving average after its last row, n, and whether the last row raised it beyond threshold times what
    it was. The average begins with the first value. As each value's weight follows from its place, it is a plain sum.
    """
    cut = _cut(rows.select(*keys, *[c for c in order if c not in keys], value), keys, order)
    sized = cut.groupBy("_part", *keys).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*keys)
    sized = sized.withColumn("n", F.sum("_n").over(whole)).withColumn("_later", F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(1, Window.unboundedFollowing)), F.lit(0)))
    within = cut.withColumn("_k", F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*[F.desc(c) for c in order])) - 1)
    at = within.join(sized, _same(within, sized, keys)).select(within["*"], sized["n"], sized["_later"]).withColumn("_age", F.col("_k") + F.col("_later"))
    share = F.pow(F.lit(decay), F.col("_age").cast("double")) * F.when(F.col("_age") == F.col("n") - 1, 1.0).otherwise(1 - decay)
    out = at.groupBy(*keys).agg(F.sum(F.col(value) * share).alias("ema"), F.max("n").cast("int").alias("n"), F.max(F.when(F.col("_age") == 0, F.col(value))).alias("_last"))
    old = (F.col("ema") - (1 - decay) * F.col("_last")) / decay
    return out.withColumn("rises", F.coalesce((F.col("n") > 1) & (F.col("ema") > old * threshold), F.lit(False))).drop("_last")


def tile_origins(length: Column, crop: int, step: int, threshold: int) -> Column:
    """0, step, ... while a tile fits, and the last full tile if what is uncovered exceeds the threshold."""
    fits = F.sequence(F.lit(0), F.greatest(length - crop, F.lit(0)), F.lit(step))
    rest = length - (F.element_at(fits, -1) + crop)
    return F.when(rest > threshold, F.concat(fits, F.array(length - crop))).otherwise(fits)


def tiles(images: DataFrame, key: str, crop: int, step: int, threshold: int) -> DataFrame:
    """Tiles in row-major order, numbered from 1."""
    y = images.withColumn("y", F.explode(tile_origins(F.col("h"), crop, step, threshold))).withColumn("x", F.explode(tile_origins(F.col("w"), crop, step, threshold)))
    return y.select(key, F.row_number().over(Window.partitionBy(key).orderBy("y", "x")).cast("long").alias("tile"), F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"))


def warmup_lr(iteration: Column, rate: float, warmup: int) -> Column:
    return F.when(iteration < warmup, rate / warmup * iteration).otherwise(F.lit(rate))


def knee_lr(iteration: Column, rate: float, explore: int, total: int) -> Column:
    """Flat until explore, then straight down to 0 at total."""
    fall = rate * (total - iteration) / (total - explore)
    return F.when(iteration <= explore, F.lit(rate)).otherwise(F.greatest(F.lit(0.0), fall))
