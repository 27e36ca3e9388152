"""Augmentations that combine the rows of a batch. Partners, shares and boxes are columns, drawn from hashes of the batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions import draws
from pairloom.functions.arrays import let, nearest
from pairloom.operators.images import resampled, resize


def partners(rows: DataFrame, batch: str, ordinal: str, seed: int) -> DataFrame:
    """place of a row in its batch, by ordinal, and turn, its place in a random permutation of the batch, whatever rows the batch has."""
    own = Window.partitionBy(batch)
    drawn = F.xxhash64(F.lit(seed), F.col(ordinal))
    return rows.withColumn("place", F.row_number().over(own.orderBy(ordinal))).withColumn("turn", F.row_number().over(own.orderBy(drawn, ordinal)))


def joined(rows: DataFrame, batch: str, ordinal: str, pixels: str) -> DataFrame:
    """Each row of partners() with the ordinal (partner) and pixels (other) of the row that the permutation puts in its place; a row alone is its own partner."""
    key = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-1)).alias("of")
    other = rows.select(key(batch), F.col("turn").alias("place"), F.col(ordinal).alias("partner"), F.col(pixels).alias("other"))
    return rows.withColumn("of", key(batch)).join(other, ["of", "place"]).drop("of", "place", "turn")


def boxed(pixels: Column, other: Column, w: int, top: Column, left: Column, height: Column, width: Column) -> Column:
    """pixels, with a box taken from other."""

    def at(x, i):
        y, c = F.floor(i / w), i % w
        inside = (y >= top) & (y < top + height) & (c >= left) & (c < left + width)
        return F.when(inside, F.element_at(other, i + 1)).otherwise(x)

    return F.transform(pixels, at)


def cutblur(pixels: Column, h: int, w: int, factor: int, top: Column, left: Column, height: Column, width: Column) -> Column:
    """A box of the image at a lower resolution."""
    low = let(nearest(pixels, h, w, h // factor, w // factor), lambda small: nearest(small, h // factor, w // factor, h, w))
    return let(low, lambda x: boxed(pixels, x, w, top, left, height, width))


def box(h: int, w: int, share: float, seed: int, batch: Column) -> tuple[Column, Column, Column, Column]:
    """Top, left, height and width of a box with 1 - share of the area, the same for the whole batch."""
    ratio = (1 - share) ** 0.5
    height, width = max(1, int(h * ratio)), max(1, int(w * ratio))
    top, left = (F.floor(draws.uniform(seed, s, batch) * (n - m + 1)).cast("int") for s, n, m in (("top", h, height), ("left", w, width)))
    return top, left, F.lit(height), F.lit(width)


SAMPLINGS = ("bicubic", "bilinear", "nearest-exact")


def plan(kind: str, h: int, w: int, seed: int, batch: Column, scope: tuple[float, float] = (0.5, 0.9)) -> dict[str, Column]:
    """
    What a batch draws, in cells of the input: resizemix a box about a centre (cut at the borders), up a box within the
    image, downup a factor; and two ways of sampling, of which not both are the nearest.
    """
    u = lambda s: draws.uniform(seed, f"{kind}/{s}", batch)
    share = scope[0] + (scope[1] - scope[0]) * u("share")
    pick = lambda s, n: F.least(F.floor(u(s) * n), n - 1).cast("int")
    down, over = pick("down", F.lit(3)), pick("up", F.lit(3))
    both, side = (down == 2) & (over == 2), u("side") > 0.5
    out = {"factor": share, "down": F.when(both & ~side, pick("again", F.lit(2))).otherwise(down), "over": F.when(both & side, pick("again", F.lit(2))).otherwise(over)}
    if kind == "downup":
        return out
    for name, n in (("y", h), ("x", w)):
        half = F.floor(F.floor(n * share) / 2).cast("int")
        centre = pick(name, F.lit(n)) if kind == "resizemix" else half + pick(name, F.lit(n) - 2 * half)
        out |= {f"{name}0": F.greatest(centre - half, F.lit(0)), f"{name}1": F.least(centre + half, F.lit(n))}
    return out


def resizemix(x: np.ndarray, other: np.ndarray, box: tuple[int, int, int, int]) -> np.ndarray:
    """x with all of other, resized, in a box; an empty box changes nothing."""
    top, bottom, left, right = box
    out = x.copy()
    if bottom > top and right > left:
        out[:, top:bottom, left:right] = resize(other, bottom - top, right - left, "bicubic")
    return out


def downup(x: np.ndarray, factor: float, down: str, over: str) -> np.ndarray:
    h, w = (max(1, int(np.rint(n * factor))) for n in x.shape[1:])
    return resampled(resampled(x, h, w, down), *x.shape[1:], over)


def up(x: np.ndarray, box: tuple[int, int, int, int], over: str) -> np.ndarray:
    """A box of x at the size of x; an empty box changes nothing."""
    top, bottom, left, right = box
    return resampled(x[:, top:bottom, left:right], *x.shape[1:], over) if bottom > top and right > left else x


def augment(rows: DataFrame, key: str, kind: str, scale: int) -> DataFrame:
    """
    rows: key, c, h, w (of lq), lq, gt (scale times as large), the columns of plan(), and for resizemix lq_other and
    gt_other. Returns key, lq and gt. Sizes that do not fit raise.
    """
    names = [key, "c", "h", "w", "lq", "gt", "factor", "down", "over"] + ([] if kind == "downup" else ["y0", "y1", "x0", "x1"]) + (["lq_other", "gt_other"] if kind == "resizemix" else [])
    sql = rows.schema[key].dataType.simpleString()

    def one(r: dict) -> tuple[np.ndarray, np.ndarray]:
        lq, gt = np.array(r["lq"], np.float64), np.array(r["gt"], np.float64)
        lq, gt = lq.reshape(r["c"], r["h"], r["w"]), gt.reshape(r["c"], r["h"] * scale, r["w"] * scale)
        if kind == "downup":
            return downup(lq, r["factor"], SAMPLINGS[r["down"]], SAMPLINGS[r["over"]]), gt
        box = tuple(r[k] for k in ("y0", "y1", "x0", "x1"))
        wide = tuple(v * scale for v in box)
        if kind == "up":
            return up(lq, box, SAMPLINGS[r["over"]]), up(gt, wide, "bicubic")
        return resizemix(lq, np.array(r["lq_other"], np.float64).reshape(lq.shape), box), resizemix(gt, np.array(r["gt_other"], np.float64).reshape(gt.shape), wide)

    def run(batches):
        for batch in batches:
            made = [one(r) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), *(pa.array([m[k].ravel() for m in made], pa.list_(pa.float64())) for k in (0, 1))], names=[key, "lq", "gt"])

    return rows.select(*names).mapInArrow(run, f"`{key}` {sql}, lq array<double>, gt array<double>")
