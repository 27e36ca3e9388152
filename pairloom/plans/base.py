"""How queries are registered: a function of (spark, sf_dir), and its SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.sources.manifests import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as 8 x 8 images: p in about 0..1."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double") + 0.5).alias("p"))


def image_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each image and the one after it."""
    x = images(spark, sf_dir)
    return x.join(x.select((F.col("vec_id") - 1).alias("vec_id"), F.col("p").alias("q")), "vec_id")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value", F.bround(F.col("value") * 100).cast("long").alias("cents"))


IMG = "(select vec_id, label, list_transform(embedding, lambda x: x::double + 0.5) as p from embeddings)"
PAIR = f"(select a.vec_id, a.label, a.p, b.p as q from {IMG} a join {IMG} b on b.vec_id = a.vec_id + 1)"


def folded(values: str, zero: str, step: str) -> str:
    """DuckDB: a left fold over doubles."""
    return f"list_reduce(list_prepend({zero}::double, {values}), lambda s, x: {step})"


def summed(values: str) -> str:
    return folded(values, "0", "s + x")


def zipped(f: str) -> str:
    """DuckDB: f over z[1] and z[2] of p and q."""
    return f"list_transform(list_zip(p, q), lambda z: {f})"


#: Channels of all pixels of an image p, or of p beside q: p itself, p from its end, and p from its middle on.
PIXELS = """select vec_id, i, {a}[i + 1] as r, {a}[64 - i] as g, {a}[(i + 32) % 64 + 1] as b from (select *, unnest(range(0, 64)) as i from {source})"""


def over_pixels(pixels: str, body):
    """body(r, g, b) of every pixel of an array, in order: the same channels as PIXELS."""

    def cell(x, i):
        return F.struct(x.alias("r"), F.element_at(pixels, (64 - i).cast("int")).alias("g"), F.element_at(pixels, ((i + 32) % 64 + 1).cast("int")).alias("b"))

    return F.transform(F.transform(pixels, cell), lambda v: body(v["r"], v["g"], v["b"]))
