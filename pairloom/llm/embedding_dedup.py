"""Embedding near-duplicates: random-hyperplane sign hashing in several tables, exact cosines, connected components.

Equal vectors are one class. A class goes to one bucket of each table, by the signs of its products with the table's
hyperplanes; classes of a bucket are compared exactly, in double precision, as matrix products. A pair is counted in the
first table in which it meets. A bucket of over BLOCK classes is cut into blocks, and each pair of blocks is a task's
work of its own, so that no bucket has a limit and none is held whole. Only sums of links and a spanning forest leave a
bucket, never its pairs.

The number of hyperplanes follows the number of classes (about FILL in a bucket); tables are added until a pair at the
threshold meets with probability RECALL, pairs above it more surely.

Only class numbers are dealt to buckets and blocks; each block then fetches its vectors, in the precision of the source
(products are in double precision), so that vectors are shuffled once a table and written once in all.

Vectors that are null, empty or zero, or hold null or non-finite numbers, link with nothing; so do vectors of different lengths. A
null vec_id is kept, with a null component unless an equal or linked vector has an id. Repeated rows are vectors of their own, each linked with its like.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from pairloom.llm.common import bundle, written
from pairloom.llm.components import Forest, components

THRESHOLD, RECALL, FILL, BLOCK = 0.9, 0.995, 64, 1024


def shape(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Hyperplanes and tables for n classes."""
    bits = min(30, max(4, math.ceil(math.log2(max(n, 1) / FILL)))) if n > FILL else 4
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _usable(kind: str):
    """vec_id, vector (as bytes; null: links with nothing)."""

    def run(batches):
        for batch in batches:
            keys = []
            for v in batch.column("embedding").to_pylist():
                x = None if v is None or None in v else np.array(v, kind)
                keys.append(None if x is None or not len(x) or not np.isfinite(x).all() or not x.any() else (x + x.dtype.type(0)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.binary())], names=["vec_id", "vector"])

    return run


def _unit(vectors: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype("<f8")
    x = x / np.abs(x).max(axis=1, keepdims=True)  # else squares of very large or small numbers leave the range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _small(bits: int) -> str:
    return "<u2" if bits <= 16 else "<u4"


def _hash(bits: int, tables: int, seed: int, kind: str):
    """Each class with its signs and its bucket in every table."""
    schema = pa.schema([("cid", pa.int64()), ("m", pa.int64()), ("signs", pa.binary()), ("vector", pa.binary()), ("buckets", pa.list_(pa.int64()))])

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            for size in sorted({len(v) for v in vectors}):
                at = [i for i, v in enumerate(vectors) if len(v) == size]
                x = _unit([vectors[i] for i in at], kind)
                d = x.shape[1]
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, d]).standard_normal((d, bits * tables))
                signs = (x @ planes[d] > 0).reshape(len(at), tables, bits) @ (1 << np.arange(bits))
                buckets = (signs * tables + np.arange(tables)) * 65536 + d % 65536
                packed = [s.tobytes() for s in signs.astype(_small(bits))]
                own = batch.take(pa.array(at))
                yield bundle(schema, own.column("cid"), own.column("m"), packed, own.column("vector"), buckets.tolist())

    return run


def _pairs(threshold: float, bits: int, kind: str):
    """Rows sorted by (bucket, i, j): links and a spanning forest of each such group."""
    schema = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def group(rows: dict):
        cid, m, side = np.array(rows["cid"]), np.array(rows["m"]), np.array(rows["side"])
        if len(cid) < 2 or len({len(v) for v in rows["vector"]}) > 1:
            return None
        x, signs, t = _unit(rows["vector"], kind), np.frombuffer(b"".join(rows["signs"]), _small(bits)).reshape(len(cid), -1), rows["t"][0]
        close = x @ x.T >= threshold
        a, b = np.nonzero(np.triu(close, 1))
        cross = side[a] != side[b] if rows["i"][0] != rows["j"][0] else np.ones(len(a), bool)
        a, b = a[cross], b[cross]
        if t and len(a):
            fresh = np.concatenate([~(signs[a[k : k + 50_000], :t] == signs[b[k : k + 50_000], :t]).any(axis=1) for k in range(0, len(a), 50_000)])
            a, b = a[fresh], b[fresh]
        if not len(a):
            return None
        links = np.zeros(len(cid), np.int64)
        np.add.at(links, a, m[b])
        np.add.at(links, b, m[a])
        forest = Forest()
        for p, q in zip(cid[a].tolist(), cid[b].tolist(), strict=True):
            forest.link(p, q)
        on = np.flatnonzero(links)
        return bundle(schema, cid[on], links[on], [forest.root(c) for c in cid[on].tolist()])

    def run(batches):
        names, key, rows = None, None, None
        for batch in batches:
            names = batch.schema.names
            columns = [c.to_pylist() for c in batch.columns]
            keys = list(zip(*(columns[names.index(k)] for k in ("bucket", "i", "j")), strict=True))
            at = 0
            while at < len(keys):
                end = at
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if keys[at] != key:
                    if rows and (out := group(rows)):
                        yield out
                    key, rows = keys[at], {n: [] for n in names}
                for n, c in zip(names, columns, strict=True):
                    rows[n] += c[at:end]
                at = end
        if rows and (out := group(rows)):
            yield out

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = 11) -> DataFrame:
    """vectors: vec_id (whole number), embedding (numbers). One row per vector: vec_id, n_links, component_id, kept."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    held = getattr(vectors.schema["embedding"].dataType, "elementType", None)
    number, numpy_kind = ("float", "<f4") if isinstance(held, FloatType) else ("double", "<f8")
    rows = vectors.select("vec_id", F.col("embedding").cast(f"array<{number}>").alias("embedding")).mapInArrow(_usable(numpy_kind), f"vec_id {kind}, vector binary")
    rows = written(rows.withColumn("key", F.sha2("vector", 256)).withColumn("vec_id", F.col("vec_id").cast("long")), "vectors")
    # a class without any id is known by a number below all ids
    classes = written(rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("least"), F.count("*").alias("m"), F.first("vector").alias("vector")).withColumn("cid", F.coalesce("least", F.lit(-(1 << 62)) - F.pmod(F.xxhash64("key"), F.lit(1 << 61)))), "classes")
    bits, tables = shape(classes.count(), threshold, recall)
    signed = classes.select("cid", "m", "vector").mapInArrow(_hash(bits, tables, seed, numpy_kind), "cid long, m long, signs binary, vector binary, buckets array<long>")
    signed = written(signed, "signed")
    hashed = signed.select("cid", F.posexplode("buckets").alias("t", "bucket"))
    sizes = hashed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = hashed.join(sizes, "bucket").withColumn("side", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other")).drop("other", "blocks")
    spread = spread.join(signed.drop("buckets"), "cid")
    sums = spread.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(_pairs(threshold, bits, numpy_kind), "cid long, links long, root long")
    sums = written(sums, "sums")
    links = sums.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(sums.select("cid", "root"))
    known = classes.select("key", "cid", "least", "m").join(links, "cid", "left").join(roots.select(F.col("a").alias("cid"), F.col("b").alias("root")), "cid", "left")
    known = known.select("key", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "cid").alias("root"))
    # a component whose number stands for a class without ids has the least id of its others
    named = known.join(classes.select("key", "least"), "key").groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(named, "root").select("key", "n_links", "component_id")
    out = rows.select("vec_id", "key").join(known, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(F.col("vec_id").cast(kind).alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
