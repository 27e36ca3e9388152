"""Shared helpers: reading tables, splitting Arrow batches, scratch tables and the held-out rule."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handled at once inside a Python worker, whatever the size of the Arrow batch.
ROWS = 1024
#: Text bytes handled at once inside a Python worker; a longer text is a piece of its own.
PIECE_BYTES = 4 << 20

#: For bytes.translate: A-Z in lower case, all else as it is.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares (spark.checkpoint.dir)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/.scratch"
    return f"{base.rstrip('/')}/pairloom-{uuid.uuid4().hex[:12]}-{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Removes a table that written() made and nothing needs any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/pairloom-" in path:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


#: What a worker keeps from task to task (a codec, a counter), by key.
_KEPT: dict[tuple, object] = {}


def kept(key: tuple, make):
    """An object that is costly to make, for all tasks of this worker until it works for another operator."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


#: glibc's M_TRIM_THRESHOLD and M_MMAP_THRESHOLD.
_MALLOPT = {-1: 16 << 20, -3: 2 << 20}
_lean = False


def lean() -> None:
    """Makes this worker give large freed blocks back to the system, instead of keeping them for its next stage."""
    global _lean
    if not _lean:
        pa.set_memory_pool(pa.system_memory_pool())
        for what, size in _MALLOPT.items():
            getattr(ctypes.CDLL(None), "mallopt", lambda *_: 0)(what, size)
        _lean = True
    getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)(0)


def pieces(batches: Iterable[pa.RecordBatch], by: str = "text", rows: int = ROWS, key: tuple | None = None) -> Iterator[pa.RecordBatch]:
    """
    Slices of the batches with few rows and few bytes of text. Workers go from stage to stage, so whatever another operator
    keeps in this one (under a key other than this) is let go first.
    """
    if others := [k for k in _KEPT if k != key]:
        for k in others:
            del _KEPT[k]
        gc.collect()
    lean()
    for batch in batches:
        at = 0
        sizes = pc.fill_null(pc.binary_length(batch.column(by)), 0).to_pylist()
        while at < batch.num_rows:
            end, total = at, 0
            while end < batch.num_rows and end - at < rows and (end == at or total + sizes[end] <= PIECE_BYTES):
                total += sizes[end]
                end += 1
            yield batch.slice(at, end - at)
            at = end


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; a null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def bundle(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def groups(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Of rows sorted by whole-number keys: the rows of each key."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            now = tuple(int(c[a]) for c in columns)
            if now != key and held:
                yield pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


class Recent:
    """What a worker remembers of distinct words: two generations, so that words that come again stay. Only speed depends on its size."""

    def __init__(self, size: int):
        self.size, self.now, self.before = size, {}, {}

    def missing(self, words: set) -> set:
        """Words whose values are to be put into now; the values of the others are there."""
        if len(self.now) > self.size:
            self.now, self.before = {}, self.now
        now, before = self.now, self.before
        absent = {w for w in words if w not in now}  # a difference of key views would go through all that is remembered
        back = {w: before[w] for w in absent if w in before}
        now.update(back)
        return absent.difference(back)
