"""
Image files as rows and rows as image files. An image row has c, h, w and data (array of numbers, channel by channel, in 0..1).

Files are read and written by tasks through pyarrow's file systems, so a path may be local or remote; on a cluster it
must be one that all executors see. A file appears under its name only when it is whole, and a retried or speculative
task writes the same bytes again. Spark's own image source (``read_images``) reads JPEG, BMP and GIF files as well.
"""

from __future__ import annotations

import posixpath
import uuid
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import png
from pairloom.operators.frames import clips
from pairloom.sources.manifests import file_system, listing, write_store

PIXELS = "c int, h int, w int, data array<float>"
#: Bytes made by a task before it hands them on.
GROUP_BYTES = 16 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/.scratch"
    return f"{base.rstrip('/')}/pairloom-{uuid.uuid4().hex[:12]}-{name}"


def _kept(df: DataFrame, *dropped: str) -> list[str]:
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in dropped]


def _pixels(images: list, values: pa.DataType = pa.float32()) -> list[pa.Array]:
    """Columns c, h, w and data of (h, w, c) arrays in 0..1; None gives nulls."""
    sizes = [pa.array([None if x is None else x.shape[k] for x in images], pa.int32()) for k in (2, 0, 1)]
    data = [None if x is None else x.transpose(2, 0, 1).astype(values.to_pandas_dtype()).ravel() for x in images]
    return [*sizes, pa.array(data, pa.list_(values))]


def _groups(batch: pa.RecordBatch, made, size):
    """Consecutive rows of a batch, each with what was made of it, cut where that exceeds GROUP_BYTES; one is made at a time."""
    start, held, total = 0, [], 0
    for k, x in enumerate(made):
        held.append(x)
        total += size(x)
        if total > GROUP_BYTES or k + 1 == batch.num_rows:
            yield batch.slice(start, k + 1 - start), held
            start, held, total = k + 1, [], 0


def _decoded(content: bytes | None, flag: str, strict: bool) -> np.ndarray | None:
    try:
        if content is None:
            raise ValueError("no file")
        x = png.as_flag(png.decode(content), flag)
    except ValueError:
        if strict:
            raise
        return None
    return x / np.float32(np.iinfo(x.dtype).max)


def decode(rows: DataFrame, content: str = "content", flag: str = "color", strict: bool = True) -> DataFrame:
    """
    PNG bytes to image rows; the other columns stay. flag: color, grayscale or unchanged (``png.as_flag``). Bytes that are
    no whole PNG, and null, are an error, or with strict=False null pixels.
    """
    stay = [c for c in rows.columns if c != content]

    def run(batches):
        for batch in batches:
            images = (_decoded(v.as_py(), flag, strict) for v in batch.column(content))
            for rows, made in _groups(batch, images, lambda x: 0 if x is None else 4 * x.size):
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in stay), *_pixels(made)], names=[*stay, "c", "h", "w", "data"])

    return rows.select(*stay, content).mapInArrow(run, ", ".join([*_kept(rows, content), PIXELS]))


def _quantised(data: pa.ListScalar, c: int, h: int, w: int) -> np.ndarray:
    x = data.values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(c, h, w).transpose(1, 2, 0)
    return np.clip(np.rint(x * 255), 0, 255).astype(np.uint8)


def encode(images: DataFrame, level: int = 1) -> DataFrame:
    """Image rows to PNG of 8 bits: all columns but data stay (c, h and w too), beside content. A row without data has null content."""
    stay = [c for c in images.columns if c != "data"]

    def run(batches):
        for batch in batches:
            sizes = zip(batch.column("data"), *(batch.column(n).to_pylist() for n in ("c", "h", "w")), strict=True)
            coded = (png.encode(_quantised(*v), level) if v[0].is_valid else None for v in sizes)
            for rows, made in _groups(batch, coded, lambda x: len(x or b"")):
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in stay), pa.array(made, pa.binary())], names=[*stay, "content"])

    return images.select(*stay, "data").mapInArrow(run, ", ".join([*_kept(images, "data"), "content binary"]))


def _joined(base: str, name: str) -> str:
    if name.startswith("/") or ".." in name.split("/"):
        raise ValueError(f"{name} leaves its folder")
    return posixpath.join(base, name)


def _write(system: pafs.FileSystem, path: str, content: bytes) -> None:
    folder, name = posixpath.split(path)
    system.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(content)
    try:
        system.move(part, path)
    except OSError:
        # another attempt of the same task was first
        system.delete_file(part)
        if system.get_file_info(path).type != pafs.FileType.File:
            raise


def write_files(rows: DataFrame, path: str) -> None:
    """rows: name, content. One file a row, folders are made; an existing target folder is an error. Rows with null content write nothing."""
    system, base = file_system(path)
    if system.get_file_info(base).type != pafs.FileType.NotFound:
        raise FileExistsError(path)
    system.create_dir(base, recursive=True)

    def run(batches):
        system, base = file_system(path)
        for batch in batches:
            for name, content in zip(batch.column("name"), batch.column("content"), strict=True):
                if content.is_valid:
                    _write(system, _joined(base, name.as_py()), content.as_py())
            yield batch.select(["name"])

    rows.select("name", "content").mapInArrow(run, "name string").write.format("noop").mode("overwrite").save()


def write_images(images: DataFrame, path: str, level: int = 1) -> None:
    """images: name (a path under the folder, with .png) and an image row."""
    write_files(encode(images.select("name", "c", "h", "w", "data"), level), path)


def fetch(names: DataFrame, path: str, name: str = "name") -> DataFrame:
    """names with the bytes of each file (content); a missing file gives null. Nothing is listed: a task opens its rows' files."""

    def run(batches):
        system, base = file_system(path)
        for batch in batches:
            found = (_read(system, base, v.as_py()) for v in batch.column(name))
            for rows, made in _groups(batch, found, lambda x: len(x or b"")):
                yield rows.append_column("content", pa.array(made, pa.binary()))

    return names.mapInArrow(run, ", ".join([*_kept(names), "content binary"]))


def _read(system: pafs.FileSystem, base: str, name: str | None) -> bytes | None:
    if name is None:
        return None
    try:
        with system.open_input_stream(_joined(base, name), compression=None) as found:
            return found.read()
    except FileNotFoundError:
        return None


def lookup(backend: str, names: DataFrame, path: str) -> DataFrame:
    """The bytes (content) of each name: files of a folder (disk), or values of a key-value store (lmdb); what is missing is null."""
    if backend == "disk":
        return fetch(names, path)
    if backend == "lmdb":
        store = names.sparkSession.read.parquet(f"{path}/data")
        return names.join(store.select(F.col("key").alias("name"), F.col("value").alias("content")), "name", "left")
    raise ValueError(f"unknown backend {backend}")


def folder_paths(spark: SparkSession, path: str) -> DataFrame:
    """path of each file that lies in the folder itself."""
    return listing(spark, path, recursive=False).select(F.concat_ws("/", "root", "rel_path").alias("path"))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Sizes of all images below a folder, decoded in the JVM: path, h, w, c; what cannot be decoded is left out."""
    found = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path)
    return found.select(F.col("image.origin").alias("path"), F.col("image.height").alias("h"), F.col("image.width").alias("w"), F.col("image.nChannels").alias("c"))


def single_images(spark: SparkSession, path: str, flag: str = "color", mean: list[float] | None = None, std: list[float] | None = None) -> DataFrame:
    """name and image row of every PNG below a folder, normalised by channel if mean and std are given."""
    names = listing(spark, path, ".png").select(F.col("rel_path").alias("name"))
    # a flat folder is listed by one task, which need not open its files as well
    dealt = names.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name")
    out = decode(fetch(dealt, path), flag=flag)
    return out if mean is None else out.withColumn("data", normalised(mean, std))


def normalised(mean: list[float], std: list[float]):
    m, s = (F.array(*[F.lit(float(v)) for v in x]) for x in (mean, std))
    at = lambda i: (i / (F.col("h") * F.col("w"))).cast("int")
    return F.transform("data", lambda x, i: (x - F.get(m, at(i))) / F.get(s, at(i)))


def paired_images(pairs: DataFrame, lq_path: str, gt_path: str, scale: int) -> DataFrame:
    """
    pairs: name (of both files) and more columns, which stay. lq and gt as structs of c, h, w, data; the ground truth is
    trimmed to scale times its input, as validation does. A missing or damaged file is an error.
    """

    def side(rows, path, as_name):
        image = F.struct("c", "h", "w", "data").alias(as_name)
        return decode(fetch(rows, path)).select(*rows.columns, image)

    both = side(side(pairs, lq_path, "lq"), gt_path, "gt")
    h, w = (F.least(f"gt.{n}", F.col(f"lq.{n}") * scale).alias(n) for n in ("h", "w"))
    area = F.col("gt.h") * F.col("gt.w")
    inside = F.filter("gt.data", lambda x, i: ((i % area / F.col("gt.w")).cast("int") < F.col("lq.h") * scale) & (i % F.col("gt.w") < F.col("lq.w") * scale))
    return both.withColumn("gt", F.struct(F.col("gt.c").alias("c"), h, w, inside.alias("data")))


def video_clips(spark: SparkSession, path: str, size: int, flag: str = "color") -> DataFrame:
    """
    Clips of frames named ``scene_number.png``: scene (what is before the first _, whatever the folder), start, and the
    stacked frames (n, c, h, w, data). A frame is decoded once by a task that goes through the clips of its scene in order.
    """
    named = listing(spark, path, ".png").select(F.col("rel_path").alias("name"), F.substring_index(F.substring_index("rel_path", "/", -1), "_", 1).alias("scene"))
    made = clips(named, "scene", ["name"], "name", size).select("scene", "start", "clip")

    def run(batches):
        system, base = file_system(path)
        recent: OrderedDict[str, np.ndarray] = OrderedDict()
        for batch in batches:
            for row in batch.to_pylist():
                for name in row["clip"]:
                    if name not in recent:
                        recent[name] = _decoded(_read(system, base, name), flag, True)
                        while len(recent) > size:
                            recent.popitem(last=False)
                x = np.stack([recent[n].transpose(2, 0, 1) for n in row["clip"]])
                sizes = [pa.array([v], pa.int32()) for v in x.shape]
                yield pa.RecordBatch.from_arrays([pa.array([row["scene"]]), pa.array([row["start"]], pa.int64()), *sizes, pa.array([x.ravel()], pa.list_(pa.float32()))], names=["scene", "start", "n", "c", "h", "w", "data"])

    return made.mapInArrow(run, f"scene string, start bigint, n int, {PIXELS}")


def _origins(length: int, crop: int, step: int, threshold: int) -> list[int]:
    """0, step, ... while a tile fits, and the last full tile if what is uncovered exceeds the threshold."""
    out = list(range(0, max(length - crop, 0) + 1, step))
    return out + [length - crop] if length - out[-1] - crop > threshold else out


def sub_images(images: DataFrame, crop: int, step: int, threshold: int) -> DataFrame:
    """
    Tiles of named images, row by row, as image rows named ``stem_s001.ext``, their values as they are; x2, x3, x4 and x8
    vanish from the stem. One image is held at a time. An image smaller than a tile is one tile.
    """
    kind = images.schema["data"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            values = batch.schema.field("data").type.value_type
            for name, c, h, w, data in zip(*(batch.column(n) for n in ("name", "c", "h", "w", "data")), strict=True):
                c, h, w = c.as_py(), h.as_py(), w.as_py()
                x = data.values.to_numpy(zero_copy_only=False).reshape(c, h, w)
                stem, ext = posixpath.splitext(posixpath.basename(name.as_py()))
                for mark in ("x2", "x3", "x4", "x8"):
                    stem = stem.replace(mark, "")
                places = [(a, b) for a in _origins(h, crop, step, threshold) for b in _origins(w, crop, step, threshold)]
                per = max(1, GROUP_BYTES // (x.itemsize * c * crop * crop))
                for first in range(0, len(places), per):
                    part = places[first : first + per]
                    made = _pixels([x[:, a : a + crop, b : b + crop].transpose(1, 2, 0) for a, b in part], values)
                    names = [f"{stem}_s{n:03d}{ext}" for n in range(first + 1, first + 1 + len(part))]
                    yield pa.RecordBatch.from_arrays([pa.array(names), *made], names=["name", "c", "h", "w", "data"])

    return images.select("name", "c", "h", "w", "data").mapInArrow(run, f"name string, c int, h int, w int, data {kind}")


def image_store(images: DataFrame, path: str, level: int = 1) -> None:
    """images: key and image row, as a key-value store of PNG with its manifest."""
    coded = encode(images.select("key", "c", "h", "w", "data"), level)
    write_store(coded.withColumnRenamed("content", "value").withColumn("level", F.lit(level)), path)
