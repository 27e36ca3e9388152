"""Image files: PNG against the JVM's own coder, damaged and missing files, folders, clips and tiles."""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pytest
from pairloom.functions import png
from pairloom.sources import image_files as files, manifests
from pyspark.sql import functions as F

RNG = np.random.default_rng(5)
# java.awt.image.BufferedImage: name -> type
KINDS = {"rgb": 1, "argb": 2, "gray": 10, "gray16": 11, "binary": 12, "indexed": 13}


def drawn(spark, folder, kind, fmt="png", progressive=False):
    """A 9 x 7 image written by the JVM: its path, and its colours as the JVM has them (h, w, argb)."""
    jvm = spark._jvm
    image = jvm.java.awt.image.BufferedImage(9, 7, KINDS[kind])
    for y in range(7):
        for x in range(9):
            image.setRGB(x, y, int(RNG.integers(-(2**31), 2**31)) | (0 if kind == "argb" else -(2**24)))
    path = os.path.join(folder, f"{kind}{'_i' if progressive else ''}.{fmt}")
    writer = jvm.javax.imageio.ImageIO.getImageWritersByFormatName(fmt).next()
    out = jvm.javax.imageio.ImageIO.createImageOutputStream(jvm.java.io.File(path))
    writer.setOutput(out)
    param = writer.getDefaultWriteParam()
    if progressive:
        param.setProgressiveMode(1)
    writer.write(None, jvm.javax.imageio.IIOImage(image, None, None), param)
    out.close()
    argb = np.array([[image.getRGB(x, y) & 0xFFFFFFFF for x in range(9)] for y in range(7)], np.uint32)
    return path, argb[:, :, None] >> np.array([16, 8, 0, 24], np.uint32) & 255


@pytest.mark.parametrize("kind", ["rgb", "argb", "binary", "indexed"])
@pytest.mark.parametrize("progressive", [False, True])
def test_files_of_the_jvm(spark, tmp_path, kind, progressive):
    path, colours = drawn(spark, str(tmp_path), kind, progressive=progressive)
    x = png.decode(open(path, "rb").read())
    got = png.as_flag(x, "color")
    assert (got == colours[:, :, :3]).all()
    if kind == "argb":
        assert (x[:, :, 3] == colours[:, :, 3]).all()


def test_gray_of_eight_and_sixteen_bits(spark, tmp_path):
    path, _ = drawn(spark, str(tmp_path), "gray")
    assert png.decode(open(path, "rb").read()).shape == (7, 9, 1)
    path, _ = drawn(spark, str(tmp_path), "gray16")
    x = png.decode(open(path, "rb").read())
    assert x.dtype == np.uint16 and (png.as_flag(x, "grayscale") == x >> 8).all() and (png.as_flag(x, "unchanged") == x).all()


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def test_each_filter_by_hand():
    # 3 x 5 grays: none, sub, up, average, Paeth
    raw = [[0, 10, 20, 30], [1, 5, 5, 5], [2, 1, 1, 1], [3, 100, 0, 0], [4, 1, 2, 3]]
    body = chunk(b"IHDR", struct.pack(">IIBBBBB", 3, 5, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(bytes(sum(raw, [])))) + chunk(b"IEND", b"")
    want = [[10, 20, 30], [5, 10, 15], [6, 11, 16], [103, 57, 36]]
    last = []
    for k, v in enumerate([1, 2, 3]):
        left, up, corner = (last[-1] if last else 0), want[3][k], (want[3][k - 1] if k else 0)
        p = left + up - corner
        last.append((v + min((left, up, corner), key=lambda g: abs(p - g))) % 256)
    assert png.decode(png.SIGNATURE + body)[:, :, 0].tolist() == [*want, last]


def test_round_trips():
    for shape in [(1, 1), (5, 7), (9, 4, 2), (3, 8, 3), (6, 6, 4)]:
        for kind in (np.uint8, np.uint16):
            x = RNG.integers(0, np.iinfo(kind).max + 1, shape).astype(kind)
            assert (png.decode(png.encode(x, 9)).reshape(shape) == x).all()
    with pytest.raises(ValueError):
        png.encode(np.zeros((2, 2, 5), np.uint8))
    with pytest.raises(ValueError):
        png.as_flag(np.zeros((2, 2, 3), np.uint8), "other")


def test_luma_by_hand():
    x = np.array([[[255, 0, 0], [0, 255, 0], [0, 0, 255], [255, 255, 255]]], np.uint8)
    assert png.as_flag(x, "grayscale").ravel().tolist() == [76, 150, 29, 255]


def test_damaged_bytes_and_null(spark):
    good = png.encode(RNG.integers(0, 256, (4, 4, 3)).astype(np.uint8))
    flipped = good[:45] + bytes([good[45] ^ 1]) + good[46:]
    rows = spark.createDataFrame([(k, None if b is None else bytearray(b)) for k, b in enumerate([good, good[:-5], flipped, b"", b"GIF89a", None])], "k int, content binary")
    got = {r.k: r.c for r in files.decode(rows, strict=False).collect()}
    assert got == {0: 3, 1: None, 2: None, 3: None, 4: None, 5: None}
    for k in range(1, 6):
        with pytest.raises(Exception, match="PNG|no file"):
            files.decode(rows.where(F.col("k") == k)).collect()
    assert files.decode(rows.limit(0)).collect() == []


def test_write_fetch_and_refuse(spark, tmp_path):
    rows = spark.createDataFrame([("a/b c.bin", bytearray(b"one")), ("d%20.bin", bytearray(b"")), ("gone.bin", None)], "name string, content binary")
    for root in (f"{tmp_path}/plain", f"file://{tmp_path}/uri"):
        files.write_files(rows, root)
        names = rows.select("name").union(spark.createDataFrame([("none",), (None,)], "name string"))
        assert {r.name: r.content and bytes(r.content) for r in files.lookup("disk", names, root).collect()} == {"a/b c.bin": b"one", "d%20.bin": b"", "gone.bin": None, "none": None, None: None}
        assert {(r.rel_path, r.size) for r in manifests.listing(spark, root).collect()} == {("a/b c.bin", 3), ("d%20.bin", 0)}
        with pytest.raises(FileExistsError):
            files.write_files(rows, root)
    with pytest.raises(Exception, match="leaves its folder"):
        files.write_files(spark.createDataFrame([("../x", bytearray(b"1"))], "name string, content binary"), f"{tmp_path}/out")
    assert not os.path.exists(f"{tmp_path}/x")
    with pytest.raises(ValueError):
        files.lookup("other", rows.select("name"), str(tmp_path))


def test_listing_goes_into_hidden_folders(spark, tmp_path):
    for name in ["a.png", ".b.png", "_c.png", ".h/d.png", "e/f/g.png", "e/.i.png", "j.txt"]:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"1")
    below = manifests.listing(spark, str(tmp_path), ".png")
    assert sorted(r.rel_path for r in below.collect()) == [".h/d.png", "_c.png", "a.png", "e/f/g.png"] and below.rdd.getNumPartitions() == 3
    assert sorted(r.path for r in files.folder_paths(spark, str(tmp_path)).collect()) == [f"{tmp_path}/{n}" for n in ("_c.png", "a.png", "j.txt")]
    (tmp_path / "empty").mkdir()
    assert manifests.listing(spark, str(tmp_path / "empty")).collect() == []


def test_jpeg_files_are_decoded_by_spark(spark, tmp_path):
    drawn(spark, str(tmp_path), "rgb", "jpg")
    drawn(spark, str(tmp_path), "gray", "png")
    (tmp_path / "bad.png").write_bytes(b"no image")
    assert sorted((r.path.rsplit("/", 1)[1], r.h, r.w, r.c) for r in files.read_images(spark, str(tmp_path)).collect()) == [("gray.png", 7, 9, 1), ("rgb.jpg", 7, 9, 3)]


def written(spark, folder, shapes):
    whole = {n: RNG.integers(0, 256, s).astype(np.uint8) for n, s in shapes.items()}
    rows = [(n, s.shape[2], s.shape[0], s.shape[1], (s.transpose(2, 0, 1).ravel() / 255).tolist()) for n, s in whole.items()]
    files.write_images(spark.createDataFrame(rows, "name string, c int, h int, w int, data array<double>"), folder)
    return whole


def test_clips_merge_equal_scenes_of_two_folders(spark, tmp_path):
    whole = written(spark, f"{tmp_path}/v", {f"{d}/{s}_{k}.png": (3, 2, 3) for d, s, n in (("a", "x", 2), ("b", "x", 2), ("b", "y", 2)) for k in range(n)})
    got = files.video_clips(spark, f"{tmp_path}/v", 3).collect()
    names = ["a/x_0.png", "a/x_1.png", "b/x_0.png", "b/x_1.png"]
    assert sorted((r.scene, r.start) for r in got) == [("x", 0), ("x", 1)]
    for r in got:
        want = np.stack([whole[n].transpose(2, 0, 1) for n in names[r.start : r.start + 3]])
        assert (np.rint(np.reshape(r.data, (r.n, r.c, r.h, r.w)) * 255) == want).all()


def test_pairs_are_trimmed_and_missing_files_fail(spark, tmp_path):
    lq = written(spark, f"{tmp_path}/lq", {"a.png": (2, 3, 3), "b.png": (4, 2, 1)})
    gt = written(spark, f"{tmp_path}/gt", {"a.png": (5, 6, 3), "b.png": (8, 7, 1)})
    pairs = spark.createDataFrame([("a.png",), ("b.png",)], "name string")
    for r in files.paired_images(pairs, f"{tmp_path}/lq", f"{tmp_path}/gt", 2).collect():
        h, w = lq[r.name].shape[:2]
        want = png.as_flag(gt[r.name][: 2 * h, : 2 * w], "color")
        assert (r.gt.h, r.gt.w) == want.shape[:2]
        assert (np.rint(np.reshape(r.gt.data, (r.gt.c, r.gt.h, r.gt.w)) * 255) == want.transpose(2, 0, 1)).all()
    with pytest.raises(Exception, match="no file"):
        files.paired_images(spark.createDataFrame([("c.png",)], "name string"), f"{tmp_path}/lq", f"{tmp_path}/gt", 2).collect()


def test_tiles_of_uneven_images(spark, tmp_path):
    whole = written(spark, f"{tmp_path}/t", {"px4.png": (10, 7, 3), "q.png": (3, 9, 1)})
    rows = files.single_images(spark, f"{tmp_path}/t", flag="unchanged")
    got = {r.name: np.rint(np.reshape(r.data, (r.c, r.h, r.w)) * 255) for r in files.sub_images(rows, 4, 4, 1).collect()}
    want = {f"p_s00{k}.png": whole["px4.png"][y : y + 4, x : x + 4] for k, (y, x) in enumerate([(y, x) for y in (0, 4, 6) for x in (0, 3)], 1)}
    want |= {"q_s001.png": whole["q.png"][:, :4], "q_s002.png": whole["q.png"][:, 4:8]}
    assert got.keys() == want.keys() and all((got[n] == want[n].transpose(2, 0, 1)).all() for n in want)


def test_tiles_keep_doubles(spark, tmp_path):
    """Values just below and above the half of a step, which floats cannot tell apart, are rounded as the image itself would be."""
    x = ((np.arange(192) + 0.5) / 255 * (1 + 1e-9 * np.where(np.arange(192) % 2, 1, -1))).reshape(3, 8, 8)
    rows = spark.createDataFrame([("p.png", 3, 8, 8, x.ravel().tolist())], "name string, c int, h int, w int, data array<double>")
    tiles = files.sub_images(rows, 4, 4, 0)
    assert dict(tiles.dtypes)["data"] == "array<double>" and dict(files.sub_images(rows.withColumn("data", F.col("data").cast("array<float>")), 4, 4, 0).dtypes)["data"] == "array<float>"
    files.write_images(tiles, f"{tmp_path}/t")
    got = {r.name: np.rint(np.reshape(r.data, (r.c, r.h, r.w)) * 255) for r in files.single_images(spark, f"{tmp_path}/t").collect()}
    assert got.keys() == {f"p_s00{k}.png" for k in range(1, 5)}
    for k, (a, b) in enumerate([(0, 0), (0, 4), (4, 0), (4, 4)], 1):
        assert (got[f"p_s00{k}.png"] == np.rint(x[:, a : a + 4, b : b + 4] * 255)).all()


def test_a_flat_folder_is_opened_by_many_tasks(spark, tmp_path):
    rows = spark.range(64).select(F.concat(F.col("id").cast("string"), F.lit(".png")).alias("name"), F.lit(1).alias("c"), F.lit(1).alias("h"), F.lit(1).alias("w"), F.array(F.col("id") / 255.0).alias("data"))
    files.write_images(rows, f"{tmp_path}/f")
    found = files.single_images(spark, f"{tmp_path}/f", flag="unchanged").select("name", F.round(F.col("data")[0] * 255).cast("int").alias("v"), F.spark_partition_id().alias("task")).collect()
    assert sorted((r.name, r.v) for r in found) == sorted((f"{k}.png", k) for k in range(64)) and len({r.task for r in found}) > 2


def test_store_keeps_sizes(spark, tmp_path):
    rows = spark.createDataFrame([("k", 1, 1, 2, [0.0, 1.0])], "key string, c int, h int, w int, data array<double>")
    files.image_store(rows, f"{tmp_path}/s", 6)
    assert [r.value for r in spark.read.text(f"{tmp_path}/s/meta_info").collect()] == ["k.png (1,2,1) 6"]
    found = files.lookup("lmdb", spark.createDataFrame([("k",), ("z",)], "name string"), f"{tmp_path}/s")
    assert {r.name: r.data for r in files.decode(found, flag="unchanged", strict=False).collect()} == {"k": [0.0, 1.0], "z": None}
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        files.image_store(rows, f"{tmp_path}/s")
