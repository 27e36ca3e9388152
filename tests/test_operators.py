"""Closed forms, laws and round trips of the operators that SQL cannot check."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pairloom.functions import draws
from pairloom.operators import images, pairing, registry
from pairloom.sources import manifests
from pairloom.streaming import pool
from pyspark.sql import functions as F

RNG = np.random.default_rng(0)
PICTURE = RNG.random((3, 24, 20))


def test_kernels_sum_to_one():
    for k in (images.gauss2d(7, 1.3), images.sinc_kernel(1.7, 9), images.sinc_kernel(1.7, 9, 21), images.motion_kernel(9, 30)):
        assert k.sum() == pytest.approx(1)
    assert images.sinc_kernel(1.7, 9, 21).shape == (21, 21)
    with pytest.raises(ValueError):
        images.sinc_kernel(1.0, 8)


def test_bessel():
    assert images.j1(np.array([0.0, 1.0, 3.8317059702])) == pytest.approx([0, 0.4400505857, 0], abs=1e-9)


def test_identities():
    assert images.rotate(PICTURE, 0) == pytest.approx(PICTURE)
    three = PICTURE[:, :3, :3]  # the unit grid of three meets the cells' centres, or lies at the mirror
    assert images.lens(three, 0) == pytest.approx(three)
    assert images.rolling_shutter(three, 0) == pytest.approx(three)
    assert images.resize(PICTURE, 24, 20, "bicubic") == pytest.approx(PICTURE)
    assert images.oversharpen(PICTURE, 0) == pytest.approx(PICTURE)
    flat = np.full((3, 16, 16), 0.5)
    for name in ("jpeg", "blur", "chroma420", "demosaic", "unsharp"):
        assert images.STEPS[name](flat, {"size": 5}, RNG) == pytest.approx(flat, abs=0.005)


def test_degradations_lose_something_and_stay_in_range():
    for name, step in images.STEPS.items():
        out = step(PICTURE, {}, np.random.default_rng(1))
        assert out.min() >= -1e-9 and out.max() <= 1 + 1e-9, name
    assert images.psnr(images.jpeg(PICTURE, 90), PICTURE, 1) > images.psnr(images.jpeg(PICTURE, 10), PICTURE, 1)


def test_metrics():
    ones = np.ones((3, 16, 16))
    assert images.psnr(ones, ones) == math.inf and images.ssim(ones, ones) == pytest.approx(1)
    assert images.psnr(ones, ones * 2) == pytest.approx(10 * math.log10(255**2))
    with pytest.raises(ValueError):
        images.ssim(ones, np.ones((3, 10, 10)))
    with pytest.raises(AssertionError):
        images.psnr(ones, np.ones((3, 10, 10)))


def test_unknown_step_changes_nothing(spark):
    df = spark.createDataFrame([(1, 1, 2, 2, [0.1, 0.2, 0.3, 0.4], [("nothing", {"a": 1.0})]), (2, 1, 2, 2, [0.1, 0.2, 0.3, 0.4], None)], "k long, c int, h int, w int, data array<double>, steps array<struct<type string, params map<string,double>>>")
    assert [r.data for r in images.degrade(df, "k").orderBy("k").collect()] == [pytest.approx([0.1, 0.2, 0.3, 0.4])] * 2


def test_draws_follow_their_laws(spark):
    df = spark.range(20_000).select(draws.uniform(1, "a", "id").alias("u"), draws.normal(1, "b", "id").alias("z"), draws.choice([("x", 1), ("y", 3)], draws.uniform(2, "c", "id")).alias("k"))
    r = df.agg(F.avg("u").alias("u"), F.avg("z").alias("m"), F.stddev("z").alias("s"), F.avg((F.col("k") == "y").cast("int")).alias("y"), F.min("u").alias("lo"), F.max("u").alias("hi")).first()
    assert abs(r.u - 0.5) < 0.01 and abs(r.m) < 0.03 and abs(r.s - 1) < 0.03 and abs(r.y - 0.75) < 0.02 and 0 <= r.lo and r.hi < 1
    with pytest.raises(ValueError):
        draws.choice([("x", 0)], F.lit(0.5))


def test_shards_hold_each_row_equally(spark):
    got = draws.shuffled_shards(spark.range(103), "id", epoch=1, ratio=4, ranks=4)
    assert {r[1] for r in got.groupBy("id").count().collect()} == {4}
    assert {r[1] for r in got.groupBy("rank").count().collect()} == {103}
    assert sorted(r.place for r in got.collect()) == list(range(412))
    other = draws.shuffled_shards(spark.range(103), "id", epoch=2, ratio=4, ranks=4)
    assert [r.id for r in got.orderBy("place").collect()] != [r.id for r in other.orderBy("place").collect()]


def test_numbered_is_the_global_order(spark):
    got = pairing.numbered(spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x")).repartition(5), ["x"])
    assert [r.ordinal for r in got.orderBy("x").collect()] == list(range(1000))


def test_listing_enters_hidden_folders(spark, tmp_path):
    (tmp_path / ".hidden").mkdir()
    for name in ("a.png", ".b.png", "_c.png", ".hidden/d.png", "e.txt"):
        (tmp_path / name).write_text("x")
    got = {r.rel_path for r in manifests.listing(spark, str(tmp_path), ".png").collect()}
    assert got == {"a.png", "_c.png", ".hidden/d.png"}
    assert {r.rel_path for r in manifests.listing(spark, str(tmp_path), ".png", recursive=False).collect()} == {"a.png", "_c.png"}


def test_store_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("k1", bytearray(b"abc"), 2, 3, 3, 1), ("k2", bytearray(b""), 4, 5, 1, 0)], "key string, value binary, h int, w int, c int, level int")
    manifests.write_store(df, f"{tmp_path}/s.store")
    back = manifests.parse_manifest_lines(spark.read.text(f"{tmp_path}/s.store/meta_info"), "value").orderBy("key").select("key", "h", "w", "c", "level").collect()
    assert [tuple(r) for r in back] == [("k1", 2, 3, 3, 1), ("k2", 4, 5, 1, 0)]
    got = manifests.read_store(spark, f"{tmp_path}/s.store", spark.createDataFrame([("k1",), ("zz",)], "key string"))
    assert {r.key: r.value and bytes(r.value) for r in got.collect()} == {"k1": b"abc", "zz": None}
    with pytest.raises(Exception, match="(?i)already exists"):
        manifests.write_store(df, f"{tmp_path}/s.store")


def test_registry_and_options():
    r = registry.Registry("losses")

    @r.register
    def L1Loss():
        return 1

    assert r.get("l1loss") is L1Loss and "L1LOSS" in r
    with pytest.raises(AssertionError):
        r.register(L1Loss)
    with pytest.raises(KeyError):
        r.get("missing")
    tree = registry.build_tree([("a.b", 1), ("a.c", [1, 2]), ("d", None)])
    assert tree == {"a": {"b": 1, "c": [1, 2]}, "d": None}
    assert registry.flatten(tree) == [("a.b", "1"), ("a.c.0", "1"), ("a.c.1", "2"), ("d", "null")]
    assert registry.strip_common_prefix(["m.a", "m.b"], ["x.", "m."]) == ["a", "b"]


def test_pool_keeps_every_row_once(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for k in range(3):
        spark.range(k * 50, k * 50 + 50).select((F.col("id") % 2).alias("shard"), F.col("id").alias("k"), F.concat(F.lit("p"), "id").alias("p")).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("shard long, k long, p string").option("maxFilesPerTrigger", 1).parquet(source)
    q = pool.shuffle_pool(stream, "shard", "k", "p", 10).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.read.parquet(out).toPandas()
    assert got.filling.sum() == 20 and len(got) == 150
    left = got[~got.filling]
    assert left.key.is_unique and (left.payload == "p" + left.key.astype(str)).all()


def test_windowed_counts(spark, tmp_path):
    spark.createDataFrame([("2024-01-01 00:00:10", "a", 1.0), ("2024-01-01 00:00:50", "a", 2.0), ("2024-01-01 00:01:10", "b", 3.0)], "ts string, k string, v double").select(F.to_timestamp("ts").alias("ts"), "k", "v").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, k string, v double").parquet(f"{tmp_path}/in")
    q = pool.windowed(stream, "ts", "1 minute", "1 minute", ["k"], "v").writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.k, r.n, r.total) for r in spark.table("windows").collect()) == [("a", 2, 3.0), ("b", 1, 3.0)]
