"""HSLuv, drawn kernels, crops, pair augmentations, degradation sequences, ranges of hot keys and the pool, by closed and slow forms."""

from __future__ import annotations

import math
import time

import numpy as np
import pytest
from pairloom.functions import arrays, colour
from pairloom.operators import batch_augment, frames, images, named_sequences, pairing, sequences
from pairloom.operators.sequences import Sequence, Step
from pairloom.plans import engine
from pairloom.plans.base import image_pairs
from pairloom.plans.catalog import QUERIES
from pairloom.streaming import pool
from pyspark.sql import functions as F


def test_hsluv_of_known_colours(spark):
    """Published values: pure red, green, blue and some mid tones; black and white have no saturation."""
    known = {(1.0, 0.0, 0.0): (12.1770506300617765, 100.0, 53.2371155954293607), (0.0, 1.0, 0.0): (127.715012949240474, 100.0, 87.7355191965597), (0.0, 0.0, 1.0): (265.874320217681, 100.0, 32.3008578902006), (1.0, 1.0, 1.0): (None, 0.0, 100.0), (0.0, 0.0, 0.0): (None, 0.0, 0.0)}
    df = spark.createDataFrame(list(known), "r double, g double, b double")
    for row in df.select("*", colour.hsluv(F.col("r"), F.col("g"), F.col("b")).alias("v")).collect():
        h, s, l = known[row.r, row.g, row.b]
        assert (h is None or row.v.h == pytest.approx(h, abs=1e-3)) and row.v.s == pytest.approx(s, abs=1e-3) and row.v.l == pytest.approx(l, abs=1e-3)


def test_hsluv_distances_by_hand(spark):
    """Opposite hues count 1; round the circle 350 and 10 are 20 degrees apart; dark pairs and grays have no hue; a gray beside a colour counts its saturation."""
    one = lambda h, s, l: F.struct(F.lit(float(h)).alias("h"), F.lit(float(s)).alias("s"), F.lit(float(l)).alias("l"))
    cases = [((0, 50, 50), (180, 50, 50), (1, 0, 0)), ((350, 50, 50), (10, 50, 50), (20 / 180, 0, 0)), ((0, 50, 5), (180, 50, 5), (0, 0, 0)), ((0, 5, 50), (180, 5, 50), (0, 0, 0)), ((0, 5, 50), (180, 60, 50), (0.6, 0.55, 0)), ((0, 50, 95), (180, 50, 50), (0, 0, 0.45))]
    got = spark.range(1).select(*[colour.hsluv_distances(one(*a), one(*b)).alias(f"d{k}") for k, (a, b, _) in enumerate(cases)]).first()
    for row, (_, _, want) in zip(got, cases, strict=True):
        assert tuple(row) == pytest.approx(want)


def test_cdf_kernel_by_the_error_function(spark, sf):
    phi = lambda x: 0.5 * math.erfc(-x / math.sqrt(2))
    for r in QUERIES["ker_cdf"](spark, sf).limit(20).collect():
        want = [phi(x * r.a - y * 0.25) * phi(x * 0.25 + y * r.a) for y in range(-3, 4) for x in range(-3, 4)]
        assert r.k == pytest.approx(want, abs=1e-12)


def test_cdf_kernel_of_many_matrices(spark, tmp_path):
    """The tails keep their digits, a null size has no kernel, and a task does 40,000 different matrices in seconds."""
    phi = lambda x: 0.5 * math.erfc(-x / math.sqrt(2))
    sizes = spark.createDataFrame([(0, 50), (1, 200), (2, None)], "p_partkey long, p_size int")
    sizes.write.parquet(f"{tmp_path}/part.parquet")
    got = {r.p_partkey: r for r in QUERIES["ker_cdf"](spark, str(tmp_path)).collect()}
    for n in (0, 1):
        a = got[n].a
        assert got[n].k == pytest.approx([phi(x * a - y * 0.25) * phi(x * 0.25 + y * a) for y in range(-3, 4) for x in range(-3, 4)], rel=1e-9, abs=0)
    assert got[2].a is None and got[2].k is None
    began = time.time()
    many = images.skewed_cdf(spark.range(0, 40_000, 1, 1).withColumn("a", F.col("id") / 20_000), 7, ((F.col("a"), 0.25), (-0.25, F.col("a"))))
    assert many.agg(F.sum(F.size("k"))).first()[0] == 49 * 40_000 and time.time() - began < 30


def test_point_kernel(spark):
    k = np.array(spark.range(1).select(arrays.spread_point(13, F.lit(1.6)).alias("k")).first().k).reshape(13, 13)
    line = np.exp(-0.5 * (np.arange(-6, 7) / 1.6) ** 2)
    assert k == pytest.approx(np.outer(line, line) / line.sum() ** 2)
    with pytest.raises(Exception, match="wider than the kernel"):
        spark.range(1).select(arrays.spread_point(13, F.lit(3.0))).collect()


@pytest.mark.parametrize(("name", "shape"), [("ker_rand_gauss", 0), ("ker_rand_gen", 1), ("ker_rand_plateau", 2)])
def test_drawn_kernels_replay(spark, sf, name, shape):
    rows = QUERIES[name](spark, sf).collect()
    for r in rows:
        want = images.shaped_kernel(7, r.sx, r.sy, r.theta, r.beta, shape) * np.reshape(r.noise, (7, 7))
        assert r.k == pytest.approx((want / want.sum()).ravel(), abs=1e-9)
        assert 0.6 <= r.sx <= 5 and 0.6 <= r.sy <= 5 and all(0.75 <= v <= 1.25 for v in r.noise)
    assert 0.35 < np.mean([r.beta < 1 for r in rows]) < 0.65


def test_crops_of_an_enlarged_image(spark, sf):
    """9 / 8 as large by linear interpolation, cell by cell."""
    whole = {r.vec_id: np.reshape(r.p, (8, 8)) for r in image_pairs(spark, sf).collect()}
    place = lambda k: min(max((k + 0.5) * 8 / 9 - 0.5, 0), 7)
    rows = QUERIES["arr_multi_crop"](spark, sf).where("vec_id < 40").collect()
    assert {(r.top, r.left) for r in rows} == {(0, 0), (0, 1), (1, 0), (1, 1)}
    for r in rows:
        p = whole[r.vec_id]
        for y in range(8):
            for x in range(8):
                a, b = place(y + r.top), place(x + r.left)
                i, j = int(a), int(b)
                k, m = min(i + 1, 7), min(j + 1, 7)
                want = (p[i, j] * (1 - b + j) + p[i, m] * (b - j)) * (1 - a + i) + (p[k, j] * (1 - b + j) + p[k, m] * (b - j)) * (a - i)
                assert r.patch[8 * y + x] == pytest.approx(want)


def test_resizemix_changes_its_box_alone(spark, sf):
    rows = engine._paired(spark, sf, "resizemix")
    drawn = {r.vec_id: r for r in rows.collect()}
    assert len({(r.y0, r.y1, r.x0, r.x1) for r in drawn.values()}) > 10
    for r in QUERIES["aug_resizemix"](spark, sf).collect():
        d = drawn[r.vec_id]
        for scale, got, own, other in ((1, r.lq, d.lq, d.lq_other), (2, r.gt, d.gt, d.gt_other)):
            n = 8 * scale
            got, own, other = (np.reshape(v, (1, n, n)) for v in (got, own, other))
            box = np.zeros((n, n), bool)
            box[d.y0 * scale : d.y1 * scale, d.x0 * scale : d.x1 * scale] = True
            assert (got[0][~box] == own[0][~box]).all()
            if box.any():
                want = images.resize(other, (d.y1 - d.y0) * scale, (d.x1 - d.x0) * scale)
                assert got[0][box] == pytest.approx(want.ravel())


def test_down_and_up_again(spark, sf):
    rows = engine._paired(spark, sf, "downup").collect()
    ways = {(r.down, r.over) for r in rows}
    assert (2, 2) not in ways and len(ways) > 4 and all(0.5 <= r.factor < 0.9 for r in rows)
    flat = np.full((1, 8, 8), 0.3)
    for over in batch_augment.SAMPLINGS:
        assert batch_augment.downup(flat, 0.6, "bicubic", over) == pytest.approx(flat)
        assert batch_augment.up(flat, (1, 5, 2, 6), over) == pytest.approx(flat)
    x = np.arange(64.0).reshape(1, 8, 8)
    assert (batch_augment.up(x, (0, 4, 4, 8), "nearest-exact") == x[:, :4, 4:].repeat(2, 1).repeat(2, 2)).all()
    assert (batch_augment.up(x, (4, 4, 0, 0), "bicubic") == x).all()
    # a row of six from eight: centres at (2 k + 1) * 8 / 12
    assert images.resampled(x, 8, 6, "nearest-exact")[0, 0].tolist() == [0, 2, 3, 4, 6, 7]
    gt = {r.vec_id: r.gt for r in rows}
    assert all(r.gt == gt[r.vec_id] for r in QUERIES["aug_downup"](spark, sf).collect())


def test_up_boxes_lie_within(spark, sf):
    for r in engine._paired(spark, sf, "up").collect():
        assert 0 <= r.y0 < r.y1 <= 8 and 0 <= r.x0 < r.x1 <= 8 and r.y1 - r.y0 == r.x1 - r.x0


def test_permutations_are_of_the_batch(spark, sf):
    by = {}
    for r in QUERIES["join_batch_permute"](spark, sf).collect():
        by.setdefault(r.batch, []).append((r.vec_id, r.partner))
    assert all(sorted(a for a, _ in v) == sorted(b for _, b in v) for v in by.values()) and any(a != b for v in by.values() for a, b in v)


def test_steps_follow_their_laws(spark):
    df = spark.range(20_000)
    gate, step = sequences.drawn_step(Step("jpeg", probability_range=(0.2, 0.6), parameters={"quality": 50}, parameter_ranges={"quality": (1, 2), "other": (3, 5)}), 1, "s", "id")
    got = df.select(sequences.present([(gate, step)]).alias("steps")).where("size(steps) = 1").select("steps").collect()
    assert abs(len(got) / 20_000 - 0.4) < 0.02
    assert all(r.steps[0].params["quality"] == 50 and 3 <= r.steps[0].params["other"] < 5 for r in got[:200])
    n = df.select(sequences.repeats(1, 0.3, 1, "r", "id").alias("n")).groupBy("n").count().collect()
    share = {r.n: r["count"] / 20_000 for r in n}
    assert min(share) == 1 and abs(share[1] - 0.7) < 0.02 and abs(share[2] - 0.21) < 0.02
    with pytest.raises(ValueError):
        sequences.repeats(1, 1.0, 1, "r", "id")


def test_sequences_and_their_shares(spark):
    twice = Sequence("twice", 0.2, [Step("a"), Step("b", 0.0), Step("c")], repeat=2)
    never = Sequence("never", 0.6, [Step("a")], repeat=0)
    name, steps = sequences.controlled([twice, never], 1, "id")
    got = spark.range(10_000).select(name.alias("name"), F.transform(steps, lambda s: s["type"]).alias("types")).groupBy("name", "types").count().collect()
    assert {(r.name, tuple(r.types)) for r in got} == {("twice", ("a", "c", "a", "c")), ("never", ())}
    assert abs(sum(r["count"] for r in got if r.name == "twice") / 10_000 - 0.25) < 0.02
    with pytest.raises(ValueError):
        sequences.controlled([Sequence("x", 0.7, []), Sequence("y", 0.4, [])], 1, "id")


def test_both_orders(spark, sf):
    rows = spark.range(3000).select(sequences.two_orders(F.lit(40), F.lit(24), 4, 1, "id").alias("s")).collect()
    for r in rows:
        types = [s.type for s in r.s]
        assert set(types) <= set(images.STEPS) and types[0] == "unsharp" and types[-1] == "quantise" and types.count("jpeg") == 2
        to = [s.params for s in r.s if s.type == "resize_to"]
        assert len(to) == 2 and (to[1]["h"], to[1]["w"]) == (10, 6) and 3 <= to[0]["h"] <= 12
    blurred = np.mean([[s.type for s in r.s].count("kernel_blur") + [s.type for s in r.s][:-2].count("sinc") > 0 for r in rows])
    assert blurred == 1
    last = np.mean([[s.type for s in r.s][-2] == "jpeg" for r in rows])
    assert abs(last - 0.5) < 0.04
    out = QUERIES["deg_pipeline"](spark, sf).collect()
    assert {(r.c, r.h, r.w) for r in out} == {(3, 4, 4)} and all(0 <= v <= 1 and abs(v * 255 - round(v * 255)) < 1e-4 for r in out for v in r.data)


def test_one_key_over_many_parts(spark):
    """A third and more of all rows in one key: bests and averages as if gone through row by row."""
    rng = np.random.default_rng(3)
    data = [(int(k), i, float(v)) for i, (k, v) in enumerate(zip(rng.choice([1, 2, 3], 3000, p=[0.8, 0.15, 0.05]), rng.integers(0, 40, 3000), strict=True))] + [(None, 3000, 1.0)]
    df = spark.createDataFrame(data, "k int, at int, v double")
    for higher in (True, False):
        got = {(r.k, r.at): (r.best, r.best_at) for r in frames.best_so_far(df, ["k"], "v", "at", higher).collect()}
        best = {}
        for k, at, v in data:
            if k not in best or (v >= best[k][0] if higher else v <= best[k][0]):
                best[k] = (v, at)
            assert got[k, at] == best[k]
    ema, n, rises = {}, {}, {}
    for k, _, v in data:
        n[k] = n.get(k, 0) + 1
        old = ema.get(k)
        ema[k] = v if old is None else old * 0.9 + v * 0.1
        rises[k] = old is not None and ema[k] > old
    for r in frames.ema(df, ["k"], "v", ["at"], 0.9).collect():
        assert (r.n, r.rises) == (n[r.k], rises[r.k]) and r.ema == pytest.approx(ema[r.k])
    parts = frames._cut(df, ["k"], ["at"]).where("k = 1").select("_part").distinct().count()
    assert parts > 3


def test_repeated_paths_stay(spark):
    df = spark.createDataFrame([("a/x",), ("a/x",), ("ab/x",), (None,)], "path string")
    assert sorted((r.path or "", r.root) for r in pairing.first_root(df, ["b", "a"]).collect()) == [("", None), ("a/x", "a"), ("a/x", "a"), ("ab/x", None)]
    assert {r.root for r in pairing.first_root(df, []).collect()} == {None}


def test_the_pool_keeps_any_text(spark, tmp_path):
    odd = ["\x1e", "a\x1fb\x1e", "", None, '"]', "ä\n"]
    spark.createDataFrame([(0, f"k{i}", odd[i % len(odd)]) for i in range(60)], "shard int, k string, p string").coalesce(1).write.json(f"{tmp_path}/in", ignoreNullFields=False)
    stream = spark.readStream.schema("shard int, k string, p string").json(f"{tmp_path}/in")
    q = pool.shuffle_pool(stream, "shard", "k", "p", 7).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert len(got) == 60 and sum(r.filling for r in got) == 7
    assert all(r.payload == odd[int(r.key[1:]) % len(odd)] for r in got)


@pytest.mark.parametrize("text", [named_sequences.PREDEFINED, named_sequences.COMPREHENSIVE])
def test_named_sequences(text):
    found = named_sequences.parsed(text)
    assert len(found) == 4 and sum(s.probability for s in found) == pytest.approx(1)
    unknown = {t.type for s in found for t in s.steps} - set(images.STEPS)
    assert unknown <= {"webp", "avif", "heif", "blur_by_given_kernel"}
    assert all(0 <= t.probability_range[0] <= t.probability_range[1] <= 1 and all(a <= b for a, b in t.parameter_ranges.values()) for s in found for t in s.steps)


def test_the_controller_applies_what_it_draws(spark, sf):
    whole = {r.vec_id: np.float32(r.p + r.p[::-1] + r.p) for r in image_pairs(spark, sf).collect()}
    rows = [r for r in QUERIES["deg_controller"](spark, sf).collect() if r.vec_id in whole]
    assert {r.sequence for r in rows} == {s.name for s in engine.NAMED}
    changed = [r.sequence for r in rows if not np.allclose(r.data, whole[r.vec_id], atol=1e-6)]
    assert len(changed) > 0.9 * len(rows)


def test_colour_and_aliasing_steps():
    x = np.full((3, 4, 4), 0.5)
    assert images.colour_temperature(x, 0.2)[:, 0, 0] == pytest.approx([0.53, 0.51, 0.5])
    assert images.colour_temperature(x, -0.2)[:, 0, 0] == pytest.approx([0.5, 0.51, 0.53])
    y = np.arange(48.0).reshape(3, 4, 4) / 48
    assert (images.aliasing(y, 0.5) == y[:, ::2, ::2].repeat(2, 1).repeat(2, 2)).all()


def test_a_line_filter_is_the_square_one():
    x = np.random.default_rng(1).random((3, 9, 7))
    for size in (3, 11, 51):
        assert images.line_filter(x, images.gauss1d(size, size / 5)) == pytest.approx(images.filter2d(x, images.gauss2d(size, size / 5)))
