"""Formulas against hand-computed cases and slow forms written from their definitions."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pairloom.functions import arrays, colour, spectral, strings
from pairloom.operators import batch_augment, images
from pyspark.sql import functions as F

RNG = np.random.default_rng(4)
A, B = RNG.random((3, 32, 48)), RNG.random((3, 32, 48))


def value(spark, column, **cells):
    cells = {k: [float(x) for x in v] for k, v in cells.items()}
    return spark.createDataFrame([tuple(cells.values())], ", ".join(f"{k} array<double>" for k in cells)).select(column.alias("v")).first().v


def test_total_variation(spark):
    # 2 x 2: steps (3, 4), (0, 0), (5 - 4 = 1 to the right), last 0
    got = value(spark, arrays.total_variation(F.col("p"), 2, 2, eps=0.0), p=[0, 3, 4, 5])
    assert got == pytest.approx((5 + 2 + 1 + 0) / 4)


def test_correlation_and_cosines(spark):
    assert value(spark, arrays.ncc(F.col("p"), F.col("q")), p=[1, 2, 3], q=[2, 4, 6]) == pytest.approx(0)
    assert value(spark, arrays.ncc(F.col("p"), F.col("q")), p=[1, 2, 3], q=[3, 2, 1]) == pytest.approx(1)
    # two pixels of two channels: (1, 0) with (0, 1), and (0, 1) with (0, 1)
    assert value(spark, arrays.cosim(F.col("p"), F.col("q"), 2), p=[1, 0, 0, 1], q=[0, 0, 1, 1]) == pytest.approx(5 * (1 - 0.5))
    got = value(spark, arrays.clipped_huber_cosine(F.col("p"), F.col("q"), 2, 0.1), p=[1, 0, 0, 1], q=[0, 0, 1, 1])
    assert got == pytest.approx((2 * 254 / 255 + 2 * 0.05) / 4, abs=1e-5)


def test_dice_has_its_epsilon_below_only(spark):
    assert value(spark, arrays.dice(F.col("p"), F.col("q"), eps=1.0), p=[0, 0], q=[0, 0]) == pytest.approx(1)
    assert value(spark, arrays.dice(F.col("p"), F.col("q"), eps=1.0), p=[0, 0], q=[1, 1]) == pytest.approx(1 - 2 / 4)


def test_texts(spark):
    row = spark.range(1).select(
        *[strings.human_size(F.lit(float(n))).alias(f"s{k}") for k, n in enumerate((0, 1023, 1024, 1536, 5 * 1024**3, 3 * 1024**8))],
        strings.extra_params(F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value"), F.lit(t).alias("text")) for k, v, t in (("a", "x", True), ("n", "2", False))])).alias("e"),
    ).first()
    assert list(row) == ["0.0 B", "1023.0 B", "1.0 KB", "1.5 KB", "5.0 GB", "3.0 YB", "x n=2"]


def test_colour_temperature(spark):
    cells = [F.lit(0.5)] * 3
    warm, cool = (spark.range(1).select(*colour.colour_temperature(*cells, shift)).first() for shift in (0.5, -0.5))
    assert list(warm) == pytest.approx([0.575, 0.525, 0.5]) and list(cool) == pytest.approx([0.5, 0.525, 0.575])


def test_places_outside_are_mirrored():
    assert images.reflected(np.array([-0.5, -1.5, 0.0, 3.5, 4.0, 7.0]), 4).tolist() == [0, 0.5, 0, 3, 3, 0]
    flat = np.full((3, 8, 12), 0.3)
    for strength in (-0.8, 0.4, 2.0):
        assert images.lens(flat, strength) == pytest.approx(flat) and images.rolling_shutter(flat, strength) == pytest.approx(flat)


def test_motion_kernel_is_a_line():
    assert images.motion_kernel(3, 0).tolist() == [[0, 0, 0], [1 / 3] * 3, [0, 0, 0]]
    assert images.motion_kernel(3, 90) == pytest.approx(np.array([[0, 1 / 3, 0]] * 3))
    assert images.motion_kernel(5, 135) == pytest.approx(np.eye(5) / 5)


def test_equal_images_lose_nothing():
    for name in ("LaplacianPyramidLoss", "GradientVarianceLoss", "MSSIMLoss", "MSSSIML1Loss", "BicubicLoss", "ColorLoss", "LDLLoss"):
        assert abs(spectral.LOSSES[name](A, A)) < 1e-5, name


def test_losses_of_constant_images():
    flat = lambda v: np.full((3, 32, 48), v)
    assert spectral.laplacian_pyramid(flat(0.2), flat(0.7)) == pytest.approx(4e-6)
    assert spectral.bicubic(flat(0.2), flat(0.7)) == pytest.approx(0.5)
    assert spectral.colour_boxes(flat(0.2), flat(0.7)) == pytest.approx(0)  # grays have equal chroma
    red = flat(0.2)
    red[0] += 0.5
    assert spectral.colour_boxes(flat(0.2), red) == pytest.approx(0.5 * (37.797 + 112) / 255 / 2)
    wide = lambda v: np.full((3, 176, 176), v)  # noqa: E731  all five scales hold a window
    assert spectral.multiscale_ssim(wide(0.2), wide(0.7)) == pytest.approx(1)  # luminance does not count
    assert spectral.discriminative(flat(0.2), flat(0.7), flat(0.2)) == 0  # an even residual has no variance


def at(x, y, c):
    return x[y, c] if 0 <= y < x.shape[0] and 0 <= c < x.shape[1] else 0.0


def test_gradient_variance_by_loops():
    sobel = [[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]]

    def variances(x, down):
        gray = 0.2989 * x[0] + 0.587 * x[1] + 0.114 * x[2]
        k = [list(r) for r in zip(*sobel)] if down else sobel
        g = [[sum(k[i][j] * at(gray, y + i - 1, c + j - 1) for i in range(3) for j in range(3)) for c in range(48)] for y in range(32)]
        return [np.var([g[y][c] for y in range(p, p + 16) for c in range(q, q + 16)], ddof=1) for p in (0, 16) for q in (0, 16, 32)]

    want = sum(np.mean([math.sqrt((x - y) ** 2 + 1e-12) for x, y in zip(variances(A, d), variances(B, d))]) for d in (False, True))
    assert spectral.gradient_variance(A, B) == pytest.approx(want)


def test_structure_with_l1_by_loops():
    a, b = A[:, :5, :6], B[:, :5, :6]

    def blur(x, sigma, y, c):
        w = [math.exp(-((k - 16) ** 2) / (2 * sigma**2)) for k in range(33)]
        return sum(w[i] * w[j] * at(x, y + i - 16, c + j - 16) for i in range(33) for j in range(33) if 0 <= y + i - 16 < 5 and 0 <= c + j - 16 < 6) / sum(w) ** 2

    total = 0.0
    for y in range(5):
        for c in range(6):
            light = structure = 1.0
            for k in range(15):
                s, x, z = (0.5, 1, 2, 4, 8)[k // 3], a[k // 5], b[k // 5]
                mx, mz = blur(x, s, y, c), blur(z, s, y, c)
                vx, vz, xz = blur(x * x, s, y, c) - mx * mx, blur(z * z, s, y, c) - mz * mz, blur(x * z, s, y, c) - mx * mz
                structure *= (2 * xz + 0.0009) / (vx + vz + 0.0009)
                if k > 11:
                    light *= (2 * mx * mz + 0.0001) / (mx * mx + mz * mz + 0.0001)
            total += 0.1 * (1 - light * structure) + 0.9 * np.mean([blur(np.abs(a - b)[k], 8, y, c) for k in range(3)])
    assert spectral.multiscale_ssim_l1(a, b) == pytest.approx(total / 30)


def test_artifacts_by_loops():
    out, gt, smooth = A[:, :9, :10], B[:, :9, :10], (A + B)[:, :9, :10] / 2
    r = np.abs(gt - out).sum(0)
    assert (spectral.artifact_map(gt, smooth, out) == 0).all()  # the smoother output is twice as far away
    y, c = 0, 9
    mirror = lambda k, n: -k if k < 0 else 2 * (n - 1) - k if k >= n else k
    window = [r[mirror(y + i, 9), mirror(c + j, 10)] for i in range(-3, 4) for j in range(-3, 4)]
    assert spectral.artifact_map(gt, out, smooth)[y, c] == pytest.approx(np.var(window, ddof=1) * np.var(r, ddof=1) ** 0.2)


def test_batches_of_any_size_keep_their_rows(spark):
    rows = [(i, i // 10, [float(i)]) for i in (*range(0, 10), 11, 17, 23, 38, 39)] + [(None, None, [0.0])]
    df = spark.createDataFrame(rows, "id long, batch long, p array<double>")
    got = batch_augment.joined(batch_augment.partners(df, "batch", "id", 3), "batch", "id", "p").collect()
    assert len(got) == len(rows) and {r.id for r in got} == {r[0] for r in rows}
    assert {r.partner for r in got} == {r[0] for r in rows}  # a permutation
    assert all(r.batch == (None if r.partner is None else r.partner // 10) for r in got)
