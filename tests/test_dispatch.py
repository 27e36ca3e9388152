"""FLIP by a slow form and in closed form, resizers by slow forms, options, schemas and registries."""

from __future__ import annotations

import dataclasses
import math
import os

import numpy as np
import pytest
from pairloom.functions import arrays, flip
from pairloom.operators import images, options
from pairloom.plans import dispatch
from pairloom.plans.catalog import QUERIES
from pyspark.sql import functions as F

RNG = np.random.default_rng(11)


def direct(plane, kernel):
    """Correlation with a square kernel, the edge going on outside, cell by cell."""
    r = len(kernel) // 2
    h, w = plane.shape
    out = np.zeros_like(plane)
    for y in range(h):
        for x in range(w):
            out[y, x] = sum(kernel[j + r, i + r] * plane[min(max(y + j, 0), h - 1), min(max(x + i, 0), w - 1)] for j in range(-r, r + 1) for i in range(-r, r + 1))
    return out


def test_flip_filters_by_slow_form():
    ppd, plane = 20.0, RNG.random((6, 5))
    r = math.ceil(3 * math.sqrt(0.04 / (2 * math.pi**2)) * ppd)
    y, x = np.mgrid[-r : r + 1, -r : r + 1] / ppd
    blue = sum(a * math.sqrt(math.pi / b) * np.exp(-(math.pi**2) * (x * x + y * y) / b) for a, b in ((34.1, 0.04), (13.5, 0.025)))
    got = flip.contrast_filtered(np.stack([plane] * 3), ppd)
    assert got[2] == pytest.approx(direct(plane, blue / blue.sum()))
    sd = 0.082 * ppd / 2
    y, x = np.mgrid[-3:4, -3:4].astype(float)
    assert math.ceil(3 * sd) == 3
    lengths = []
    for k in (-x, x * x / (sd * sd) - 1):
        k = k * np.exp(-(x * x + y * y) / (2 * sd * sd))
        k = np.where(k < 0, k / -k[k < 0].sum(), k / k[k > 0].sum())
        lengths.append(np.hypot(direct(plane, k), direct(plane, k.T)))
    edges, points = flip.features(plane, ppd)
    assert edges == pytest.approx(lengths[0]) and points == pytest.approx(lengths[1])


def test_flip_of_plain_colours():
    plain = lambda *c: np.ones((3, 8, 8)) * np.array(c)[:, None, None]
    green, blue = plain(0, 1, 0), plain(0, 0, 1)
    assert flip.flip(green, blue) == pytest.approx(1, abs=1e-6)
    assert flip.flip(green, green) < 1e-5
    # black and white: L* of 0 and 100 and no colour, and the greatest distance by the same formulas
    lab = {}
    for name, c in (("g", (0, 1, 0)), ("b", (0, 0, 1))):
        t = [v / w for v, w in zip(flip.TO_XYZ @ c, flip.WHITE, strict=True)]
        f = [v ** (1 / 3) if v > (6 / 29) ** 3 else v * 841 / 108 + 4 / 29 for v in t]
        light = 116 * f[1] - 16
        lab[name] = (light, 5 * (f[0] - f[1]) * light, 2 * (f[1] - f[2]) * light)
    most = (abs(lab["g"][0] - lab["b"][0]) + math.hypot(lab["g"][1] - lab["b"][1], lab["g"][2] - lab["b"][2])) ** 0.7
    far = 100**0.7
    want = 0.95 / (0.4 * most) * far if far < 0.4 * most else 0.95 + 0.05 * (far - 0.4 * most) / (0.6 * most)
    assert flip.flip(plain(0, 0, 0), plain(1, 1, 1)) == pytest.approx(want, abs=1e-6)
    a, b = RNG.random((2, 3, 12, 12))
    assert flip.flip(a, b) == pytest.approx(flip.flip(b, a)) and 0 < flip.flip(a, b) < 1
    assert flip.flip(a, np.clip(a + 0.05, 0, 1)) < flip.flip(a, np.clip(a + 0.3, 0, 1))
    with pytest.raises(ValueError):
        flip.flip(a[:1], b[:1])


def test_lanczos_by_slow_form():
    n, m = 9, 6
    line = RNG.random(n)
    ratio, width = m / n, 3
    count = math.ceil(width / ratio + 1)
    places = sorted({s * k * ratio for k in range(count - 1) for s in (-1, 1)})
    sinc = lambda x: math.sin(math.pi * x) / (math.pi * x) if x else 1.0
    w = [sinc(x) * sinc(x / 3) if -3 < x < 3 else 0.0 for x in places]
    w = [v / sum(w) for v in w]
    r = len(w) // 2
    mirrored = np.pad(line, r, mode="reflect")
    low = [sum(w[j] * mirrored[i + j] for j in range(len(w))) for i in range(n)]

    def cubic(x, a=-0.75):
        x = abs(x)
        return (a + 2) * x**3 - (a + 3) * x**2 + 1 if x <= 1 else a * x**3 - 5 * a * x**2 + 8 * a * x - 4 * a if x < 2 else 0.0

    want = []
    for i in range(m):
        at = (i + 0.5) * n / m - 0.5
        want.append(min(1, max(0, sum(cubic(at - math.floor(at) - k) * low[min(max(math.floor(at) + k, 0), n - 1)] for k in range(-1, 3)))))
    got = images.lanczos_resize(np.stack([[line] * 7]), 7, m)
    assert got[0, 3] == pytest.approx(want)
    assert images.lanczos_resize(np.full((1, 9, 9), 0.3), 4, 18) == pytest.approx(np.full((1, 4, 18), 0.3))
    with pytest.raises(ValueError, match="mirrored"):
        images.lanczos_resize(np.zeros((1, 8, 8)), 2, 8)


def test_catrom_cuts_values():
    x = RNG.random((3, 8, 8))
    got = images.truncated_catrom(x, 0.5) * 255
    assert got.shape == (3, 4, 4) and got == pytest.approx(np.rint(got), abs=1e-9)
    assert (got <= images.resize(x, 4, 4, "catrom") * 255 + 1e-9).all()


def test_quarter_turns_are_exact(spark):
    x = RNG.random((5, 5))
    p = F.array(*[F.lit(v) for v in x.ravel().tolist()])
    row = spark.range(1).select(*[arrays.rotated(p, 5, 5, F.lit(float(a))).alias(f"a{a}") for a in (0, 90, 180)], arrays.rotated(p, 5, 5, F.lit(45.0)).alias("b")).first()
    for k, a in enumerate((0, 90, 180)):
        assert np.reshape(row[f"a{a}"], (5, 5)) == pytest.approx(np.rot90(x, k), abs=1e-9)
    # a corner comes from 2 * sqrt(2) cells above the centre: that far beyond the first row, which has the rest of the weight
    assert row.b[0] == pytest.approx((3 - 2 * math.sqrt(2)) * x[0, 2]) and row.b[12] == pytest.approx(x[2, 2])


def test_registries(spark):
    one = spark.range(1).select(F.array(F.lit(0.2), F.lit(0.8)).alias("p"), F.array(F.lit(0.1), F.lit(0.4)).alias("q"))
    value = lambda given: one.select(dispatch.built_loss(F.col("p"), F.col("q"), given)).first()[0]
    assert value({"type": "l1LOSS", "loss_weight": 3.0}) == pytest.approx(0.75)
    assert value({"type": "HuberLoss", "delta": 0.2}) == pytest.approx((0.005 + 0.2 * 0.3) / 2)
    assert value({"type": "GANLoss", "gan_type": "wgan"}) == pytest.approx(-0.5)
    for given, error in (({"type": "L1Loss", "other": 1}, TypeError), ({"type": "NoLoss"}, KeyError), ({"type": "GANLoss", "gan_type": "R3GAN"}, KeyError)):
        with pytest.raises(error):
            value(given)
    with pytest.raises(KeyError):
        dispatch.calculated(F.col("p"), F.col("q"), 1, {"type": "calculate_other"})
    with pytest.raises(KeyError):
        dispatch.built_dataset(spark, {"type": "OtherDataset"})
    assert dispatch.built_loss(F.col("p"), F.col("q"), given := {"type": "MSELoss"}) is not None and given == {"type": "MSELoss"}


def test_a_gate_holds_for_a_batch(spark, sf):
    by_batch = {}
    for r in QUERIES["smp_gate"](spark, sf).collect():
        assert r.batch == r.vec_id // 32
        by_batch.setdefault(r.batch, set()).add(r.on)
    assert all(len(v) == 1 for v in by_batch.values()) and len(set.union(*by_batch.values())) == 2


@dataclasses.dataclass
class Dataset:
    name: str
    roots: list[str] | str | None = None
    std: list[float] | None = None


@dataclasses.dataclass
class Run:
    name: str
    scale: int
    datasets: dict[str, Dataset]
    amp: bool = False
    rate: float = 1.0


def test_strict_options():
    pytest.importorskip("yaml")
    text = "name: a\nscale: 4\nrate: 2\ndatasets:\n  val_1: {name: x, roots: ~/d, std: [1, 2.5]}\n"
    got = options.load(text, Run)
    assert got == Run("a", 4, {"val_1": Dataset("x", "~/d", [1.0, 2.5])}, False, 2.0) and isinstance(got.rate, float)
    for bad in ("name: a\nscale: 4\n", text + "other: 1\n", text.replace("scale: 4", "scale: '4'"), text.replace("scale: 4", "scale: true"), text + "amp: 1\n", text.replace("2.5", "b"), text.replace("name: x", "title: x"), "[]"):
        with pytest.raises(ValueError):
            options.load(bad, Run)


def test_derived_options():
    assert [options.phase(n) for n in ("train", "val_2", "test_a_b")] == ["train", "val", "test"]
    home = os.path.expanduser("~")
    assert options.roots("~/a") == [f"{home}/a"] and options.roots(["b", "~"]) == ["b", home] and options.roots(None) is None
    assert options.seeded(5) == 5 and options.seeded(5, 7) == 7 and 1024 <= options.seeded(0, 0) <= 10000
    assert options.derived_paths("/r", "n", True)["resume_models"] == "/r/experiments/n/models/resume_models"
    assert options.derived_paths("/r", "n", False) == {"results_root": "/r/results/n", "log": "/r/results/n", "visualization": "/r/results/n/visualization"}


def test_differences_from_a_template():
    pytest.importorskip("yaml")
    template = {"a": 1, "b": {"c": 2, "d": [1, 2]}, "losses": [{"type": "x", "w": 1}, {"type": "y", "w": 1}], "gone": 0}
    user = {"a": 1, "b": {"c": 3, "d": [1, 5, 6]}, "losses": [{"type": "x", "w": 2}, {"type": "y", "w": 1}, {"type": "z"}], "new": {"k": 1}}
    assert options.differences(user, template) == [("b.c", 3), ("b.d.1", 5), ("b.d.2", 6), ("losses", [{"type": "x", "w": 2}, {"type": "z"}]), ("new", {"k": 1}), ("gone", None)]
    assert options.differences(template, template) == [] and options.difference_text("a: 1", "a: 1") == ""
    assert options.difference_text("a: {b: 2}", "a: {b: 1}") == "a:\n  b: 2\n"


def test_schema_and_states():
    def fn(x: float, y: list[int] | None = None, *, z: dict[str, str], other: object = None):
        pass

    found = {f.name: (f.dataType.simpleString(), f.nullable) for f in options.schema(fn)}
    assert found == {"x": ("double", False), "y": ("array<bigint>", True), "z": ("map<string,string>", False)}
    assert options.canonical({"params": {"module.netG.a": 1, "module.netG.b": 2}, "net": {}}) == ({"a": 1, "b": 2}, "params")
    assert options.canonical({"only": {"module.a": 1, "b": 2}}) == ({"module.a": 1, "b": 2}, None)
    assert options.canonical({"params": 3}) == ({"params": 3}, None) and options.canonical({}) == ({}, None)
