"""Image operators that need NumPy, on rows of (c, h, w, data). One Arrow stage applies a whole list of steps.

Images are float arrays (c, h, w) in 0..1. Random parameters are drawn before, as columns (see functions.draws), or from a
generator seeded by the row's key, so results do not depend on partitions or retries.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The published JPEG quantisation tables.
Y_TABLE = np.array([
    [16, 11, 10, 16, 24, 40, 51, 61], [12, 12, 14, 19, 26, 58, 60, 55], [14, 13, 16, 24, 40, 57, 69, 56], [14, 17, 22, 29, 51, 87, 80, 62],
    [18, 22, 37, 56, 68, 109, 103, 77], [24, 35, 55, 64, 81, 104, 113, 92], [49, 64, 78, 87, 103, 121, 120, 101], [72, 92, 95, 98, 112, 100, 103, 99],
], np.float64)
C_TABLE = np.full((8, 8), 99.0)
C_TABLE[:4, :4] = [[17, 18, 24, 47], [18, 21, 26, 66], [24, 26, 56, 99], [47, 66, 99, 99]]
#: Values that a task works out at a time.
GROUP_VALUES = 1 << 20


def row_rng(seed: int, *key) -> np.random.Generator:
    return np.random.default_rng([seed, zlib.crc32(repr(key).encode())])


def filter2d(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Correlation with an odd kernel, reflected at the borders."""
    k = kernel.shape[-1]
    if k % 2 == 0:
        raise ValueError("kernel size must be odd")
    p = np.pad(x, ((0, 0), (k // 2, k // 2), (k // 2, k // 2)), mode="reflect")
    return np.einsum("chwij,ij->chw", np.lib.stride_tricks.sliding_window_view(p, (k, k), axis=(1, 2)), kernel)


def gauss1d(size: int, sigma: float) -> np.ndarray:
    g = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma * sigma))
    return g / g.sum()


def gauss2d(size: int, sigma: float) -> np.ndarray:
    g = gauss1d(size, sigma)
    return np.outer(g, g)


def j1(x: np.ndarray) -> np.ndarray:
    """Bessel function of the first kind, order 1, by its integral (trapezoid rule over a period, exact to rounding for moderate x)."""
    x = np.asarray(x, np.float64)
    t = (np.arange(256) + 0.5) * math.pi / 256
    return np.cos(t - x[..., None] * np.sin(t)).mean(-1)


def sinc_kernel(cutoff: float, size: int, pad_to: int = 0) -> np.ndarray:
    """The circular low pass of a cutoff frequency, sum 1, zero-padded to pad_to if that is larger."""
    if size % 2 == 0:
        raise ValueError("kernel size must be odd")
    y, x = np.mgrid[:size, :size] - size // 2
    r = np.hypot(x, y)
    with np.errstate(invalid="ignore", divide="ignore"):
        k = cutoff * j1(cutoff * r) / (2 * math.pi * r)
    k[size // 2, size // 2] = cutoff**2 / (4 * math.pi)
    k /= k.sum()
    return np.pad(k, (pad_to - size) // 2) if pad_to > size else k


def normal_cdf(x: np.ndarray) -> np.ndarray:
    """Of the standard normal, to rounding in both tails."""
    flat = (x.ravel() / -math.sqrt(2)).tolist()
    return np.fromiter(map(math.erfc, flat), np.float64, len(flat)).reshape(x.shape) / 2


def skewed_cdf(rows: DataFrame, size: int, d: tuple[tuple[Column, Column], tuple[Column, Column]]) -> DataFrame:
    """
    Rows with k: of a size x size grid about 0 times a matrix, the standard normal's distribution function in two
    dimensions; null where the matrix holds a null. A matrix is worked out once for its rows of a part.
    """
    grid = np.mgrid[:size, :size].reshape(2, -1)[::-1].T - size // 2.0
    per = max(1, GROUP_VALUES // (2 * size * size))
    cells = [F.lit(v).cast("double").alias(f"_d{k}") for k, v in enumerate((*d[0], *d[1]))]
    stay = rows.columns

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, per):
                part = batch.slice(start, per)
                given = [part.column(f"_d{k}") for k in range(4)]
                known = np.logical_and.reduce([v.is_valid().to_numpy(zero_copy_only=False) for v in given])
                matrices, which = np.unique(np.stack([v.to_numpy(zero_copy_only=False) for v in given], 1), axis=0, return_inverse=True)
                k = normal_cdf(grid @ matrices.reshape(-1, 2, 2)).prod(-1)
                made = [k[n] if ok else None for n, ok in zip(which.ravel(), known, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in stay), pa.array(made, pa.list_(pa.float64()))], names=[*stay, "k"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.select("*", *cells).mapInArrow(run, f"{kept}, k array<double>")


def line_filter(x: np.ndarray, line: np.ndarray) -> np.ndarray:
    """filter2d by the outer product of a line with itself, one direction after the other."""
    r, n = len(line) // 2, len(line)
    p = np.pad(x, ((0, 0), (r, r), (r, r)), mode="reflect")
    across = np.lib.stride_tricks.sliding_window_view(p, n, axis=2) @ line
    return np.lib.stride_tricks.sliding_window_view(across, n, axis=1) @ line


def unsharp(x: np.ndarray, weight: float = 0.5, size: int = 51, threshold: float = 10.0) -> np.ndarray:
    """Sharpened where the difference to the blur exceeds threshold / 255, with a soft edge."""
    line = gauss1d(size, 0.3 * ((size - 1) * 0.5 - 1) + 0.8)
    rest = x - line_filter(x, line)
    soft = line_filter((np.abs(rest) * 255 > threshold).astype(np.float64), line)
    return soft * np.clip(x + weight * rest, 0, 1) + (1 - soft) * x


def ssim(a: np.ndarray, b: np.ndarray, peak: float = 255.0) -> float:
    """11 x 11 Gaussian windows of sigma 1.5, valid region, mean over channels."""
    if a.shape != b.shape:
        raise ValueError(f"shapes differ: {a.shape}, {b.shape}")
    w = gauss2d(11, 1.5)
    view = lambda v: np.einsum("chwij,ij->chw", np.lib.stride_tricks.sliding_window_view(v, (11, 11), axis=(1, 2)), w)
    a, b = a.astype(np.float64), b.astype(np.float64)
    c1, c2 = (0.01 * peak) ** 2, (0.03 * peak) ** 2
    ma, mb = view(a), view(b)
    va, vb, ab = view(a * a) - ma * ma, view(b * b) - mb * mb, view(a * b) - ma * mb
    return float(((2 * ma * mb + c1) * (2 * ab + c2) / ((ma**2 + mb**2 + c1) * (va + vb + c2))).mean())


def psnr(a: np.ndarray, b: np.ndarray, peak: float = 255.0, border: int = 0) -> float:
    if a.shape != b.shape:
        raise AssertionError(f"shapes differ: {a.shape}, {b.shape}")
    if border:
        a, b = (v[:, border:-border, border:-border] for v in (a, b))
    e = float(((a.astype(np.float64) - b) ** 2).mean())
    return math.inf if e == 0 else 10 * math.log10(peak * peak / e)


def weights_of(n: int, m: int, width: float, kernel) -> np.ndarray:
    """Rows of weights by which m samples are made of n, widened when shrinking."""
    scale = m / n
    stretch = min(scale, 1.0)
    centre = (np.arange(m) + 0.5) / scale - 0.5
    w = kernel((np.arange(n)[None] - centre[:, None]) * stretch)
    w[np.abs(np.arange(n)[None] - centre[:, None]) > width / stretch] = 0
    return w / w.sum(1, keepdims=True)


def _cubic(a: float):
    def f(x):
        x = np.abs(x)
        return np.where(x <= 1, (a + 2) * x**3 - (a + 3) * x**2 + 1, np.where(x < 2, a * x**3 - 5 * a * x**2 + 8 * a * x - 4 * a, 0.0))

    return f


RESAMPLERS = {"bilinear": (1.0, lambda x: np.maximum(0, 1 - np.abs(x))), "bicubic": (2.0, _cubic(-0.5)), "catrom": (2.0, _cubic(-0.5)), "lanczos": (3.0, lambda x: np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)), "area": (0.5, lambda x: (np.abs(x) <= 0.5).astype(np.float64))}


def resampled(x: np.ndarray, h: int, w: int, mode: str = "bicubic") -> np.ndarray:
    """Not clipped. nearest takes the cell that the new cell's start lies in, nearest-exact the one of its centre."""
    if mode in ("nearest", "nearest-exact"):
        at = lambda n, m: np.arange(m) * n // m if mode == "nearest" else (2 * np.arange(m) + 1) * n // (2 * m)
        return x[:, at(x.shape[1], h)][:, :, at(x.shape[2], w)]
    width, kernel = RESAMPLERS[mode]
    return np.einsum("ah,chw,bw->cab", weights_of(x.shape[1], h, width, kernel), x, weights_of(x.shape[2], w, width, kernel))


def _points(n: int, m: int) -> np.ndarray:
    """m x n: cubic weights (-0.75) of the four cells around each point, never widened; the edge cells go on outside."""
    at = (np.arange(m) + 0.5) * n / m - 0.5
    out = np.zeros((m, n))
    for k in range(-1, 3):
        cell = np.floor(at).astype(int) + k
        np.add.at(out, (np.arange(m), cell.clip(0, n - 1)), _cubic(-0.75)(at - cell))
    return out


def _lanczos_line(n: int, m: int, a: int = 3) -> np.ndarray:
    """n x n: a low pass for shrinking n cells to m, mirrored at the edge cells."""
    ratio = m / n
    last = math.ceil(a / ratio + 1) - 2
    k = np.arange(-last, last + 1)
    t = k * ratio
    w = np.where(np.abs(t) < a, np.sinc(t) * np.sinc(t / a), 0.0)
    cell = np.abs(np.arange(n)[:, None] + k)
    if last > n - 1:
        raise ValueError(f"{n} cells cannot be mirrored for a filter of {last} to each side")
    out = np.zeros((n, n))
    np.add.at(out, (np.repeat(np.arange(n), len(k)), np.where(cell > n - 1, 2 * (n - 1) - cell, cell).ravel()), np.tile(w / w.sum(), n))
    return out


def lanczos_resize(x: np.ndarray, h: int, w: int) -> np.ndarray:
    """A Lanczos low pass where the image shrinks, then cubic points."""
    down, across = (_points(n, m) @ (_lanczos_line(n, m) if m < n else np.eye(n)) for n, m in ((x.shape[1], h), (x.shape[2], w)))
    return np.clip(np.einsum("ah,chw,bw->cab", down, x, across), 0, 1)


def truncated_catrom(x: np.ndarray, factor: float) -> np.ndarray:
    """Catmull-Rom to a share of the size; values are cut, not rounded, to steps of 1/255."""
    return np.floor(resize(x, round(x.shape[1] * factor), round(x.shape[2] * factor), "catrom") * 255) / 255


def resize(x: np.ndarray, h: int, w: int, mode: str = "bicubic") -> np.ndarray:
    return np.clip(resampled(x, h, w, mode), 0, 1)


_DCT = np.array([[math.sqrt((1 if k == 0 else 2) / 8) * math.cos((2 * n + 1) * k * math.pi / 16) for n in range(8)] for k in range(8)])


def jpeg(x: np.ndarray, quality: float) -> np.ndarray:
    """JPEG's losses without its coding: YCbCr, 4:2:0, 8 x 8 cosine transform, quantisation, and back."""
    factor = (5000 / quality if quality < 50 else 200 - quality * 2) / 100
    h, w = x.shape[1:]
    full = np.pad(x * 255, ((0, 0), (0, -h % 16), (0, -w % 16)), mode="edge")
    matrix = np.array([[0.299, 0.587, 0.114], [-0.168736, -0.331264, 0.5], [0.5, -0.418688, -0.081312]])
    ycc = np.einsum("ij,jhw->ihw", matrix, full) + np.array([0, 128, 128])[:, None, None]
    planes = [ycc[0], *(p.reshape(p.shape[0] // 2, 2, p.shape[1] // 2, 2).mean((1, 3)) for p in ycc[1:])]
    out = []
    for p, table in zip(planes, (Y_TABLE, C_TABLE, C_TABLE), strict=True):
        blocks = p.reshape(p.shape[0] // 8, 8, p.shape[1] // 8, 8).transpose(0, 2, 1, 3) - 128
        q = np.maximum(table * factor, 1e-6)
        blocks = np.round(_DCT @ blocks @ _DCT.T / q) * q
        out.append((_DCT.T @ blocks @ _DCT + 128).transpose(0, 2, 1, 3).reshape(p.shape))
    ycc = np.stack([out[0], *(p.repeat(2, 0).repeat(2, 1) for p in out[1:])]) - np.array([0, 128, 128])[:, None, None]
    back = np.array([[1, 0, 1.402], [1, -0.344136, -0.714136], [1, 1.772, 0]])
    return np.clip(np.einsum("ij,jhw->ihw", back, ycc)[:, :h, :w] / 255, 0, 1)


def sample(x: np.ndarray, ys: np.ndarray, xs: np.ndarray) -> np.ndarray:
    """Bilinear values at fractional places; outside is 0."""
    h, w = x.shape[1:]
    y0, x0 = np.floor(ys).astype(int), np.floor(xs).astype(int)
    out = np.zeros((x.shape[0], *ys.shape))
    for dy in (0, 1):
        for dx in (0, 1):
            y, c = y0 + dy, x0 + dx
            weight = (1 - np.abs(ys - y)) * (1 - np.abs(xs - c)) * ((y >= 0) & (y < h) & (c >= 0) & (c < w))
            out += x[:, y.clip(0, h - 1), c.clip(0, w - 1)] * weight
    return out


def _grid(x):
    return np.mgrid[: x.shape[1], : x.shape[2]].astype(np.float64)


def rotate(x: np.ndarray, degrees: float) -> np.ndarray:
    ys, xs = _grid(x)
    cy, cx, a = (x.shape[1] - 1) / 2, (x.shape[2] - 1) / 2, math.radians(degrees)
    return sample(x, cy + (ys - cy) * math.cos(a) - (xs - cx) * math.sin(a), cx + (ys - cy) * math.sin(a) + (xs - cx) * math.cos(a))


def reflected(v: np.ndarray, size: int) -> np.ndarray:
    """Places outside an image, mirrored at its outer edges."""
    v = np.abs(v + 0.5)
    turns, rest = np.floor(v / size), v % size
    return np.clip(np.where(turns % 2 == 0, rest, size - rest) - 0.5, 0, size - 1)


def sample_unit(x: np.ndarray, ys: np.ndarray, xs: np.ndarray) -> np.ndarray:
    """Bilinear values at places given from -1 to 1 between the outer edges of the image, which is mirrored outside."""
    h, w = x.shape[1:]
    return np.clip(sample(x, reflected(((ys + 1) * h - 1) / 2, h), reflected(((xs + 1) * w - 1) / 2, w)), 0, 1)


def _unit_grid(x: np.ndarray):
    return np.meshgrid(np.linspace(-1, 1, x.shape[1]), np.linspace(-1, 1, x.shape[2]), indexing="ij")


def lens(x: np.ndarray, k: float) -> np.ndarray:
    """Radial distortion r (1 + k r^2), in coordinates from -1 to 1."""
    ys, xs = _unit_grid(x)
    f = 1 + k * (ys**2 + xs**2)
    return sample_unit(x, ys * f, xs * f)


def rolling_shutter(x: np.ndarray, strength: float) -> np.ndarray:
    """Rows slanted about the centre by strength times height over width."""
    ys, xs = _unit_grid(x)
    return sample_unit(x, ys, xs + strength * x.shape[1] / x.shape[2] * ys)


def chromatic(x: np.ndarray, red: float = 1.001, blue: float = 0.999) -> np.ndarray:
    if x.shape[0] != 3:
        raise ValueError("three channels are needed")
    ys, xs = _grid(x)
    cy, cx = (x.shape[1] - 1) / 2, (x.shape[2] - 1) / 2
    scaled = lambda p, s: sample(p[None], cy + (ys - cy) / s, cx + (xs - cx) / s)[0]
    return np.clip(np.stack([scaled(x[0], red), x[1], scaled(x[2], blue)]), 0, 1)


def oversharpen(x: np.ndarray, strength: float) -> np.ndarray:
    p = np.pad(x, ((0, 0), (2, 2), (2, 2)))
    blur = np.lib.stride_tricks.sliding_window_view(p, (5, 5), axis=(1, 2)).mean((3, 4))
    return np.clip(x + (x - blur) * strength, 0, 1)


def chroma420(x: np.ndarray) -> np.ndarray:
    """Chroma halved and restored, luma untouched."""
    y = 0.299 * x[0] + 0.587 * x[1] + 0.114 * x[2]
    cr, cb = (x[0] - y) * 0.713 + 0.5, (x[2] - y) * 0.564 + 0.5
    h, w = y.shape
    low = resize(np.stack([cr, cb]), max(1, h // 2), max(1, w // 2), "area")
    cr, cb = resize(low, h, w, "bilinear") - 0.5
    r, b = y + 1.403 * cr, y + 1.773 * cb
    return np.clip(np.stack([r, y - 0.714 * cr - 0.344 * cb, b]), 0, 1)


def demosaic(x: np.ndarray) -> np.ndarray:
    """An RGGB mosaic, filled in again bilinearly."""
    h, w = x.shape[1:]
    masks = np.zeros((3, h, w))
    masks[0, ::2, ::2] = masks[1, ::2, 1::2] = masks[1, 1::2, ::2] = masks[2, 1::2, 1::2] = 1
    k = np.array([[1, 2, 1], [2, 4, 2], [1, 2, 1]], np.float64)
    return np.clip(filter2d(x * masks, k) / np.maximum(filter2d(masks, k), 1e-9), 0, 1)


def gauss_noise(x: np.ndarray, sigma: float, rng: np.random.Generator, gray: bool = False) -> np.ndarray:
    noise = rng.standard_normal((1 if gray else x.shape[0], *x.shape[1:])) * sigma / 255
    return np.clip(x + noise, 0, 1)


def poisson_noise(x: np.ndarray, scale: float, rng: np.random.Generator, gray: bool = False) -> np.ndarray:
    base = np.clip(np.round((x.mean(0, keepdims=True) if gray else x) * 255) / 255, 0, 1)
    levels = 2.0 ** math.ceil(math.log2(max(2, len(np.unique(base)))))
    return np.clip(x + (rng.poisson(base * levels) / levels - base) * scale, 0, 1)


def motion_kernel(size: int, degrees: float) -> np.ndarray:
    """Equal weights on the cells less than half a cell from a line through the centre."""
    y, x = np.mgrid[:size, :size] - size // 2
    k = (np.abs(y * math.cos(math.radians(degrees)) + x * math.sin(math.radians(degrees))) < 0.5).astype(np.float64)
    return k / k.sum()


def zero_filter2d(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Each channel's correlation with an odd kernel; zeros outside."""
    r, c = (n // 2 for n in kernel.shape)
    padded = np.pad(x, ((0, 0), (r, r), (c, c)))
    return np.einsum("chwij,ij->chw", np.lib.stride_tricks.sliding_window_view(padded, kernel.shape, (1, 2)), kernel)


def shaped_kernel(size: int, sx: float, sy: float, theta: float, beta: float, shape: int) -> np.ndarray:
    """Sum 1, for a covariance with axes sx and sy turned by theta: 0 Gaussian, 1 generalised, 2 plateau."""
    turn = np.array([[math.cos(theta), -math.sin(theta)], [math.sin(theta), math.cos(theta)]])
    inverse = np.linalg.inv(turn @ np.diag([sx * sx, sy * sy]) @ turn.T)
    y, x = np.mgrid[:size, :size] - size // 2
    q = inverse[0, 0] * x * x + 2 * inverse[0, 1] * x * y + inverse[1, 1] * y * y
    k = 1 / (1 + q**beta) if shape == 2 else np.exp(-0.5 * (q**beta if shape == 1 else q))
    return k / k.sum()


MODES = ("area", "bilinear", "bicubic", "lanczos")


def colour_temperature(x: np.ndarray, shift: float) -> np.ndarray:
    """As functions.colour.colour_temperature."""
    more = np.array([0.3, 0.1, 0.0] if shift > 0 else [0.0, 0.1, 0.3]) * abs(shift) + 1
    return np.clip(x * more[:, None, None], 0, 1)


def aliasing(x: np.ndarray, scale: float) -> np.ndarray:
    """Down and up again by the nearest cells."""
    small = resize(x, max(1, int(x.shape[1] * scale)), max(1, int(x.shape[2] * scale)), "nearest")
    return resize(small, *x.shape[1:], "nearest")


#: name -> step(image, params, rng)
STEPS = {
    "kernel_blur": lambda x, p, r: filter2d(x, shaped_kernel(int(p.get("size", 7)), p.get("sx", 1.0), p.get("sy", 1.0), p.get("theta", 0.0), p.get("beta", 1.0), int(p.get("shape", 0)))),
    "resize_to": lambda x, p, r: resize(x, int(p.get("h", x.shape[1])), int(p.get("w", x.shape[2])), MODES[int(p.get("mode", 2))]),
    "quantise": lambda x, p, r: np.clip(np.round(x * 255), 0, 255) / 255,
    "blur": lambda x, p, r: filter2d(x, gauss2d(int(p.get("size", 7)), p.get("sigma", 1.0))),
    "sinc": lambda x, p, r: np.clip(filter2d(x, sinc_kernel(p.get("cutoff", 2.0), int(p.get("size", 7)))), 0, 1),
    "motion_blur": lambda x, p, r: zero_filter2d(x, motion_kernel(int(p.get("size", 7)) | 1, p.get("angle", 0.0))),
    "gauss_noise": lambda x, p, r: gauss_noise(x, p.get("sigma", 10.0), r, p.get("gray", 0) > 0 or ("gray_chance" in p and r.random() < p["gray_chance"])),
    "poisson_noise": lambda x, p, r: poisson_noise(x, p.get("scale", 1.0), r, p.get("gray", 0) > 0),
    "jpeg": lambda x, p, r: jpeg(x, p.get("quality", 75.0)),
    "resize": lambda x, p, r: resize(x, max(1, round(x.shape[1] * p.get("factor", 0.5))), max(1, round(x.shape[2] * p.get("factor", 0.5))), MODES[int(p.get("mode", 2))]),
    "lens": lambda x, p, r: lens(x, p.get("k", 0.1)),
    "exposure": lambda x, p, r: np.clip(x * p.get("factor", 1.0), 0, 1),
    "sensor_noise": lambda x, p, r: np.clip(x + r.standard_normal(x.shape) * p.get("std", 0.01), 0, 1),
    "rolling_shutter": lambda x, p, r: rolling_shutter(x, p.get("strength", 0.1)),
    "oversharpen": lambda x, p, r: oversharpen(x, p.get("strength", 1.0)),
    "chromatic": lambda x, p, r: chromatic(x),
    "chroma420": lambda x, p, r: chroma420(x),
    "demosaic": lambda x, p, r: demosaic(x),
    "aliasing": lambda x, p, r: aliasing(x, p.get("scale", 0.5)),
    "colour_temperature": lambda x, p, r: colour_temperature(x, p.get("shift", 0.1)),
    "lanczos": lambda x, p, r: lanczos_resize(x, int(p.get("h", x.shape[1])), int(p.get("w", x.shape[2]))),
    "catrom": lambda x, p, r: truncated_catrom(x, p.get("factor", 0.5)),
    "unsharp": lambda x, p, r: unsharp(x, p.get("weight", 0.5), int(p.get("size", 11))),
}


def degrade(images: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """
    images: key, c, h, w, data (array of numbers), steps (array of type and params). All steps of a row run in one stage; an
    unknown type changes nothing. Returns key, c, h, w, data.
    """
    kind = images.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = {n: [] for n in (key, "c", "h", "w", "data")}
            for row in batch.to_pylist():
                x = np.array(row["data"], np.float64).reshape(row["c"], row["h"], row["w"])
                for k, step in enumerate(row["steps"] or []):
                    if step["type"] in STEPS:
                        x = STEPS[step["type"]](x, dict(step["params"] or []), row_rng(seed, row[key], k))
                for n, v in zip(out, (row[key], *x.shape, x.astype(np.float32).ravel().tolist()), strict=True):
                    out[n].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[key], batch.schema.field(key).type), *(pa.array(out[n], pa.int32()) for n in ("c", "h", "w")), pa.array(out["data"], pa.list_(pa.float32()))], names=list(out))

    return images.select(key, "c", "h", "w", "data", "steps").mapInArrow(run, f"`{key}` {kind}, c int, h int, w int, data array<float>")


def score_pairs(pairs: DataFrame, key: str, metric: str = "ssim", peak: float = 1.0) -> DataFrame:
    """pairs: key, c, h, w, lq, gt. Returns key and value."""
    kind = pairs.schema[key].dataType.simpleString()
    fn = {"ssim": ssim, "psnr": psnr}[metric]

    def run(batches):
        for batch in batches:
            values = [fn(*(np.array(r[n], np.float64).reshape(r["c"], r["h"], r["w"]) for n in ("lq", "gt")), peak) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(values, pa.float64())], names=[key, "value"])

    return pairs.select(key, "c", "h", "w", "lq", "gt").mapInArrow(run, f"`{key}` {kind}, value double")
