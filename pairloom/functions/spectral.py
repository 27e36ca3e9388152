"""NumPy losses over pairs of images (c, h, w) in 0..1: spectra, pyramids, structure and colour spaces."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pairloom.functions.flip import flip
from pairloom.operators.images import filter2d, gauss2d, resize, ssim, zero_filter2d


def focal_frequency(a: np.ndarray, b: np.ndarray, alpha: float = 1.0) -> float:
    """Squared spectral distances, each weighted by its own size (to the power alpha, scaled to 0..1)."""
    d = np.abs(np.fft.fft2(a, norm="ortho") - np.fft.fft2(b, norm="ortho")) ** 2
    w = np.sqrt(d) ** alpha
    w = np.clip(w / max(float(w.max()), 1e-12), 0, 1)
    return float((w * d).mean())


def _charbonnier(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.sqrt((a - b) ** 2 + 1e-12).mean())


def _linear_weights(n: int, m: int) -> np.ndarray:
    """m x n: linear interpolation of n values to m, cells aligned at their edges."""
    at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
    low = np.minimum(at.astype(int), n - 1)
    out = np.zeros((m, n))
    np.add.at(out, (np.arange(m), low), 1 - (at - low))
    np.add.at(out, (np.arange(m), np.minimum(low + 1, n - 1)), at - low)
    return out


def _halved(x: np.ndarray) -> np.ndarray:
    c, h, w = x.shape
    return x[:, : h // 2 * 2, : w // 2 * 2].reshape(c, h // 2, 2, w // 2, 2).mean((2, 4))


def laplacian_pyramid(a: np.ndarray, b: np.ndarray, levels: int = 4) -> float:
    """Charbonnier distance of each band (a level less the next one, enlarged), summed; the coarsest level does not count."""
    total = 0.0
    for _ in range(levels):
        small = [_halved(x) for x in (a, b)]
        bands = [x - np.einsum("ah,chw,bw->cab", _linear_weights(s.shape[1], x.shape[1]), s, _linear_weights(s.shape[2], x.shape[2])) for x, s in zip((a, b), small, strict=True)]
        total += _charbonnier(*bands)
        a, b = small
    return total


def gradient_variance(a: np.ndarray, b: np.ndarray, patch: int = 16) -> float:
    """Charbonnier distance of the variances of the gray image's gradients in patches, across plus down."""
    sobel = np.array([[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]], np.float64)

    def variances(x, kernel):
        g = zero_filter2d(np.tensordot([0.2989, 0.5870, 0.1140], x, 1)[None], kernel)[0]
        h, w = (n // patch for n in g.shape)
        return g[: h * patch, : w * patch].reshape(h, patch, w, patch).transpose(0, 2, 1, 3).reshape(-1, patch * patch).var(1, ddof=1)

    return sum(_charbonnier(variances(a, k), variances(b, k)) for k in (sobel, sobel.T))


def bicubic(a: np.ndarray, b: np.ndarray, scale: int = 4) -> float:
    """Mean absolute difference of the images made smaller, then blurred by 5 x 5 of sigma 0.5."""
    small = [filter2d(resize(x, x.shape[1] // scale, x.shape[2] // scale), gauss2d(5, 0.5)) for x in (a, b)]
    return float(np.abs(small[0] - small[1]).mean())


def colour_boxes(a: np.ndarray, b: np.ndarray, scale: int = 4) -> float:
    """Mean absolute difference of the chroma channels' box means."""
    chroma = np.array([[-37.797, -74.203, 112.0], [112.0, -93.786, -18.214]]) / 255

    def boxes(x):
        c = np.tensordot(chroma, x, 1)
        h, w = (n // scale for n in c.shape[1:])
        return c[:, : h * scale, : w * scale].reshape(2, h, scale, w, scale).mean((2, 4))

    return float(np.abs(boxes(a) - boxes(b)).mean())


def artifact_map(gt: np.ndarray, out: np.ndarray, smooth: np.ndarray, size: int = 7) -> np.ndarray:
    """Where out has artifacts: the residual's local variance times the fifth root of its whole variance; 0 where smooth is worse."""
    worse, own = (np.abs(gt - x).sum(0) for x in (smooth, out))
    padded = np.pad(own, size // 2, mode="reflect")
    local = np.lib.stride_tricks.sliding_window_view(padded, (size, size)).var((2, 3), ddof=1)
    return np.where(own < worse, 0.0, own.var(ddof=1) ** 0.2 * local)


def discriminative(out: np.ndarray, gt: np.ndarray, smooth: np.ndarray) -> float:
    """Mean absolute difference weighed by the artifact map."""
    weight = artifact_map(gt, out, smooth)
    return float(np.abs(weight * out - weight * gt).mean())


def checkerboard(a: np.ndarray, b: np.ndarray, scale: int = 4, eps: float = 1e-12) -> float:
    """Charbonnier distance of the differences of all pairs of pixels in each scale x scale cell."""
    if a.shape != b.shape or a.shape[1] % scale or a.shape[2] % scale:
        raise ValueError(f"shapes must be equal multiples of {scale}: {a.shape}, {b.shape}")
    first, second = np.triu_indices(scale * scale, 1)

    def differences(x):
        c, h, w = x.shape
        cells = x.reshape(c, h // scale, scale, w // scale, scale).transpose(0, 2, 4, 1, 3).reshape(c, scale * scale, -1)
        return cells[:, first] - cells[:, second]

    return float(np.sqrt((differences(a) - differences(b)) ** 2 + eps).mean())


#: Published weights of the five scales.
SCALES = (0.0448, 0.2856, 0.3001, 0.2363, 0.1333)


def _contrast(a: np.ndarray, b: np.ndarray) -> float:
    """Mean contrast and structure term of SSIM, at least 0 everywhere; windows of 11 inside the image, or zeros around a smaller one."""
    kernel, r = gauss2d(11, 1.5), 5
    inside = (slice(None), slice(r, -r), slice(r, -r)) if a.shape[2] >= 11 and a.shape[1] >= 11 else ...
    mean = lambda x: zero_filter2d(x, kernel)[inside]
    ma, mb = mean(a), mean(b)
    va, vb, ab = mean(a * a) - ma * ma, mean(b * b) - mb * mb, mean(a * b) - ma * mb
    return float(np.maximum((2 * ab + 0.03**2) / (va + vb + 0.03**2), 0).mean())


def multiscale_ssim(a: np.ndarray, b: np.ndarray) -> float:
    """Product of five scales' contrast terms, each to its published weight, of the luma of images in 0..1."""
    a, b = (np.tensordot([0.299, 0.587, 0.114], np.clip(x, 0, 1), 1)[None] if len(x) == 3 else np.clip(x, 0, 1) for x in (a, b))
    out = 1.0
    for weight in SCALES:
        out *= _contrast(a, b) ** weight
        a, b = (_halved(np.pad(x, ((0, 0), *((n % 2, n % 2) for n in x.shape[1:])))) for x in (a, b))
    return out


def multiscale_ssim_l1(a: np.ndarray, b: np.ndarray, sigmas: tuple = (0.5, 1.0, 2.0, 4.0, 8.0), alpha: float = 0.1) -> float:
    """
    alpha times SSIM's distance over five Gaussians, the rest blurred L1. Each Gaussian stands for three of 15 masks, which
    are dealt in order to the channels, five to each; luminance is that of the last three masks.
    """
    size = int(4 * sigmas[-1] + 1)
    masks = {s: gauss2d(size, s) for s in sigmas}
    c1, c2, light, structure = 0.01**2, 0.03**2, 1.0, 1.0
    for k in range(15):
        kernel, x, y = masks[sigmas[k // 3]], a[k // 5][None], b[k // 5][None]
        mx, my = zero_filter2d(x, kernel), zero_filter2d(y, kernel)
        vx, vy, xy = zero_filter2d(x * x, kernel) - mx * mx, zero_filter2d(y * y, kernel) - my * my, zero_filter2d(x * y, kernel) - mx * my
        structure = structure * (2 * xy + c2) / (vx + vy + c2)
        if k >= 12:
            light = light * (2 * mx * my + c1) / (mx * mx + my * my + c1)
    blurred = zero_filter2d(np.abs(a - b), masks[sigmas[-1]]).mean(0)
    return float((alpha * (1 - light * structure)[0] + (1 - alpha) * blurred).mean())


def _cosine(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """Along the first axis."""
    return (a * b).sum(0) / (np.maximum(np.linalg.norm(a, axis=0), eps) * np.maximum(np.linalg.norm(b, axis=0), eps))


def _clipped_huber(a: np.ndarray, b: np.ndarray, share: float) -> float:
    """Pseudo-Huber distance with a share of the mean cosine distance, each pixel's clipped to 1/255..254/255."""
    return float(np.clip(np.sqrt((a - b) ** 2 + 1e-12) + share * (1 - _cosine(a, b, 1e-20)).mean(), 1 / 255, 254 / 255).mean())


def _linear(x: np.ndarray) -> np.ndarray:
    return np.where(x <= 0.04045, x / 12.92, np.maximum((x + 0.055) / 1.055, 1e-8) ** 2.4)


def lightness(x: np.ndarray) -> np.ndarray:
    """CIE L* of an RGB image, in 0..1."""
    y = np.tensordot([0.2126, 0.7152, 0.0722], _linear(x), 1)
    return np.clip(np.where(y <= 216 / 24389, y * (24389 / 27), np.cbrt(np.maximum(y, 1e-8)) * 116 - 16) / 100, 0, 1)


_LMS = np.array([[0.4122214708, 0.5363325363, 0.0514459929], [0.2119034982, 0.6806995451, 0.1073969566], [0.0883024619, 0.2817188376, 0.6299787005]])
_AB = np.array([[1.9779984951, -2.4285922050, 0.4505937099], [0.0259040371, 0.7827717662, -0.8086757660]])


def oklab_chroma(x: np.ndarray) -> np.ndarray:
    """a and b of Oklab."""
    lms = np.tensordot(_LMS, _linear(x), 1)
    return np.tensordot(_AB, np.sign(lms) * np.cbrt(np.maximum(np.abs(lms), 1e-8)), 1)


def consistency(a: np.ndarray, b: np.ndarray, size: int = 21, sigma: float = 3.0, saturation: float = 1.0, brightness: float = 0.9, cosine: float = 0.5, share: float = 0.012, weight: float = 0.25) -> float:
    """Lightness of the blurred images and Oklab chroma of the images themselves, each by clipped Huber and by cosine distance."""
    if a.shape[0] != 3 or a.shape != b.shape:
        raise ValueError(f"two RGB images of one size are needed: {a.shape}, {b.shape}")
    a, b = (np.clip(x, 1 / 255, 1) for x in (a, b))
    light = [lightness(np.clip(filter2d(x, gauss2d(size, sigma)), 0, 1)) * s for x, s in ((a, 1.0), (b, brightness))]
    chroma = [np.clip(oklab_chroma(x) * s + 0.5, 0, 1) for x, s in ((a, 1.0), (b, saturation))]
    apart = sum(float(1 - _cosine(x, y, 1e-12).mean()) for x, y in ([v[None] for v in light], chroma))
    return weight * (_clipped_huber(*light, share) + _clipped_huber(*chroma, share) + cosine * apart)


def contextual(a: np.ndarray, b: np.ndarray, bandwidth: float = 0.5) -> float:
    """-log of the mean best contextual similarity between pixels as vectors, by cosine distance around the target's mean."""
    mu = b.mean((1, 2), keepdims=True)
    x, y = ((v - mu).reshape(len(v), -1) for v in (a, b))
    x, y = (v / np.maximum(np.linalg.norm(v, axis=0), 1e-8) for v in (x, y))
    d = np.clip(1 - x.T @ y, 0, None)
    w = np.exp((1 - d / (d.min(1, keepdims=True) + 1e-5)) / bandwidth)
    return float(-math.log(max((w / w.sum(1, keepdims=True)).max(0).mean(), 1e-12)))


LOSSES = {
    "FFLoss": focal_frequency, "LaplacianPyramidLoss": laplacian_pyramid, "GradientVarianceLoss": gradient_variance, "CheckerboardLoss": checkerboard, "ConsistencyLoss": consistency,
    "PixelContextualLoss": contextual, "SSIMLoss": lambda a, b: 1 - ssim(a, b, 1.0), "MSSIMLoss": lambda a, b: 1 - multiscale_ssim(a, b), "MSSSIML1Loss": multiscale_ssim_l1, "BicubicLoss": bicubic, "ColorLoss": colour_boxes, "FLIPLoss": flip,
    # the smoother output is the image itself, half way to its target
    "LDLLoss": lambda a, b: discriminative(a, b, (a + b) / 2),
}
#: Losses of images with three channels.
RGB = {"CheckerboardLoss", "ConsistencyLoss", "GradientVarianceLoss", "MSSIMLoss", "MSSSIML1Loss", "ColorLoss", "LDLLoss", "FLIPLoss"}


def pair_losses(pairs: DataFrame, key: str, names: list[str]) -> DataFrame:
    """pairs: key, c, h, w, lq, gt. Returns key and one column per loss, all from one pass."""
    kind = pairs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            images = [tuple(np.array(r[n], np.float64).reshape(r["c"], r["h"], r["w"]) for n in ("lq", "gt")) for r in rows]
            columns = [pa.array([LOSSES[n](a, b) for a, b in images], pa.float64()) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column(key), *columns], names=[key, *names])

    return pairs.select(key, "c", "h", "w", "lq", "gt").mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{n} double" for n in names))
