"""The FLIP difference of two RGB images in 0..1, by the published model: spatial filters, HyAB distances, edges and points."""

from __future__ import annotations

import math

import numpy as np

# Fixed values of the model: linear RGB to XYZ, contrast sensitivity (weights and widths by channel), exponents, the error map and the width of features.
TO_XYZ = np.array([[10135552 / 24577794, 8788810 / 24577794, 4435075 / 24577794], [2613072 / 12288897, 8788810 / 12288897, 887015 / 12288897], [1425312 / 73733382, 8788810 / 73733382, 70074185 / 73733382]])
SENSITIVITY = [((1.0, 0.0047),), ((1.0, 0.0053),), ((34.1, 0.04), (13.5, 0.025))]
QC, QF, PC, PT, FEATURE = 0.7, 0.5, 0.4, 0.95, 0.082
#: A 0.7 m wide screen of 3,840 pixels from 0.7 m.
PIXELS_PER_DEGREE = 3840 * math.pi / 180

WHITE = TO_XYZ.sum(1)
FROM_XYZ = np.linalg.inv(TO_XYZ)
#: (Y, X - Y, Y - Z) of relative XYZ, scaled as L*a*b* is.
_OPPONENT = np.array([[0, 116, 0], [500, -500, 0], [0, 200, -200]])
_START = np.array([16.0, 0, 0])[:, None, None]


def _mix(m: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.tensordot(m, x, 1)


def opponent(x: np.ndarray) -> np.ndarray:
    """YCxCz of sRGB."""
    linear = np.where(x > 0.04045, ((x + 0.055) / 1.055) ** 2.4, x / 12.92)
    return _mix(_OPPONENT @ (TO_XYZ / WHITE[:, None]), linear) - _START


def hunt_lab(linear: np.ndarray) -> np.ndarray:
    """L*a*b* of linear RGB, a and b times L / 100."""
    t = _mix(TO_XYZ / WHITE[:, None], linear)
    lab = _mix(_OPPONENT, np.where(t > (6 / 29) ** 3, np.cbrt(t), t / (3 * (6 / 29) ** 2) + 4 / 29)) - _START
    return lab * np.stack([np.ones_like(lab[0]), lab[0] / 100, lab[0] / 100])


def hyab(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    d = a - b
    return np.sqrt(np.maximum(d[0] ** 2, eps)) + np.hypot(d[1], d[2])


def along(x: np.ndarray, weights: np.ndarray, axis: int) -> np.ndarray:
    """Correlation of the last two axes' one with a line of odd length; the edge goes on outside."""
    r = len(weights) // 2
    padded = np.pad(x, [(r, r) if k == axis else (0, 0) for k in range(x.ndim)], mode="edge")
    return np.lib.stride_tricks.sliding_window_view(padded, len(weights), axis) @ weights


def contrast_filtered(x: np.ndarray, ppd: float) -> np.ndarray:
    """Each opponent channel under its sensitivity: a sum of Gaussians, each separable, all as wide as the widest needs."""
    widest = max(b for terms in SENSITIVITY for _, b in terms)
    r = math.ceil(3 * math.sqrt(widest / (2 * math.pi**2)) * ppd)
    place = np.arange(-r, r + 1) / ppd
    out = []
    for plane, terms in zip(x, SENSITIVITY, strict=True):
        lines = [(a * math.sqrt(math.pi / b), np.exp(-(math.pi**2) * place**2 / b)) for a, b in terms]
        whole = sum(w * g.sum() ** 2 for w, g in lines)
        out.append(sum(w / whole * along(along(plane, g, 0), g, 1) for w, g in lines))
    return np.stack(out)


def features(y: np.ndarray, ppd: float) -> tuple[np.ndarray, np.ndarray]:
    """Strength of edges and of points: lengths of the first and second derivatives across and down."""
    sd = FEATURE * ppd / 2
    r = math.ceil(3 * sd)
    k = np.arange(-r, r + 1)
    g = np.exp(-(k**2) / (2 * sd * sd))
    found = []
    for d in (-k * g, (k**2 / (sd * sd) - 1) * g):
        # positive weights sum to 1, negative ones to -1
        d = np.where(d < 0, d / -d[d < 0].sum(), d / d[d > 0].sum())
        smooth = g / g.sum()
        found.append(np.hypot(along(along(y, d, 1), smooth, 0), along(along(y, d, 0), smooth, 1)))
    return found[0], found[1]


def flip(a: np.ndarray, b: np.ndarray, ppd: float = PIXELS_PER_DEGREE, eps: float = 1e-15) -> float:
    """Mean error in 0..1 of a against b, as seen at so many pixels a degree."""
    if a.shape[0] != 3 or a.shape != b.shape:
        raise ValueError(f"two RGB images of one size are needed: {a.shape}, {b.shape}")
    seen = [opponent(np.clip(x, 0, 1)) for x in (a, b)]
    to_linear = (FROM_XYZ * WHITE) @ np.linalg.inv(_OPPONENT)
    lab = [hunt_lab(np.clip(_mix(to_linear, contrast_filtered(x, ppd) + _START), 0, 1)) for x in seen]
    apart = hyab(*lab, eps) ** QC
    green, blue = (hunt_lab(np.eye(3)[k][:, None, None]) for k in (1, 2))
    most = float(hyab(green, blue, eps)[0, 0] ** QC)
    low = PC * most
    colour = np.where(apart < low, PT / low * apart, PT + (apart - low) / (most - low) * (1 - PT))
    edges, points = zip(*(features((x[0] + 16) / 116, ppd) for x in seen), strict=True)
    feature = np.maximum(np.maximum(np.abs(edges[0] - edges[1]), np.abs(points[0] - points[1])), eps)
    return float((colour ** (1 - (feature / math.sqrt(2)) ** QF)).mean())
