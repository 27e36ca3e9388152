"""Colour conversions as column arithmetic. Inputs are r, g, b in 0..1 unless said otherwise; all stay in whole-stage code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions.arrays import let

# BT.601 studio-range weights, their inverse, and the sRGB to XYZ matrix with its white point.
Y601 = (65.481, 128.553, 24.966)
CB601 = (-37.797, -74.203, 112.0)
CR601 = (112.0, -93.786, -18.214)
XYZ = ((0.412453, 0.357580, 0.180423), (0.212671, 0.715160, 0.072169), (0.019334, 0.119193, 0.950227))
WHITE = (0.950428545377181, 1.0, 1.088900370798128)


def _dot(w, rgb) -> Column:
    return w[0] * rgb[0] + w[1] * rgb[1] + w[2] * rgb[2]


def luma601(r: Column, g: Column, b: Column) -> Column:
    return (_dot(Y601, (r, g, b)) + 16.0) / 255.0


def ycbcr601(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    return luma601(r, g, b), (_dot(CB601, (r, g, b)) + 128.0) / 255.0, (_dot(CR601, (r, g, b)) + 128.0) / 255.0


def rgb601(y: Column, cb: Column, cr: Column) -> tuple[Column, Column, Column]:
    """The inverse: y, cb, cr in 0..1."""
    y, cb, cr = y * 255.0 - 16.0, cb * 255.0 - 128.0, cr * 255.0 - 128.0
    clip = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x / 255.0))
    return clip(1.164 * y + 1.596 * cr), clip(1.164 * y - 0.392 * cb - 0.813 * cr), clip(1.164 * y + 2.017 * cb)


def linear(x: Column) -> Column:
    """sRGB to linear light."""
    return F.when(x > 0.04045, F.pow((x + 0.055) / 1.055, F.lit(2.4))).otherwise(x / 12.92)


def luminance(r: Column, g: Column, b: Column) -> Column:
    """Perceived lightness in 0..1 from linear luminance."""
    y = 0.2126 * linear(r) + 0.7152 * linear(g) + 0.0722 * linear(b)
    return F.when(y <= 216.0 / 24389.0, y * (24389.0 / 27.0)).otherwise(F.pow(y, F.lit(1.0 / 3.0)) * 116.0 - 16.0) / 100.0


def xyz(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    lin = linear(r), linear(g), linear(b)
    return tuple(_dot(row, lin) for row in XYZ)


def lab(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    f = [F.when(v / w > 0.008856, F.pow(v / w, F.lit(1.0 / 3.0))).otherwise(7.787 * (v / w) + 4.0 / 29.0) for v, w in zip(xyz(r, g, b), WHITE, strict=True)]
    return 116.0 * f[1] - 16.0, 500.0 * (f[0] - f[1]), 200.0 * (f[1] - f[2])


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def to_uint8(x: Column) -> Column:
    """0..1 to 0..255, rounding half to even."""
    return F.bround(clamp01(x) * 255.0).cast("int")


def to_uint8_fast(x: Column) -> Column:
    """The same, cutting off."""
    return (clamp01(x) * 255.0).cast("int")


def quantised(x: Column) -> Column:
    return clamp01(F.bround(x * 255.0) / 255.0)


def jpeg_factor(quality: Column) -> Column:
    return F.when(quality < 50, 5000.0 / quality).otherwise(200.0 - quality * 2) / 100.0


def smooth_round(x: Column) -> Column:
    return F.bround(x) + F.pow(x - F.bround(x), F.lit(3))


def mean_opinion(scores: Column) -> Column:
    return F.aggregate(F.transform(scores, lambda x, i: x * (i + 1)), F.lit(0.0), lambda s, x: s + x)


def exposure(pixels: Column, factor: float) -> Column:
    return F.transform(pixels, lambda x: clamp01(x * factor))


def colour_temperature(r: Column, g: Column, b: Column, shift: float) -> tuple[Column, Column, Column]:
    """Above 0 warms red by 0.3 and green by 0.1 of the shift; else blue and green are raised in the same shares."""
    more = abs(shift)
    return tuple(clamp01(x) for x in ((r * (1 + 0.3 * more), g * (1 + 0.1 * more), b) if shift > 0 else (r, g * (1 + 0.1 * more), b * (1 + 0.3 * more))))


# The published HSLuv constants (sRGB to XYZ and back, D65 white, CIE thresholds).
HSLUV_TO_XYZ = ((0.41239079926595, 0.35758433938387, 0.18048078840183), (0.21263900587151, 0.71516867876775, 0.072192315360733), (0.019330818715591, 0.11919477979462, 0.95053215224966))
HSLUV_FROM_XYZ = ((3.240969941904521, -1.537383177570093, -0.498610760293), (-0.96924363628087, 1.87596750150772, 0.041555057407175), (0.055630079696993, -0.20397695888897, 1.056971514242878))
REF_U, REF_V, KAPPA, EPSILON = 0.19783000664283, 0.46831999493879, 903.2962962, 0.0088564516


def _max_chroma(l: Column, hue: Column) -> Column:
    """Chroma at which the ray of a hue (radians) leaves the gamut: the nearest of six edges in front of it."""
    cube = F.pow(l + 16, F.lit(3.0)) / 1560896

    def lengths(v):
        out = []
        for a, b, c in HSLUV_FROM_XYZ:
            for t in (0, 1):
                below = (632260 * c - 126452 * b) * v["s"] + 126452 * t
                slope = (284517 * a - 94839 * c) * v["s"] / below
                start = ((838422 * c + 769860 * b + 731718 * a) * v["l"] * v["s"] - 769860 * t * v["l"]) / below
                way = let(F.sin(v["h"]) - slope * F.cos(v["h"]), lambda d: F.when(F.abs(d) < 1e-5, 1e-12).otherwise(d))
                out.append(start / way)
        return F.array(*out)

    sub = let(cube, lambda s: F.when(s > EPSILON, s).otherwise(l / KAPPA))
    return let(let(F.struct(l.alias("l"), hue.alias("h"), sub.alias("s")), lengths), lambda a: F.array_min(F.transform(a, lambda x: F.when(x >= 0, x).otherwise(F.array_max(a)))))


def hsluv(r: Column, g: Column, b: Column) -> Column:
    """struct of h (0..360), s and l (0..100): XYZ, CIE LUV, and chroma as a share of the most that hue and lightness allow."""
    bound = lambda x: let(F.greatest(F.lit(1e-12), F.least(F.lit(1.0), x)), lambda v: F.when(v <= 0.04045, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4))))
    rgb = F.struct(bound(r).alias("r"), bound(g).alias("g"), bound(b).alias("b"))
    tristimulus = lambda v: F.struct(*[_dot(w, (v["r"], v["g"], v["b"])).alias(n) for w, n in zip(HSLUV_TO_XYZ, "xyz", strict=True)])

    def luv(v):
        l = F.when(v["y"] > EPSILON, 116 * F.pow(v["y"], F.lit(1 / 3)) - 16).otherwise(v["y"] * KAPPA)
        whole = v["x"] + 15 * v["y"] + 3 * v["z"]
        return let(l, lambda k: F.struct(k.alias("l"), (13 * k * (4 * v["x"] / whole - REF_U)).alias("u"), (13 * k * (9 * v["y"] / whole - REF_V)).alias("v")))

    def polar(v):
        some = lambda x: F.when(x == 0, 1e-12).otherwise(x)
        u, w = some(v["u"]), some(v["v"])
        c = F.sqrt(u * u + w * w)
        degrees = let(F.degrees(F.atan2(w, u)), lambda d: F.when(d < 0, d + 360).otherwise(d))
        return F.struct(v["l"].alias("l"), c.alias("c"), F.when(c < 0.028972067, 0.0).otherwise(degrees).alias("h"))

    def share(v):
        most = F.greatest(_max_chroma(v["l"], F.radians(v["h"])), F.lit(1e-12))
        s = F.when((v["l"] > 100 - 1e-5) | (v["l"] < 1e-8), 0.0).otherwise(v["c"] / most * 100)
        return F.struct(v["h"].alias("h"), F.greatest(F.lit(0.0), F.least(F.lit(100.0), s)).alias("s"), F.greatest(F.lit(0.0), F.least(F.lit(100.0), v["l"])).alias("l"))

    return let(let(let(let(rgb, tristimulus), luv), polar), share)


def hsluv_distances(a: Column, b: Column) -> Column:
    """
    struct of hue, saturation and lightness distances of two HSLuv colours, each 0..1. Hues are compared round the circle;
    of two grays, or two dark ones, or where the first is nearly white, they count nothing; of a gray and a colour as the
    larger saturation.
    """

    def parts(v):
        (ha, sa, la), (hb, sb, lb) = ((v[s]["h"] / 360, v[s]["s"] / 100, v[s]["l"] / 100) for s in "ab")
        turn = F.least(F.abs(ha - hb), 1 - F.abs(ha - hb)) * 2
        gray, mixed = (sa < 0.1) & (sb < 0.1), ((sa < 0.1) & (sb > 0.1)) | ((sa > 0.1) & (sb < 0.1))
        hue = F.when(((la < 0.1) & (lb < 0.1)) | (la > 0.9), 0.0).when(mixed, F.greatest(sa, sb)).when(gray, 0.0).otherwise(turn)
        weight = F.least(la, 1 - la) + F.least(lb, 1 - lb)
        return F.struct(hue.alias("hue"), (F.abs(sa - sb) * weight).alias("saturation"), F.abs(la - lb).alias("lightness"))

    return let(F.struct(a.alias("a"), b.alias("b")), parts)
