"""Images as flat arrays: index arithmetic, kernels, pair metrics and element-wise losses, without Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def let(value: Column, body) -> Column:
    """body of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def mean(values: Column) -> Column:
    return total(values) / F.size(values)


def _at(pixels: Column, h: int, w: int, index) -> Column:
    """A new h x w image whose (y, x) is the old element index(y, x)."""
    return F.transform(F.sequence(F.lit(0), F.lit(h * w - 1)), lambda i: F.element_at(pixels, (index(F.floor(i / w), i % w) + 1).cast("int")))


def crop(pixels: Column, w: int, top: int, left: int, height: int, width: int) -> Column:
    return _at(pixels, height, width, lambda y, x: (y + top) * w + x + left)


def paired_crop(lq: Column, gt: Column, lq_size: tuple[int, int], gt_size: tuple[int, int], gt_patch: int, scale: int, top: Column, left: Column) -> tuple[Column, Column]:
    """The patch of lq at (top, left), and the one of gt that shows the same."""
    (h, w), patch = lq_size, gt_patch // scale
    if gt_size != (h * scale, w * scale):
        raise ValueError(f"scale mismatch: GT {gt_size} is not {scale} x LQ {lq_size}")
    if h < patch or w < patch:
        raise ValueError(f"LQ {lq_size} is smaller than the patch ({patch}, {patch})")

    def checked(pixels, height, width):
        return F.when(F.size(pixels) == height * width, pixels).otherwise(F.raise_error(F.lit(f"an image is not {height} x {width}")))

    return crop(checked(lq, h, w), w, top, left, patch, patch), crop(checked(gt, *gt_size), gt_size[1], top * scale, left * scale, gt_patch, gt_patch)


def mod_crop(pixels: Column, h: int, w: int, scale: int) -> Column:
    return crop(pixels, w, 0, 0, h - h % scale, w - w % scale)


def crop_border(pixels: Column, h: int, w: int, border: int) -> Column:
    return pixels if border == 0 else crop(pixels, w, border, border, h - 2 * border, w - 2 * border)


def hflip(pixels: Column, h: int, w: int) -> Column:
    return _at(pixels, h, w, lambda y, x: y * w + (w - 1 - x))


def vflip(pixels: Column, h: int, w: int) -> Column:
    return _at(pixels, h, w, lambda y, x: (h - 1 - y) * w + x)


def transpose(pixels: Column, h: int, w: int) -> Column:
    return _at(pixels, w, h, lambda y, x: x * w + y)


def rot90(pixels: Column, h: int, w: int) -> Column:
    """Clockwise."""
    return _at(pixels, w, h, lambda y, x: (h - 1 - x) * w + y)


def nearest(pixels: Column, h: int, w: int, new_h: int, new_w: int) -> Column:
    return _at(pixels, new_h, new_w, lambda y, x: F.floor(y * h / new_h) * w + F.floor(x * w / new_w))


def aliasing(pixels: Column, h: int, w: int, factor: int) -> Column:
    return let(nearest(pixels, h, w, h // factor, w // factor), lambda small: nearest(small, h // factor, w // factor, h, w))


def mix(a: Column, b: Column, share: float) -> Column:
    return F.zip_with(a, b, lambda x, y: x * share + y * (1 - share))


def _pairwise(a: Column, b: Column, f) -> Column:
    return mean(F.zip_with(a, b, f))


def mse(a: Column, b: Column) -> Column:
    return _pairwise(a, b, lambda x, y: (x - y) * (x - y))


def psnr(a: Column, b: Column, peak: float = 255.0) -> Column:
    """Equal images give infinity."""
    e = mse(a, b)
    return F.when(e == 0, F.lit(float("inf"))).otherwise(10.0 * F.log10(peak * peak / e))


def psnr_unit(a: Column, b: Column) -> Column:
    """For values in 0..1; never infinite."""
    return 10.0 * F.log10(1.0 / (mse(a, b) + 1e-8))


def l1(a: Column, b: Column) -> Column:
    return _pairwise(a, b, lambda x, y: F.abs(x - y))


def charbonnier(a: Column, b: Column, eps: float = 1e-12) -> Column:
    return _pairwise(a, b, lambda x, y: F.sqrt((x - y) * (x - y) + eps))


def huber(a: Column, b: Column, delta: float = 1.0) -> Column:
    return _pairwise(a, b, lambda x, y: F.when(F.abs(x - y) < delta, 0.5 * (x - y) * (x - y)).otherwise(delta * (F.abs(x - y) - 0.5 * delta)))


def pixel_cosine(a: Column, b: Column, channels: int, eps: float = 1e-20) -> Column:
    """Mean over the pixels of the cosine between two images' channels (stored one after another)."""
    size = F.floor(F.size(a) / channels)

    def at(k):
        def over(f):
            return F.aggregate(F.sequence(F.lit(0), F.lit(channels - 1)), F.lit(0.0), lambda s, c: s + f(F.get(a, (c * size + k).cast("int")), F.get(b, (c * size + k).cast("int"))))

        return over(lambda x, y: x * y) / (F.greatest(F.sqrt(over(lambda x, y: x * x)), F.lit(eps)) * F.greatest(F.sqrt(over(lambda x, y: y * y)), F.lit(eps)))

    return mean(F.transform(F.sequence(F.lit(0), size - 1), at))


def cosim(a: Column, b: Column, channels: int, share: float = 5.0) -> Column:
    """share times the mean cosine distance of the pixels, of values clamped to 1e-12..1."""
    clamped = lambda x: F.transform(x, lambda v: F.greatest(F.lit(1e-12), F.least(F.lit(1.0), v)))
    return let(F.struct(clamped(a).alias("a"), clamped(b).alias("b")), lambda v: share * (1.0 - pixel_cosine(v["a"], v["b"], channels)))


def clipped_huber_cosine(a: Column, b: Column, channels: int, share: float = 0.0, low: float = 1 / 255, high: float = 254 / 255) -> Column:
    """Pseudo-Huber distance of each value with a share of the pixels' mean cosine distance, clipped to low..high."""
    base = lambda x, y: F.sqrt((x - y) * (x - y) + 1e-12)
    return let(share * (1.0 - pixel_cosine(a, b, channels)), lambda more: _pairwise(a, b, lambda x, y: F.greatest(F.lit(low), F.least(F.lit(high), base(x, y) + more))))


def psnr_loss(a: Column, b: Column) -> Column:
    return 10.0 / F.log(F.lit(10.0)) * F.log(mse(a, b) + 1e-8)


def ncc(a: Column, b: Column) -> Column:
    """1 less the normalised cross-correlation of one band, moved to 0..1."""
    ma, mb = mean(a), mean(b)
    va, vb = _pairwise(a, a, lambda x, y: x * y) - ma * ma, _pairwise(b, b, lambda x, y: x * y) - mb * mb
    return 1.0 - 0.5 * (1.0 + (_pairwise(a, b, lambda x, y: x * y) - ma * mb) / F.sqrt(va * vb))


def bce_with_logits(a: Column, target: Column) -> Column:
    return _pairwise(a, target, lambda x, t: F.greatest(x, F.lit(0.0)) - x * t + F.log1p(F.exp(-F.abs(x))))


def dice(a: Column, target: Column, eps: float = 1e-6) -> Column:
    p = F.transform(a, lambda x: 1.0 / (1.0 + F.exp(-x)))
    return 1.0 - 2.0 * total(F.zip_with(p, target, lambda x, t: x * t)) / (total(p) + total(target) + eps)


def total_variation(pixels: Column, h: int, w: int, eps: float = 1e-6) -> Column:
    """Mean length of the step to the right and down; 0 beyond the last column and row."""

    def at(i):
        here = F.get(pixels, i)
        across = F.when(i % w < w - 1, F.get(pixels, i + 1) - here).otherwise(0.0)
        down = F.when(i < (h - 1) * w, F.get(pixels, i + w) - here).otherwise(0.0)
        return F.sqrt(across * across + down * down + eps)

    return mean(F.transform(F.sequence(F.lit(0), F.lit(h * w - 1)), at))


def box_means(pixels: Column, h: int, w: int, scale: int) -> Column:
    """Means of scale x scale boxes."""
    th, tw, n = h // scale, w // scale, scale * scale

    def box(i):
        top, left = F.floor(i / tw) * scale, (i % tw) * scale
        return F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), F.lit(0.0), lambda s, k: s + F.element_at(pixels, ((top + F.floor(k / scale)) * w + left + k % scale + 1).cast("int"))) / n

    return F.transform(F.sequence(F.lit(0), F.lit(th * tw - 1)), box)


def gan_loss(scores: Column, kind: str, real: bool) -> Column:
    sign = 1.0 if real else -1.0
    if kind == "vanilla":
        return bce_with_logits(scores, F.transform(scores, lambda x: F.lit(1.0 if real else 0.0)))
    if kind == "lsgan":
        return _pairwise(scores, scores, lambda x, _: (x - (1.0 if real else 0.0)) * (x - (1.0 if real else 0.0)))
    if kind == "wgan":
        return -sign * mean(scores)
    if kind == "wgan_softplus":
        return mean(F.transform(scores, lambda x: F.log1p(F.exp(-sign * x))))
    if kind == "hinge":
        return mean(F.transform(scores, lambda x: F.greatest(F.lit(0.0), 1.0 - sign * x)))
    raise ValueError(f"unknown kind {kind}")


def gaussian_kernel(size: int, sigma_x: Column, sigma_y: Column, theta: Column, beta: Column | None = None, plateau: bool = False) -> Column:
    """
    A flattened size x size kernel of sum 1 for the covariance with axes sigma_x and sigma_y turned by theta: Gaussian,
    generalised (power beta of the quadratic form) or plateau-shaped.
    """
    c, s = F.cos(theta), F.sin(theta)
    sx, sy = sigma_x * sigma_x, sigma_y * sigma_y
    cov = let(F.struct(c.alias("c"), s.alias("s"), sx.alias("sx"), sy.alias("sy")), lambda v: F.struct((v["c"] * v["c"] * v["sx"] + v["s"] * v["s"] * v["sy"]).alias("xx"), (v["c"] * v["s"] * (v["sx"] - v["sy"])).alias("xy"), (v["s"] * v["s"] * v["sx"] + v["c"] * v["c"] * v["sy"]).alias("yy"), (F.lit(1.0) if beta is None else beta).alias("beta")))
    half = size // 2

    def cells(v):
        def value(i):
            y, x = F.floor(i / size) - half, i % size - half
            q = (v["yy"] * x * x - 2.0 * v["xy"] * x * y + v["xx"] * y * y) / (v["xx"] * v["yy"] - v["xy"] * v["xy"])
            if plateau:
                return 1.0 / (1.0 + F.pow(q, v["beta"]))
            return F.exp(-0.5 * (q if beta is None else F.pow(q, v["beta"])))

        return F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), value)

    return let(let(cov, cells), lambda a: F.zip_with(a, F.array_repeat(total(a), size * size), lambda v, t: v / t))


def gaussian_density(size: int, xx: Column, xy: Column, yy: Column) -> Column:
    """exp(-q / 2) over size x size cells around the centre, q the quadratic form of the inverse of a covariance; not normalised."""
    half = size // 2

    def cells(v):
        def value(i):
            y, x = F.floor(i / size) - half, i % size - half
            return F.exp(-0.5 * (v["yy"] * x * x - 2.0 * v["xy"] * x * y + v["xx"] * y * y) / (v["xx"] * v["yy"] - v["xy"] * v["xy"]))

        return F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), value)

    return let(F.struct(xx.alias("xx"), xy.alias("xy"), yy.alias("yy")), cells)


def motion_kernel(size: int, degrees: Column) -> Column:
    """Equal weights, sum 1, on the cells less than half a cell from a line through the centre: rows go with the cosine."""
    half = size // 2

    def cells(v):
        near = lambda i: F.abs((F.floor(i / size) - half) * v["c"] + (i % size - half) * v["s"]) < 0.5
        return F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda i: near(i).cast("double"))

    return let(let(F.struct(F.cos(F.radians(degrees)).alias("c"), F.sin(F.radians(degrees)).alias("s")), cells), lambda a: F.transform(a, lambda x: x / total(a)))


def rotated(pixels: Column, h: int, w: int, degrees: Column, scale: float = 1.0) -> Column:
    """Turned counter-clockwise around (w // 2, h // 2) and scaled; bilinear, black outside."""
    cx, cy = w // 2, h // 2

    def at(v, i):
        x, y = i % w - cx, F.floor(i / w) - cy

        def value(t):
            left, top = F.floor(t["x"]), F.floor(t["y"])

            def cell(r, c):
                inside = (r >= 0) & (r < h) & (c >= 0) & (c < w)
                return F.when(inside, F.element_at(pixels, (F.greatest(r, F.lit(0)) * w + F.greatest(c, F.lit(0)) + 1).cast("int"))).otherwise(0.0)

            fx, fy = t["x"] - left, t["y"] - top
            return (cell(top, left) * (1 - fx) + cell(top, left + 1) * fx) * (1 - fy) + (cell(top + 1, left) * (1 - fx) + cell(top + 1, left + 1) * fx) * fy

        return let(F.struct(((v["c"] * x - v["s"] * y) / scale + cx).alias("x"), ((v["s"] * x + v["c"] * y) / scale + cy).alias("y")), value)

    turn = F.struct(F.cos(F.radians(degrees)).alias("c"), F.sin(F.radians(degrees)).alias("s"))
    return let(turn, lambda v: F.transform(F.sequence(F.lit(0), F.lit(h * w - 1)), lambda i: at(v, i)))


def noised_kernel(kernel: Column, noise: Column) -> Column:
    """A kernel times as many factors, sum 1 again."""
    return let(F.zip_with(kernel, noise, lambda k, n: k * n), lambda a: F.transform(a, lambda v: v / total(a)))


def spread_point(size: int, sigma: Column) -> Column:
    """A point in the middle of size x size cells after a Gaussian filter that ends at four sigma; that must lie inside."""
    half = size // 2

    def line(radius):
        weight = lambda d: F.exp(-0.5 * F.pow(d / sigma, F.lit(2.0)))
        whole = total(F.transform(F.sequence(-radius, radius), lambda d: weight(d)))
        return let(whole, lambda t: F.transform(F.sequence(F.lit(-half), F.lit(half)), lambda d: F.when(F.abs(d) <= radius, weight(d) / t).otherwise(0.0)))

    cells = let(F.floor(4 * sigma + 0.5).cast("int"), lambda r: F.when(r > half, F.raise_error(F.lit("the filter is wider than the kernel"))).otherwise(line(r)))
    return let(cells, lambda a: F.flatten(F.transform(a, lambda y: F.transform(a, lambda x: y * x))))


def bilinear(pixels: Column, h: int, w: int, scale: float) -> tuple[Column, int, int]:
    """Enlarged or shrunk between the four nearest cells, edges aligned, without a filter; and its size."""
    new_h, new_w = int(h * scale), int(w * scale)

    def at(i):
        place = lambda k, n: F.least(F.greatest((k + 0.5) / scale - 0.5, F.lit(0.0)), F.lit(n - 1.0))
        y, x = place(F.floor(i / new_w), h), place(i % new_w, w)

        def value(v):
            top, left = F.floor(v["y"]), F.floor(v["x"])
            cell = lambda r, c: F.element_at(pixels, (F.least(r, F.lit(h - 1)) * w + F.least(c, F.lit(w - 1)) + 1).cast("int"))
            fy, fx = v["y"] - top, v["x"] - left
            return (cell(top, left) * (1 - fx) + cell(top, left + 1) * fx) * (1 - fy) + (cell(top + 1, left) * (1 - fx) + cell(top + 1, left + 1) * fx) * fy

        return let(F.struct(y.alias("y"), x.alias("x")), value)

    return F.transform(F.sequence(F.lit(0), F.lit(new_h * new_w - 1)), at), new_h, new_w


def multi_crop(pixels: Column, h: int, w: int, size: int, places: list[tuple[Column, Column]]) -> tuple[Column, int, int]:
    """An array of crops at the places (shares 0..1 of the room there is); an image that is too small is enlarged first. And the size cropped from."""
    if min(h, w) <= size:
        pixels, h, w = bilinear(pixels, h, w, (size + 1) / min(h, w))
    room = lambda u, n: F.least(F.floor(u * (n - size + 1)), F.lit(n - size)).cast("int")
    crops = let(pixels, lambda p: F.array(*[let(F.struct(room(t, h).alias("top"), room(l, w).alias("left")), lambda v: F.struct(v["top"].alias("top"), v["left"].alias("left"), crop(p, w, v["top"], v["left"], size, size).alias("patch"))) for t, l in places]))
    return crops, h, w


def to_three(pixels: Column, channels: Column) -> Column:
    """Cells of one, three or more channels (channel last) as cells of three: gray thrice, or the first three."""
    whole = F.size(pixels) / channels
    picked = F.transform(F.sequence(F.lit(0), (whole * 3 - 1).cast("int")), lambda i: F.element_at(pixels, (F.when(channels == 1, F.floor(i / 3)).otherwise(F.floor(i / 3) * channels + i % 3) + 1).cast("int")))
    return F.when((channels != 1) & (channels < 3), F.raise_error(F.lit("images have one channel, or three and more"))).when(channels == 3, pixels).otherwise(picked)


def channels_last(pixels: Column, channels: int) -> Column:
    """(c, h, w) as (h, w, c)."""
    cells = (F.size(pixels) / channels).cast("int")
    return F.transform(F.sequence(F.lit(0), F.size(pixels) - 1), lambda i: F.element_at(pixels, (i % channels * cells + F.floor(i / channels) + 1).cast("int")))


def turned(pixels: Column, h: int, w: int, across: Column, down: Column, quarter: Column) -> Column:
    """Mirrored across, down, and turned by a quarter, where the flags say so. Squares only."""
    if h != w:
        raise ValueError("a quarter turn needs a square")
    for flag, f in ((across, hflip), (down, vflip), (quarter, rot90)):
        pixels = _when(flag, f, pixels, h, w)
    return pixels


def _when(flag: Column, f, pixels: Column, h: int, w: int) -> Column:
    return let(pixels, lambda p: F.when(flag, f(p, h, w)).otherwise(p))
