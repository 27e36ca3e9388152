"""Queries of colour, geometry, kernels, degradations, metrics and losses over 8 x 8 images."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairloom.functions import arrays, colour, draws
from pairloom.operators import images as np_images
from pairloom.plans.base import IMG, PAIR, PIXELS, image_pairs, images, over_pixels, query, summed, zipped

RGB = f"({PIXELS.format(a='p', source=IMG)})"


def _colour(name: str, columns: list[str], fn, sql: list[str], source: str = RGB):
    """Place-weighted sums over all pixels of each image, by column."""
    body = ", ".join(f"round(sum(({e})::double * (i + 1)), 4) as {c}" for c, e in zip(columns, sql, strict=True))

    @query(name, f"select vec_id, {body} from {source} group by vec_id")
    def _(spark, sf):
        def made(r, g, b):
            out = fn(r, g, b)
            return F.struct(*[e.cast("double").alias(c) for c, e in zip(columns, out if isinstance(out, tuple) else (out,), strict=True)])

        rows = images(spark, sf).select("vec_id", over_pixels("p", made).alias("a"))
        return rows.select("vec_id", *[F.round(arrays.total(F.transform(f"a.{c}", lambda x, i: x * (i + 1))), 4).alias(c) for c in columns])


Y, CB, CR = "(65.481 * r + 128.553 * g + 24.966 * b + 16.0) / 255", "(-37.797 * r - 74.203 * g + 112.0 * b + 128.0) / 255", "(112.0 * r - 93.786 * g - 18.214 * b + 128.0) / 255"
clip = lambda e: f"greatest(0, least(1, {e}))"
LIN = lambda c: f"(case when {c} > 0.04045 then pow(({c} + 0.055) / 1.055, 2.4) else {c} / 12.92 end)"
_X, _Yx, _Z = (f"({a} * {LIN('r')} + {b} * {LIN('g')} + {c} * {LIN('b')})" for a, b, c in colour.XYZ)
LUM = f"(0.2126 * {LIN('r')} + 0.7152 * {LIN('g')} + 0.0722 * {LIN('b')})"
FLAB = lambda v, w: f"(case when {v} / {w} > 0.008856 then pow({v} / {w}, 1.0 / 3.0::double) else 7.787 * ({v} / {w}) + 4.0 / 29.0::double end)"
_f = [FLAB(v, w) for v, w in zip((_X, _Yx, _Z), colour.WHITE, strict=True)]

_colour("col_to_y", ["y"], colour.luma601, [Y])
_colour("col_rgb2ycbcr", ["y", "cb", "cr"], colour.ycbcr601, [Y, CB, CR])
_colour("col_bgr2ycbcr", ["y", "cb", "cr"], lambda b, g, r: colour.ycbcr601(r, g, b), [Y, CB, CR], f"(select vec_id, i, b as r, g, r as b from {RGB})")
_yy, _bb, _rr = "(r * 255 - 16)", "(g * 255 - 128)", "(b * 255 - 128)"
_colour("col_ycbcr2rgb", ["r", "g", "b"], colour.rgb601, [clip(f"(1.164 * {_yy} + 1.596 * {_rr}) / 255"), clip(f"(1.164 * {_yy} - 0.392 * {_bb} - 0.813 * {_rr}) / 255"), clip(f"(1.164 * {_yy} + 2.017 * {_bb}) / 255")])
_colour("col_linear", ["lr", "lg", "lb"], lambda r, g, b: (colour.linear(r), colour.linear(g), colour.linear(b)), [LIN("r"), LIN("g"), LIN("b")])
_colour("col_luma", ["luma"], colour.luminance, [f"(case when {LUM} <= 216.0 / 24389.0::double then {LUM} * (24389.0 / 27.0::double) else pow({LUM}, 1.0 / 3.0::double) * 116 - 16 end) / 100"])
_colour("col_xyz", ["x", "y", "z"], colour.xyz, [_X, _Yx, _Z])
_colour("col_lab_norm", ["l", "a", "bb"], colour.lab, [f"116 * {_f[1]} - 16", f"500 * ({_f[0]} - {_f[1]})", f"200 * ({_f[1]} - {_f[2]})"])
_colour("deg_color_temp", ["r2", "g2", "b2"], lambda r, g, b: colour.colour_temperature(r, g, b, 0.2), [clip("r * 1.06::double"), clip("g * 1.02::double"), clip("b")])
_colour("deg_color_temp_cool", ["r2", "g2", "b2"], lambda r, g, b: colour.colour_temperature(r, g, b, -0.2), [clip("r"), clip("g * 1.02::double"), clip("b * 1.06::double")])
_colour("num_to_float01", ["x"], lambda r, g, b: colour.clamp01(r), [clip("r")])
_colour("num_tensor2img", ["x"], lambda r, g, b: colour.to_uint8(r), [f"round_even({clip('r')} * 255, 0)::int"])
_colour("num_tensor2img_fast", ["x"], lambda r, g, b: colour.to_uint8_fast(r), [f"trunc({clip('r')} * 255)::int"])
_colour("num_clamp_round", ["x"], lambda r, g, b: colour.quantised(r), [clip("round_even(r * 255, 0) / 255")])
_colour("num_jpeg_factor", ["f"], lambda r, g, b: colour.jpeg_factor(F.greatest(F.floor(r * 90) + 5, F.lit(1))), ["(case when floor(r * 90) + 5 < 50 then 5000 / greatest(floor(r * 90) + 5, 1) else 200 - 2 * (floor(r * 90) + 5) end) / 100"])
_colour("num_diff_round", ["x"], lambda r, g, b: colour.smooth_round(r * 10), ["round_even(r * 10, 0) + pow(r * 10 - round_even(r * 10, 0), 3)"])


@query("num_mos", f"select vec_id, round({summed('list_transform(p, lambda x, i: x * i)')}, 6) as mos from {IMG}")
def _(spark, sf):
    return images(spark, sf).select("vec_id", F.round(colour.mean_opinion(F.col("p")), 6).alias("mos"))


def _digest(pixels):
    """Size and a place-weighted sum."""
    return F.size(pixels).alias("n"), F.round(arrays.total(F.transform(pixels, lambda x, i: x * (i + 1))), 6).alias("digest")


def _array(name: str, fn, indices: str | None, value: str = "p[k + 1]", body: str | None = None):
    made = body or f"list_transform({indices}, lambda k: {value})"

    @query(name, f"select vec_id, len(a)::int as n, round({summed('list_transform(a, lambda x, i: x * i)')}, 6) as digest from (select vec_id, {made} as a from {IMG})")
    def _(spark, sf):
        return images(spark, sf).select("vec_id", fn(F.col("p")).alias("a")).select("vec_id", *_digest(F.col("a")))


def grid(h: int, w: int, index: str) -> str:
    return f"list_transform(range(0, {h * w}), lambda i: {index.replace('Y', f'(i // {w})').replace('X', f'(i % {w})')})"


_array("arr_mod_crop", lambda p: arrays.mod_crop(p, 8, 8, 3), grid(6, 6, "Y * 8 + X"))
_array("arr_crop_border", lambda p: arrays.crop_border(p, 8, 8, 2), grid(4, 4, "(Y + 2) * 8 + X + 2"))
_array("arr_hflip", lambda p: arrays.hflip(p, 8, 8), grid(8, 8, "Y * 8 + 7 - X"))
_array("arr_vflip", lambda p: arrays.vflip(p, 8, 8), grid(8, 8, "(7 - Y) * 8 + X"))
_array("arr_transpose", lambda p: arrays.transpose(p, 8, 8), grid(8, 8, "X * 8 + Y"))
_array("arr_rot90", lambda p: arrays.rot90(p, 8, 8), grid(8, 8, "(7 - X) * 8 + Y"))
_array("deg_aliasing", lambda p: arrays.aliasing(p, 8, 8, 2), grid(8, 8, "(Y // 2) * 2 * 8 + (X // 2) * 2"))
_array("deg_exposure", lambda p: colour.exposure(p, 1.3), None, body=f"list_transform(p, lambda x: {clip('x * 1.3::double')})")
_array("arr_box_means", lambda p: arrays.box_means(p, 8, 8, 2), grid(4, 4, "Y * 16 + X * 2"), "(p[k + 1] + p[k + 2] + p[k + 9] + p[k + 10]) / 4")


@query("arr_random_crop_pair")
def _(spark, sf):
    """Patches of 4 x 4 and 8 x 8; the target is the next image at twice its size."""
    y, x = (F.floor(draws.uniform(5, s, "vec_id") * 5).cast("int").alias(s) for s in ("top", "left"))
    pairs = image_pairs(spark, sf).select("vec_id", y, x, "p", arrays.nearest(F.col("q"), 8, 8, 16, 16).alias("g"))
    lq, gt = arrays.paired_crop(F.col("p"), F.col("g"), (8, 8), (16, 16), 8, 2, F.col("top"), F.col("left"))
    return pairs.select("vec_id", "top", "left", lq.alias("lq"), gt.alias("gt"))


@query("aug_mixup", f"select vec_id, round({summed('list_transform(a, lambda x, i: x * i)')}, 6) as digest from (select vec_id, {zipped('z[1] * 0.45::double + z[2] * (1 - 0.45::double)')} as a from {PAIR})")
def _(spark, sf):
    return image_pairs(spark, sf).select("vec_id", arrays.mix(F.col("p"), F.col("q"), 0.45).alias("a")).select("vec_id", _digest(F.col("a"))[1])


DIFF = "abs(z[1] - z[2])"
MEAN = lambda f: f"{summed(zipped(f))} / len(p)"
MSE = MEAN("(z[1] - z[2]) * (z[1] - z[2])")


def _metric(name: str, fn, sql: str, source: str = PAIR):
    @query(name, f"select vec_id, round({sql}, 6) as value from {source}")
    def _(spark, sf):
        return image_pairs(spark, sf).select("vec_id", F.round(fn(F.col("p"), F.col("q")), 6).alias("value"))


_metric("met_psnr", lambda p, q: arrays.psnr(p, q, 1.0), f"case when {MSE} = 0 then 'Infinity'::double else 10 * log10(1 / ({MSE})) end")
_metric("met_psnr_pt", arrays.psnr_unit, f"10 * log10(1 / ({MSE} + 1e-8))")
_metric("met_compare", lambda p, q: F.array_max(F.zip_with(p, q, lambda x, y: F.abs(x - y))), f"list_max({zipped(DIFF)})")
_metric("L1Loss", arrays.l1, MEAN(DIFF))
_metric("MSELoss", arrays.mse, MSE)
_metric("CharbonnierLoss", arrays.charbonnier, MEAN("sqrt((z[1] - z[2]) * (z[1] - z[2]) + 1e-12)"))
_metric("HuberLoss", lambda p, q: arrays.huber(p, q, 0.1), MEAN("(case when abs(z[1] - z[2]) < 0.1 then 0.5 * (z[1] - z[2]) * (z[1] - z[2]) else 0.1::double * (abs(z[1] - z[2]) - 0.5 * 0.1::double) end)"))
_metric("PSNRLoss", arrays.psnr_loss, f"10 / ln(10) * ln({MSE} + 1e-8)")
_DOT = lambda a, b: summed(f"list_transform(list_zip({a}, {b}), lambda z: z[1] * z[2])")
#: Images as four channels of 4 x 4; the cosine of each pixel's channels.
_CH = lambda a, b, value: " + ".join(value.format(x=f"{a}[k + {16 * c + 1}]", y=f"{b}[k + {16 * c + 1}]") for c in range(4))
_ONE = "greatest(1e-12, least(1, {x})) * greatest(1e-12, least(1, {y}))"
_COS = lambda v: summed(f"list_transform(range(0, 16), lambda k: ({_CH('p', 'q', v)}) / (sqrt({_CH('p', 'p', v)}) * sqrt({_CH('q', 'q', v)})))") + " / 16"
_metric("CHCLoss", lambda p, q: arrays.clipped_huber_cosine(p, q, 4, 0.1), f"{summed(f'list_transform(list_zip(p, q), lambda z: greatest(1 / 255.0::double, least(254 / 255.0::double, sqrt((z[1] - z[2]) * (z[1] - z[2]) + 1e-12) + more)))')} / len(p)", f"(select *, 0.1::double * (1 - {_COS('{x} * {y}')}) as more from {PAIR})")
_metric("CosimLoss", lambda p, q: arrays.cosim(p, q, 4), f"5 * (1 - {_COS(_ONE)})")
_AVG = lambda a: f"({summed(a)} / 64)"
_VAR = lambda a: f"({_DOT(a, a)} / 64 - {_AVG(a)} * {_AVG(a)})"
_metric("NCCLoss", arrays.ncc, f"1 - 0.5::double * (1 + ({_DOT('p', 'q')} / 64 - {_AVG('p')} * {_AVG('q')}) / sqrt({_VAR('p')} * {_VAR('q')}))")
_metric("BCEWithLogitsDiceLoss", lambda p, q: arrays.bce_with_logits(p, q) + arrays.dice(p, q), MEAN("greatest(z[1], 0) - z[1] * z[2] + ln(1 + exp(-abs(z[1])))") + f" + 1 - 2 * {summed(zipped('1 / (1 + exp(-z[1])) * z[2]'))} / ({summed('list_transform(p, lambda x: 1 / (1 + exp(-x)))')} + {summed('q')} + 1e-6)")
_BOX = lambda a: f"list_transform(range(0, 16), lambda i: ({a}[(i // 4) * 16 + (i % 4) * 2 + 1] + {a}[(i // 4) * 16 + (i % 4) * 2 + 2] + {a}[(i // 4) * 16 + (i % 4) * 2 + 9] + {a}[(i // 4) * 16 + (i % 4) * 2 + 10]) / 4)"
_metric("AverageLoss", lambda p, q: arrays.l1(arrays.box_means(p, 8, 8, 2), arrays.box_means(q, 8, 8, 2)), summed(f"list_transform(list_zip({_BOX('p')}, {_BOX('q')}), lambda z: abs(z[1] - z[2]))") + " / 16")


_STEP = "sqrt(pow(case when i % 8 < 7 then p[i + 2] - p[i + 1] else 0 end, 2) + pow(case when i < 56 then p[i + 9] - p[i + 1] else 0 end, 2) + 1e-6)"


@query("TVLoss", f"select vec_id, round({summed(f'list_transform(range(0, 64), lambda i: {_STEP})')} / 64, 6) as value from {IMG}")
def _(spark, sf):
    return images(spark, sf).select("vec_id", F.round(arrays.total_variation(F.col("p"), 8, 8), 6).alias("value"))


for _kind, _expr in {"vanilla": "greatest(x, 0) - x + ln(1 + exp(-abs(x)))", "lsgan": "(x - 1) * (x - 1)", "wgan": "-x", "wgan_softplus": "ln(1 + exp(-x))", "hinge": "greatest(0, 1 - x)"}.items():

    def _gan(spark, sf, kind=_kind):
        return images(spark, sf).select("vec_id", F.round(arrays.gan_loss(F.col("p"), kind, True), 6).alias("value"))

    query(f"GANLoss_{_kind}", f"select vec_id, round({summed(f'list_transform(p, lambda x: {_expr})')} / 64, 6) as value from {IMG}")(_gan)


def _kernel(name: str, beta: float | None, plateau: bool):
    q = "((yy * X * X - 2 * xy * X * Y + xx * Y * Y) / (xx * yy - xy * xy))"
    value = f"1 / (1 + pow({q}, {beta}::double))" if plateau else f"exp(-0.5 * {q if beta is None else f'pow({q}, {beta}::double)'})"
    cells = f"list_transform(range(0, 49), lambda i: {value.replace('Y', '(i // 7 - 3)').replace('X', '(i % 7 - 3)')})"
    sql = f"""select p_partkey, round({summed('list_transform(k, lambda x, i: x * i)')} / ({summed('k')}), 6) as digest from (select p_partkey, {cells} as k from (
        select p_partkey, cos(t) * cos(t) * sx * sx + sin(t) * sin(t) * sy * sy as xx, cos(t) * sin(t) * (sx * sx - sy * sy) as xy, sin(t) * sin(t) * sx * sx + cos(t) * cos(t) * sy * sy as yy from (
        select p_partkey, 0.5::double + p_size / 20.0::double as sx, 0.8::double as sy, p_size / 10.0::double as t from part)))"""

    @query(name, sql)
    def _(spark, sf):
        from pairloom.sources.manifests import table

        s = F.col("p_size").cast("double")
        k = arrays.gaussian_kernel(7, 0.5 + s / 20.0, F.lit(0.8), s / 10.0, None if beta is None else F.lit(beta), plateau)
        return table(spark, sf, "part").select("p_partkey", k.alias("k")).select("p_partkey", _digest(F.col("k"))[1])


_kernel("ker_gauss", None, False)
_kernel("ker_gen_gauss", 1.5, False)
_kernel("ker_plateau", 1.5, True)


def _steps(spark, sf, steps: list[tuple[str, dict]]):
    made = F.array(*[F.struct(F.lit(t).alias("type"), F.create_map(*[F.lit(x) for k, v in p.items() for x in (k, float(v))] or [F.lit("none"), F.lit(0.0)]).alias("params")) for t, p in steps])
    three = F.concat("p", F.reverse("p"), "p")
    return np_images.degrade(images(spark, sf).select("vec_id", F.lit(3).alias("c"), F.lit(8).alias("h"), F.lit(8).alias("w"), three.alias("data"), made.alias("steps")), "vec_id")


def _degradation(name: str, *steps):
    @query(name)
    def _(spark, sf):
        return _steps(spark, sf, list(steps))


for _name, _step in {"deg_gauss_noise": ("gauss_noise", {"sigma": 15}), "deg_poisson": ("poisson_noise", {"scale": 1}), "deg_diffjpeg": ("jpeg", {"quality": 60}), "deg_motion_blur": ("motion_blur", {"size": 5, "angle": 30}), "deg_lens": ("lens", {"k": 0.1}), "deg_sensor": ("sensor_noise", {"std": 0.02}), "deg_rolling": ("rolling_shutter", {"strength": 0.1}), "deg_oversharpen": ("oversharpen", {"strength": 1}), "deg_chromatic": ("chromatic", {}), "deg_demosaic": ("demosaic", {}), "arr_chroma420": ("chroma420", {}), "arr_usm": ("unsharp", {"size": 7}), "arr_filter2d": ("blur", {"size": 5, "sigma": 1.2}), "arr_resize": ("resize", {"factor": 0.5}), "arr_lanczos": ("lanczos", {"h": 5, "w": 8}), "arr_catrom_resize": ("catrom", {"factor": 0.5}), "ker_sinc": ("sinc", {"cutoff": 1.5, "size": 7})}.items():
    _degradation(_name, _step)


@query("met_ssim")
def _(spark, sf):
    """Mosaics of four images: 16 x 16, as windows are 11 wide."""
    four = lambda c: F.concat(*[F.concat(F.slice(c, k * 8 + 1, 8), F.slice(c, k * 8 + 1, 8)) for k in range(8)] * 2)
    pairs = image_pairs(spark, sf).select("vec_id", F.lit(1).alias("c"), F.lit(16).alias("h"), F.lit(16).alias("w"), four("p").alias("lq"), four("q").alias("gt"))
    return np_images.score_pairs(pairs, "vec_id", "ssim")
