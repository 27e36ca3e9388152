"""Queries of HSLuv, drawn kernels, several crops, pair augmentations and planned degradation sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairloom.functions import arrays, colour, draws
from pairloom.operators import batch_augment, images as np_images, named_sequences, sequences
from pairloom.operators.sequences import Step
from pairloom.plans.base import IMG, PAIR, PIXELS as _PIXELS, image_pairs, images, query
from pairloom.plans.pixels import _digest
from pairloom.sources.manifests import table


def _hsluv_sql(pixels: str) -> str:
    """DuckDB: vec_id, i, h, s, l of pixels, one step of the conversion after the other."""
    low = lambda c: f"greatest(1e-12, least(1.0::double, {c}))"
    lin = lambda c: f"(case when {low(c)} <= 0.04045 then {low(c)} / 12.92 else pow(({low(c)} + 0.055) / 1.055, 2.4) end)"
    x, y, z = (" + ".join(f"{v}::double * {c}" for v, c in zip(row, "rgb", strict=True)) for row in colour.HSLUV_TO_XYZ)
    edges = []
    for a, b, c in colour.HSLUV_FROM_XYZ:
        for t in (0, 1):
            below = f"({632260 * c - 126452 * b!r}::double * sub + {126452 * t})"
            slope = f"({284517 * a - 94839 * c!r}::double * sub / {below})"
            start = f"(({838422 * c + 769860 * b + 731718 * a!r}::double * l * sub - {769860 * t} * l) / {below})"
            way = f"(sin(radians(h)) - {slope} * cos(radians(h)))"
            edges.append(f"{start} / (case when abs({way}) < 1e-5 then 1e-12 else {way} end)")
    return f"""(with lin as (select vec_id, i, {lin('r')} as r, {lin('g')} as g, {lin('b')} as b from ({pixels})),
        xyz as (select vec_id, i, {x} as x, {y} as y, {z} as z from lin),
        lum as (select *, case when y > {colour.EPSILON} then 116 * pow(y, 1.0::double / 3) - 16 else y * {colour.KAPPA} end as l, x + 15 * y + 3 * z as whole from xyz),
        luv as (select vec_id, i, l, 13 * l * (4 * x / whole - {colour.REF_U}::double) as u, 13 * l * (9 * y / whole - {colour.REF_V}::double) as v from lum),
        nonzero as (select vec_id, i, l, case when u = 0 then 1e-12 else u end as u, case when v = 0 then 1e-12 else v end as v from luv),
        lch as (select vec_id, i, l, sqrt(u * u + v * v) as c, case when sqrt(u * u + v * v) < 0.028972067 then 0 when atan2(v, u) < 0 then degrees(atan2(v, u)) + 360 else degrees(atan2(v, u)) end as h from nonzero),
        sub as (select *, case when pow(l + 16, 3) / 1560896 > {colour.EPSILON} then pow(l + 16, 3) / 1560896 else l / {colour.KAPPA} end as sub from lch),
        rays as (select *, [{', '.join(edges)}] as rays from sub),
        most as (select *, list_min(list_transform(rays, lambda k: case when k >= 0 then k else list_max(rays) end)) as most from rays)
        select vec_id, i, h, greatest(0, least(100, case when l > 100 - 1e-5 or l < 1e-8 then 0 else c / greatest(most, 1e-12) * 100 end)) as s, greatest(0, least(100, l)) as l from most)"""


def _hsluv(p):
    cell = lambda i: F.element_at(p, i.cast("int"))
    return F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: colour.hsluv(cell(i + 1), cell(64 - i), cell((i + 32) % 64 + 1)))


@query("col_hsluv", f"select vec_id, round(sum(h * (i + 1)), 5) as h, round(sum(s * (i + 1)), 5) as s, round(sum(l * (i + 1)), 5) as l from {_hsluv_sql(_PIXELS.format(a='p', source=IMG))} group by vec_id")
def _(spark, sf):
    weigh = lambda n: F.round(arrays.total(F.transform("a", lambda v, i: v[n] * (i + 1))), 5).alias(n)
    return images(spark, sf).select("vec_id", _hsluv(F.col("p")).alias("a")).select("vec_id", *[weigh(n) for n in "hsl"])


_TURN = "least(abs(a.h - b.h) / 360, 1 - abs(a.h - b.h) / 360) * 2"
_HUE = f"case when (a.l < 10 and b.l < 10) or a.l > 90 then 0 when (a.s < 10 and b.s > 10) or (a.s > 10 and b.s < 10) then greatest(a.s, b.s) / 100 when a.s < 10 and b.s < 10 then 0 else {_TURN} end"


@query(
    "HSLuvLoss",
    f"""select vec_id, round((avg({_HUE}) + avg(abs(a.s - b.s) / 100 * (least(a.l, 100 - a.l) + least(b.l, 100 - b.l)) / 100) + avg(abs(a.l - b.l) / 100)) / 3, 6) as value
    from {_hsluv_sql(_PIXELS.format(a='p', source=PAIR))} a join {_hsluv_sql(_PIXELS.format(a='q', source=PAIR))} b using (vec_id, i) group by vec_id""",
)
def _(spark, sf):
    both = image_pairs(spark, sf).select("vec_id", F.zip_with(_hsluv(F.col("p")), _hsluv(F.col("q")), colour.hsluv_distances).alias("d"))
    whole = F.transform("d", lambda v: v["hue"] + v["saturation"] + v["lightness"])
    return both.select("vec_id", F.round(arrays.mean(whole) / 3, 6).alias("value"))


@query("ker_cdf")
def _(spark, sf):
    """A 7 x 7 grid under a matrix by the part's size."""
    turn = table(spark, sf, "part").select("p_partkey", (F.col("p_size") / 25.0).alias("a"))
    return np_images.skewed_cdf(turn, 7, ((F.col("a"), 0.25), (-0.25, F.col("a"))))


_W = "exp(-0.5 * pow(d / sigma, 2))"


@query("ker_gauss13", f"""select p_partkey, round(list_sum(list_transform(range(0, 169), lambda i: (i + 1) * k[i // 13 + 1] * k[i % 13 + 1])), 6) as digest, round(k[7] * k[7], 6) as centre from (
    select p_partkey, list_transform(range(-6, 7), lambda d: case when abs(d) <= r then {_W} / list_sum(list_transform(range(-r, r + 1), lambda d: {_W})) else 0 end) as k from (
    select p_partkey, 0.5 + p_size / 50.0 as sigma, floor(4 * (0.5 + p_size / 50.0) + 0.5)::int as r from part))""")
def _(spark, sf):
    k = table(spark, sf, "part").select("p_partkey", arrays.spread_point(13, 0.5 + F.col("p_size") / 50.0).alias("k"))
    return k.select("p_partkey", _digest(F.col("k"))[1], F.round(F.element_at("k", 85), 6).alias("centre"))


def _drawn_kernel(name: str, kind: str | None):
    @query(name)
    def _(spark, sf):
        """All draws are columns beside the 7 x 7 kernel."""
        u = lambda s, lo, hi: draws.between(lo, hi, 41, f"{name}/{s}", "p_partkey")
        upper = 2.0 if kind == "plateau" else 4.0
        beta = F.when(draws.gate(0.5, 41, f"{name}/side", "p_partkey"), u("beta", 0.5, 1.0)).otherwise(u("beta", 1.0, upper))
        noise = F.transform(F.sequence(F.lit(0), F.lit(48)), lambda i: 0.75 + 0.5 * draws.uniform(41, f"{name}/noise", "p_partkey", i))
        drawn = table(spark, sf, "part").select("p_partkey", u("sx", 0.6, 5.0).alias("sx"), u("sy", 0.6, 5.0).alias("sy"), u("theta", -3.14, 3.14).alias("theta"), beta.alias("beta"), noise.alias("noise"))
        plain = arrays.gaussian_kernel(7, F.col("sx"), F.col("sy"), F.col("theta"), F.col("beta") if kind else None, kind == "plateau")
        return drawn.withColumn("k", arrays.noised_kernel(plain, F.col("noise")))


_drawn_kernel("ker_rand_gauss", None)
_drawn_kernel("ker_rand_gen", "generalized")
_drawn_kernel("ker_rand_plateau", "plateau")


@query("arr_multi_crop")
def _(spark, sf):
    """Three crops of 8 x 8 from each 8 x 8 image, which is first enlarged to 9 x 9."""
    places = [(draws.uniform(43, f"top{k}", "vec_id"), draws.uniform(43, f"left{k}", "vec_id")) for k in range(3)]
    crops, _, _ = arrays.multi_crop(F.col("p"), 8, 8, 8, places)
    return images(spark, sf).select("vec_id", F.posexplode(crops).alias("k", "c")).select("vec_id", "k", "c.top", "c.left", "c.patch")


def _paired(spark, sf, kind: str):
    """Pairs of 8 x 8 and 16 x 16 in batches of ten, with what each batch draws; gt is the next image, enlarged."""
    rows = image_pairs(spark, sf).select("vec_id", F.floor(F.col("vec_id") / 10).alias("batch"), F.struct(F.col("p").alias("lq"), arrays.nearest(F.col("q"), 8, 8, 16, 16).alias("gt")).alias("both"))
    if kind == "resizemix":
        rows = batch_augment.joined(batch_augment.partners(rows, "batch", "vec_id", 47), "batch", "vec_id", "both")
        rows = rows.withColumn("lq_other", F.col("other.lq")).withColumn("gt_other", F.col("other.gt"))
    for c, n in (("c", 1), ("h", 8), ("w", 8)):
        rows = rows.withColumn(c, F.lit(n))
    rows = rows.withColumns({"lq": F.col("both.lq"), "gt": F.col("both.gt")})
    return rows.withColumns(batch_augment.plan(kind, 8, 8, 47, F.col("batch")))


for _kind in ("resizemix", "downup", "up"):

    def _augmented(spark, sf, kind=_kind):
        return batch_augment.augment(_paired(spark, sf, kind), "vec_id", kind, 2)

    query(f"aug_{_kind}")(_augmented)


@query("join_batch_permute")
def _(spark, sf):
    """Each image with the one that a random permutation of its batch puts in its place."""
    rows = images(spark, sf).withColumn("batch", F.floor(F.col("vec_id") / 10))
    return batch_augment.joined(batch_augment.partners(rows, "batch", "vec_id", 53), "batch", "vec_id", "p").select("vec_id", "batch", "partner", F.round(arrays.l1(F.col("p"), F.col("other")), 6).alias("distance"))


def _coloured(spark, sf, size: int = 8):
    return images(spark, sf).select("vec_id", F.lit(3).alias("c"), F.lit(size).alias("h"), F.lit(size).alias("w"), F.concat("p", F.reverse("p"), "p").alias("data"))


@query("deg_step")
def _(spark, sf):
    """One step with a drawn chance and a drawn quality, beside what was drawn."""
    gate, step = sequences.drawn_step(Step("jpeg", probability_range=(0.3, 0.7), parameter_ranges={"quality": (30, 95)}), 59, "step", "vec_id")
    rows = _coloured(spark, sf).withColumn("steps", sequences.present([(gate, step)]))
    return np_images.degrade(rows, "vec_id").join(rows.select("vec_id", "steps"), "vec_id")


NAMED = named_sequences.parsed(named_sequences.PREDEFINED)
COMPREHENSIVE = named_sequences.parsed(named_sequences.COMPREHENSIVE)


@query("deg_sequence")
def _(spark, sf):
    """All images by one sequence with geometric repeats."""
    return np_images.degrade(_coloured(spark, sf).withColumn("steps", sequences.drawn_sequence(NAMED[0], 61, "vec_id")), "vec_id")


def _controlled(spark, sf, found: list[sequences.Sequence]):
    """Each image by the sequence that it draws; gates, parameters and repeats drawn by step."""
    name, steps = sequences.controlled(found, 67, "vec_id")
    return np_images.degrade(_coloured(spark, sf).withColumn("steps", steps), "vec_id").withColumn("sequence", name)


@query("deg_controller")
def _(spark, sf):
    return _controlled(spark, sf, NAMED)


@query("deg_comprehensive_run")
def _(spark, sf):
    return _controlled(spark, sf, COMPREHENSIVE)


def _summary(spark, found: list[sequences.Sequence]):
    rows = [(s.name, s.probability, s.repeat_probability, len(s.steps), " ".join(t.type for t in s.steps)) for s in found]
    return spark.createDataFrame(rows, "name string, p double, again double, n_steps int, steps string")


@query("deg_predefined", """select name, p::double as p, again::double as again, n_steps::int as n_steps, steps from (values
    ('internet_upload_download', 0.25, 0.3, 7, 'oversharpen colour_temperature lens webp avif jpeg oversharpen'),
    ('phone_camera_capture', 0.30, 0.0, 7, 'sensor_noise rolling_shutter lens motion_blur chromatic oversharpen heif'),
    ('dslr_professional', 0.20, 0.0, 6, 'sensor_noise rolling_shutter lens oversharpen colour_temperature jpeg'),
    ('social_media_upload', 0.25, 0.4, 5, 'oversharpen lens webp jpeg oversharpen')) s(name, p, again, n_steps, steps)""")
def _(spark, sf):
    return _summary(spark, NAMED)


@query("deg_comprehensive", """select name, p::double as p, again::double as again, n_steps::int as n_steps, steps from (values
    ('professional_to_internet', 0.20, 0.2, 9, 'gauss_noise blur_by_given_kernel colour_temperature oversharpen jpeg exposure oversharpen lens webp'),
    ('phone_to_social', 0.25, 0.5, 11, 'sensor_noise rolling_shutter motion_blur oversharpen lens chromatic resize oversharpen webp jpeg oversharpen'),
    ('social_processing', 0.30, 0.6, 9, 'exposure colour_temperature oversharpen aliasing resize webp oversharpen jpeg motion_blur'),
    ('legacy_internet', 0.25, 0.4, 7, 'oversharpen gauss_noise jpeg jpeg resize oversharpen jpeg')) s(name, p, again, n_steps, steps)""")
def _(spark, sf):
    return _summary(spark, COMPREHENSIVE)


@query("deg_pipeline")
def _(spark, sf):
    """Both orders, every gate, kind, range and mode drawn by row."""
    rows = _coloured(spark, sf)
    return np_images.degrade(rows.withColumn("steps", sequences.two_orders(F.col("h"), F.col("w"), 2, 71, "vec_id", sizes=(3, 5, 7))), "vec_id")
