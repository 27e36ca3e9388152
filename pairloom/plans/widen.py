"""Queries over whole images and logs: pixel formats, layouts, forced augmentations, drawn noise, JSON and scalar sinks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pairloom.functions import arrays, colour, draws
from pairloom.operators import frames as fr, images as np_images, sequences
from pairloom.plans.base import IMG, PAIR, PIXELS as _PIXELS, frames, image_pairs, images, query
from pairloom.plans.engine import _coloured
from pairloom.plans.extras import _pairs16
from pairloom.plans.pixels import CB, CR, Y, _digest, grid
from pairloom.sources.manifests import table


def _unclipped(y, cb, cr):
    """YCbCr of 0..1 to RGB, not clipped."""
    a, b, c = y * 255 - 16, cb * 255 - 128, cr * 255 - 128
    return (1.164 * a + 1.596 * c) / 255, (1.164 * a - 0.392 * b - 0.813 * c) / 255, (1.164 * a + 2.017 * b) / 255


_BACK = {"r": "(1.164 * (y * 255 - 16) + 1.596 * (cr * 255 - 128)) / 255", "g": "(1.164 * (y * 255 - 16) - 0.392 * (cb * 255 - 128) - 0.813 * (cr * 255 - 128)) / 255", "b": "(1.164 * (y * 255 - 16) + 2.017 * (cb * 255 - 128)) / 255"}
_SUMS = ", ".join(f"round(sum(({e}) * (i + 1)), 5) as {c}" for c, e in _BACK.items())
_channels = lambda p, i: (F.element_at(p, (i + 1).cast("int")), F.element_at(p, (64 - i).cast("int")), F.element_at(p, ((i + 32) % 64 + 1).cast("int")))


def _sums(rows, cell):
    """Place-weighted sums of three channels over all pixels."""
    rgb = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.struct(*[(v * (i + 1)).alias(n) for v, n in zip(cell(i), "rgb", strict=True)]))
    made = rows.select("vec_id", rgb.alias("a"))
    return made.select("vec_id", *[F.round(arrays.total(F.col(f"a.{n}")), 5).alias(n) for n in "rgb"])


@query("col_ycbcr2rgb_pt", f"select vec_id, {_SUMS} from (select vec_id, i, r as y, g as cb, b as cr from ({_PIXELS.format(a='p', source=IMG)})) group by vec_id")
def _(spark, sf):
    return _sums(images(spark, sf), lambda i: _unclipped(*_channels(F.col("p"), i)))


@query("col_pixelformat2rgb_y", f"select vec_id, {_SUMS} from (select vec_id, i, p[i + 1] as y, {CB} as cb, {CR} as cr from (select x.*, z.p from ({_PIXELS.format(a='q', source=PAIR)}) x join {IMG} z using (vec_id))) group by vec_id")
def _(spark, sf):
    """The luma of an image with the chroma of another."""

    def cell(i):
        _, cb, cr = colour.ycbcr601(*_channels(F.col("q"), i))
        return _unclipped(F.element_at("p", (i + 1).cast("int")), cb, cr)

    return _sums(image_pairs(spark, sf), cell)


@query("col_pixelformat2rgb_uv", f"select vec_id, {_SUMS} from (select vec_id, i, {Y} as y, p[i + 1] as cb, p[64 - i] as cr from (select x.*, z.p from ({_PIXELS.format(a='q', source=PAIR)}) x join {IMG} z using (vec_id))) group by vec_id")
def _(spark, sf):
    """The chroma of an image with the luma of another."""

    def cell(i):
        return _unclipped(colour.luma601(*_channels(F.col("q"), i)), *_channels(F.col("p"), i)[:2])

    return _sums(image_pairs(spark, sf), cell)


_DIGEST = "len(a)::int as n, round(list_sum(list_transform(a, lambda x, i: x * i)), 6) as digest"


@query("num_img2rgb", f"select vec_id, {_DIGEST} from (select vec_id, case when vec_id % 2 = 0 then list_transform(range(0, 192), lambda k: p[k // 3 + 1]) else list_transform(range(0, 48), lambda k: p[k // 3 * 4 + k % 3 + 1]) end as a from {IMG})")
def _(spark, sf):
    """8 x 8 grays, and 4 x 4 images of four channels."""
    return images(spark, sf).select("vec_id", *_digest(arrays.to_three(F.col("p"), F.when(F.col("vec_id") % 2 == 0, 1).otherwise(4))))


@query("num_reorder", f"select vec_id, {_DIGEST} from (select vec_id, list_transform(range(0, 64), lambda k: p[k % 4 * 16 + k // 4 + 1]) as a from {IMG})")
def _(spark, sf):
    return images(spark, sf).select("vec_id", *_digest(arrays.channels_last(F.col("p"), 4)))


def _forced(source: str) -> str:
    step = lambda flag, index, inner: f"(select * replace (case when {flag} then list_transform({grid(8, 8, index)}, lambda k: {source}[k + 1]) else {source} end as {source}) from {inner})"
    return step("vec_id % 5 = 0", "(7 - X) * 8 + Y", step("vec_id % 3 = 0", "(7 - Y) * 8 + X", step("vec_id % 2 = 1", "Y * 8 + 7 - X", PAIR)))


@query("arr_augment_pair", f"select vec_id, x.digest as p, y.digest as q from (select vec_id, round(list_sum(list_transform(p, lambda x, i: x * i)), 6) as digest from {_forced('p')}) x join (select vec_id, round(list_sum(list_transform(q, lambda x, i: x * i)), 6) as digest from {_forced('q')}) y using (vec_id)")
def _(spark, sf):
    """Both images alike; flags that are given win over draws."""
    i = F.col("vec_id")
    given = {"across": i % 2 == 1, "down": i % 3 == 0, "quarter": i % 5 == 0}
    flags = [F.coalesce(g, draws.gate(0.5, 73, s, "vec_id")) for s, g in given.items()]
    turned = lambda c: _digest(arrays.turned(F.col(c), 8, 8, *flags))[1].alias(c)
    return image_pairs(spark, sf).select("vec_id", turned("p"), turned("q"))


@query("arr_random_crop_list")
def _(spark, sf):
    """Each image of a list with its own place: 4 x 4 of both."""
    place = lambda s, k: F.floor(draws.uniform(79, s, "vec_id", F.lit(k)) * 5).cast("int")
    one = lambda c, k: F.struct(place("top", k).alias("top"), place("left", k).alias("left"), arrays.crop(F.col(c), 8, place("top", k), place("left", k), 4, 4).alias("patch"))
    return image_pairs(spark, sf).select("vec_id", F.posexplode(F.array(one("p", 0), one("q", 1))).alias("k", "c")).select("vec_id", "k", "c.*")


def _drawn(name: str, kind: str, param: str, low: float, high: float, gray: float | None):
    @query(name)
    def _(spark, sf):
        """Every image with a strength of its own, beside what was drawn."""
        u = draws.between(low, high, 83, f"{name}/{param}", "vec_id")
        more = {} if gray is None else {"gray": draws.gate(gray, 83, f"{name}/gray", "vec_id").cast("double")}
        rows = _coloured(spark, sf).withColumn("steps", F.array(sequences.step_struct(kind, {param: u, **more})))
        return np_images.degrade(rows, "vec_id").withColumn(param, u)


_drawn("deg_gauss_rand", "gauss_noise", "sigma", 0.0, 15.0, 0.4)
_drawn("deg_poisson_rand", "poisson_noise", "scale", 0.05, 3.0, 0.4)
_drawn("deg_jpeg_rand", "jpeg", "quality", 75.0, 95.0, None)


@query("met_ssim_pt")
def _(spark, sf):
    """Colour images, valid windows, mean over channels."""
    return np_images.score_pairs(_pairs16(spark, sf, rgb=True), "vec_id", "ssim")


_KEYS = "select user_id, event_id, case when user_id % 3 = 0 then 'module.netG.' when user_id % 3 = 1 then 'netG.' when event_id % 2 = 0 then 'module.' else '' end || event_type as k from events"
_STRIP = lambda prefix, inner: f"select user_id, event_id, case when bool_and(starts_with(k, '{prefix}')) over (partition by user_id) then k[{len(prefix) + 1}:] else k end as k from ({inner})"


@query("sd_prefix", _STRIP("netG.", _STRIP("module.", _KEYS)))
def _(spark, sf):
    """Keys of each dictionary without a prefix that all of them have, one prefix after the other."""
    u = F.col("user_id") % 3
    prefix = F.when(u == 0, "module.netG.").when(u == 1, "netG.").when(F.col("event_id") % 2 == 0, "module.").otherwise("")
    out = table(spark, sf, "events").select("user_id", "event_id", F.concat(prefix, "event_type").alias("k"))
    for p in ("module.", "netG."):
        shared = F.min(F.col("k").startswith(p)).over(Window.partitionBy("user_id"))
        out = out.withColumn("k", F.when(shared, F.substr("k", F.lit(len(p) + 1))).otherwise(F.col("k")))
    return out


@query("agg_current_log", "select event_type, sum(c)::double / (100 * count(*)) as value, count(*) as n from (select event_type, cast(round_even(value * 100, 0) as bigint) as c from events) group by event_type")
def _(spark, sf):
    return frames(spark, sf).groupBy("event_type").agg((F.sum("cents").cast("double") / (100 * F.count("*"))).alias("value"), F.count("*").alias("n"))


@query("sink_metric_scalar", "select event_id as iter, 'metrics/' || user_id || '/' || event_type as tag, value, max(value) over w as best, (max(struct_pack(v := value, at := event_id)) over w).at as best_at from events window w as (partition by user_id, event_type order by event_id)")
def _(spark, sf):
    """Long rows of a metrics log, each with the best so far."""
    rows = fr.best_so_far(frames(spark, sf), ["user_id", "event_type"], "value", "event_id")
    return rows.select(F.col("event_id").alias("iter"), F.concat_ws("/", F.lit("metrics"), "user_id", "event_type").alias("tag"), "value", "best", "best_at")


@query("sink_bench_json", "select p_brand as variant, to_json({variant: p_brand, results: list({scale: p_size, n: n, error: case when n > 1 then 'repeated' else '' end} order by p_size)})::varchar as line from (select p_brand, p_size, count(*) as n from part group by all) group by p_brand")
def _(spark, sf):
    """One nested JSON text a variant: its scales in order, with a failure beside each."""
    n = table(spark, sf, "part").groupBy("p_brand", F.col("p_size").alias("scale")).agg(F.count("*").alias("n"))
    one = F.struct("scale", "n", F.when(F.col("n") > 1, "repeated").otherwise("").alias("error"))
    return n.groupBy(F.col("p_brand").alias("variant")).agg(F.array_sort(F.collect_list(one)).alias("results")).select("variant", F.to_json(F.struct("variant", "results")).alias("line"))


@query("ord_calib_limit", "select source || '/' || doc_id || '.png' as path from documents order by path limit 64")
def _(spark, sf):
    """The first 64 image paths: the limit is the operator's own."""
    return table(spark, sf, "documents").select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".png")).alias("path")).orderBy("path").limit(64)
