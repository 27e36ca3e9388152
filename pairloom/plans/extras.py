"""Further queries: sources over driver tables, checks, layouts, kernels, batch augmentations and NumPy losses."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairloom.functions import arrays, colour, draws, spectral
from pairloom.operators import aggregates, batch_augment, frames as fr, pairing
from pairloom.plans.base import PAIR, PIXELS, frames, image_pairs, images, over_pixels, query, summed, zipped
from pairloom.plans.pixels import CB, CR, LUM, Y, _colour, _digest, clip
from pairloom.plans.relational import CLIP, NAMES, names
from pairloom.sources import manifests
from pairloom.sources.manifests import table


@query("src_scandir")
def _(spark, sf):
    return manifests.listing(spark, sf, ".parquet").select("rel_path", "size")


@query("src_paired_video", "select user_id, start, centre from (select user_id, row_number() over w - 1 as start, list(event_id) over (partition by user_id order by ts, event_id rows between current row and 4 following) as clip, lead(event_id, 2) over w as centre from events where event_id % 3 <> 0 window w as (partition by user_id order by ts, event_id)) where len(clip) = 5")
def _(spark, sf):
    gt = frames(spark, sf).where("event_id % 3 != 0").select("user_id", "event_id")
    kept = frames(spark, sf).select("user_id", "event_id", "ts").join(gt, ["user_id", "event_id"])
    return fr.clips(kept, "user_id", ["ts", "event_id"], "event_id", 5).select("user_id", "start", "centre")


@query("src_otf")
def _(spark, sf):
    u = lambda s, lo, hi: draws.between(lo, hi, 11, s, "vec_id")
    k = arrays.gaussian_kernel(21, u("sx", 0.2, 3), u("sy", 0.2, 3), u("theta", -3.14, 3.14))
    return images(spark, sf).select("vec_id", k.alias("kernel1"), draws.gate(0.8, 11, "sinc", "vec_id").alias("use_sinc"))


@query("prj_prefix_strip", "select event_id, case when event_id % 10 < 3 then value else value * 2 end as lq from events")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("value").alias("paired_lq"), (F.col("value") * 2).alias("otf_lq"))
    return e.select("event_id", F.when(F.col("event_id") % 10 < 3, F.col("paired_lq")).otherwise(F.col("otf_lq")).alias("lq"))


@query("chk_size_exclusive", "select p_partkey, case when p_size % 2 = 0 then p_size * 4 else (p_size * 4) // 4 * 4 end as gt_size, case when p_size % 2 = 0 then p_size else (p_size * 4) // 4 end as lq_size from part")
def _(spark, sf):
    s = F.col("p_size")
    given = table(spark, sf, "part").select("p_partkey", F.when(s % 2 == 0, s).alias("lq"), F.when(s % 2 != 0, s * 4).alias("gt"))
    both = F.when(F.col("lq").isNull() == F.col("gt").isNull(), F.raise_error(F.lit("exactly one size is needed")).cast("int"))
    return given.select("p_partkey", F.coalesce(both, F.col("gt"), F.col("lq") * 4).alias("gt_size"), F.coalesce("lq", F.floor(F.col("gt") / 4).cast("int")).alias("lq_size"))


@query("chk_low_count", "select lang, count(*) < 100 as low from documents group by 1")
def _(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg((F.count("*") < 100).alias("low"))


@query("join_video_pair", "select a.user_id, a.event_id, b.event_type from events a join events b on a.user_id = b.user_id and a.event_id = b.event_id where b.value > 10")
def _(spark, sf):
    e = table(spark, sf, "events")
    return pairing.pair(e.where("value > 10").select("user_id", "event_id", "event_type"), e.select("user_id", "event_id"), ["user_id", "event_id"]).select("user_id", "event_id", "event_type")


@query("agg_psnr_ssim_avg", f"select label, round(avg(10 * log10(1 / ({summed(zipped('(z[1] - z[2]) * (z[1] - z[2])'))} / 64))), 6) as psnr from {PAIR} group by label")
def _(spark, sf):
    return image_pairs(spark, sf).groupBy("label").agg(F.round(F.avg(arrays.psnr(F.col("p"), F.col("q"), 1.0)), 6).alias("psnr"))


_M, _V = (lambda a: f"({summed(a)} / 64)"), (lambda a: f"sqrt({summed(f'list_transform({a}, lambda x: x * x)')} / 64 - ({summed(a)} / 64) * ({summed(a)} / 64))")


@query("agg_correct_mean_var", f"select vec_id, round(list_max(list_transform(p, lambda x: (x - mp) / sp * sq + mq)), 6) as top from (select vec_id, p, {_M('p')} as mp, {_V('p')} as sp, {_M('q')} as mq, {_V('q')} as sq from {PAIR})")
def _(spark, sf):
    std = lambda c: F.sqrt(arrays.mean(F.transform(c, lambda x: x * x)) - arrays.mean(c) * arrays.mean(c))
    known = F.struct(arrays.mean(F.col("p")).alias("mp"), std(F.col("p")).alias("sp"), arrays.mean(F.col("q")).alias("mq"), std(F.col("q")).alias("sq"))
    matched = arrays.let(known, lambda k: F.transform("p", lambda x: (x - k["mp"]) / k["sp"] * k["sq"] + k["mq"]))
    return image_pairs(spark, sf).select("vec_id", F.round(F.array_max(matched), 6).alias("top"))


@query("win_clip_center", f"select user_id, start, clip[3] as centre from ({CLIP}) where len(clip) = 5")
def _(spark, sf):
    return fr.clips(frames(spark, sf), "user_id", ["ts", "event_id"], "event_id", 5).select("user_id", "start", "centre")


@query("win_tile_weights", "select y, round(sum(v * w) / greatest(sum(w), 1e-6), 6) as value from (select l_partkey % 97 as y, l_quantity as v, (1 + l_linenumber)::double as w from lineitem) group by y")
def _(spark, sf):
    t = table(spark, sf, "lineitem").select((F.col("l_partkey") % 97).alias("y"), F.col("l_quantity").alias("v"), (1 + F.col("l_linenumber")).cast("double").alias("w"))
    return t.groupBy("y").agg(F.round(F.sum(F.col("v") * F.col("w")) / F.greatest(F.sum("w"), F.lit(1e-6)), 6).alias("value"))


@query("win_ramp", "select p_partkey, array_to_string(list_transform(range(0, 2 * n), lambda i: least(i, 2 * n - 1 - i)), ',') as ramp from (select p_partkey, p_size % 6 + 1 as n from part)")
def _(spark, sf):
    n = F.col("p_size") % 6 + 1
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.transform(F.sequence(F.lit(0), 2 * n - 1), lambda i: F.least(i, 2 * n - 1 - i)), ",").alias("ramp"))


@query("ord_plot_single", "select p_partkey, p_size, (select min(p_size) - 1 from part) as low, (select max(p_size) + 1 from part) as high from part order by p_size desc, p_partkey limit 50")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    ends = p.agg((F.min("p_size") - 1).alias("low"), (F.max("p_size") + 1).alias("high"))
    return aggregates.top(p, [F.desc("p_size"), F.asc("p_partkey")], 50).crossJoin(F.broadcast(ends))


@query("ord_limit_images", f"select name from ({NAMES}) order by name limit 8")
def _(spark, sf):
    return aggregates.top(names(spark, sf).select("name"), [F.asc("name")], 8)


@query("set_sequence_concat", "select p_brand as name from part where p_size < 10 union all select p_type from part where p_size > 45")
def _(spark, sf):
    p = table(spark, sf, "part")
    return p.where("p_size < 10").select(F.col("p_brand").alias("name")).unionByName(p.where("p_size > 45").select(F.col("p_type").alias("name")))


@query("set_dict_merge", "select o_orderkey, o_custkey, c_name from orders left join customer on o_custkey = c_custkey")
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(c, "o_custkey", "left").select("o_orderkey", "o_custkey", "c_name")


@query("str_reds_key", "select page_id, split_part(url || '/0001.png', '.png', 1) as key from pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.split_part(F.concat("url", F.lit("/0001.png")), F.lit(".png"), F.lit(1)).alias("key"))


@query("str_bench_line", "select p_partkey, rpad(p_brand, 12, ' ') || lpad(case when p_size % 5 = 0 then '-' else p_size::varchar end, 8, ' ') as line from part")
def _(spark, sf):
    cell = F.when(F.col("p_size") % 5 == 0, "-").otherwise(F.col("p_size").cast("string"))
    return table(spark, sf, "part").select("p_partkey", F.concat(F.rpad("p_brand", 12, " "), F.lpad(cell, 8, " ")).alias("line"))


_yy, _bb, _rr = "(r * 255 - 16)", "(g * 255 - 128)", "(b * 255 - 128)"
_colour("col_ycbcr2bgr", ["b", "g", "r"], lambda y, cb, cr: colour.rgb601(y, cb, cr)[::-1], [clip(f"(1.164 * {_yy} + 2.017 * {_bb}) / 255"), clip(f"(1.164 * {_yy} - 0.392 * {_bb} - 0.813 * {_rr}) / 255"), clip(f"(1.164 * {_yy} + 1.596 * {_rr}) / 255")])
_colour("col_rgb2ycbcr_pt", ["y", "cb", "cr"], colour.ycbcr601, [Y, CB, CR])
_colour("col_rgb2pixelformat", ["y"], lambda r, g, b: (colour.luma601(r, g, b),), [Y])
_colour("num_chroma_swap", ["b2", "g2", "r2"], lambda r, g, b: (b, g, r), ["b", "g", "r"])
_colour("num_img2float32", ["x"], lambda r, g, b: (colour.clamp01(colour.to_uint8(r) / 255.0),), [clip(f"round_even({clip('r')} * 255, 0) / 255")])

_LUMA = f"(case when {LUM} <= 216.0 / 24389.0::double then {LUM} * (24389.0 / 27.0::double) else pow({LUM}, 1.0 / 3.0::double) * 116 - 16 end) / 100"
_LUMAS = lambda a: f"(select vec_id, i, {_LUMA} as l from ({PIXELS.format(a=a, source=PAIR)}))"


@query("LumaLoss", f"select vec_id, round(avg(abs(x.l - y.l)), 6) as value from {_LUMAS('p')} x join {_LUMAS('q')} y using (vec_id, i) group by vec_id")
def _(spark, sf):
    """Mean difference of the luma of all pixels."""
    p, q = (over_pixels(n, colour.luminance) for n in "pq")
    return image_pairs(spark, sf).select("vec_id", F.round(arrays.l1(p, q), 6).alias("value"))


@query("arr_uniform_crop", "select p_partkey, y, x from (select p_partkey, unnest(range(0, 64 + p_size - 32 + 1, 16)) as y, p_size from part), (select unnest(range(0, 33, 16)) as x)")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.explode(F.sequence(F.lit(0).cast("long"), (64 + F.col("p_size") - 32).cast("long"), F.lit(16).cast("long"))).alias("y"))
    return p.withColumn("x", F.explode(F.array(*[F.lit(x).cast("long") for x in (0, 16, 32)])))


@query("arr_augment")
def _(spark, sf):
    on = {s: draws.gate(0.5, 13, s, "vec_id") for s in ("h", "v", "t")}
    step = lambda df, s, f: df.withColumn("p", F.when(on[s], f(F.col("p"), 8, 8)).otherwise(F.col("p")))
    df = images(spark, sf)
    for s, f in (("h", arrays.hflip), ("v", arrays.vflip), ("t", arrays.transpose)):
        df = step(df, s, f)
    return df.select("vec_id", *_digest(F.col("p")))


@query("arr_random_crop_single")
def _(spark, sf):
    y, x = (F.floor(draws.uniform(17, s, "vec_id") * 5).cast("int") for s in ("top", "left"))
    placed = images(spark, sf).withColumn("y", y).withColumn("x", x)
    return placed.select("vec_id", "y", "x", *_digest(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.element_at("p", ((F.floor(i / 4) + F.col("y")) * 8 + i % 4 + F.col("x") + 1).cast("int")))))


@query("ker_sigma", "select p_partkey, round(cos(t) * cos(t) * sx * sx + sin(t) * sin(t) * sy * sy, 6) as xx, round(cos(t) * sin(t) * (sx * sx - sy * sy), 6) as xy, round(sin(t) * sin(t) * sx * sx + cos(t) * cos(t) * sy * sy, 6) as yy from (select p_partkey, 0.5::double + p_size / 20.0::double as sx, 0.8::double as sy, p_size / 10.0::double as t from part)")
def _(spark, sf):
    s = F.col("p_size").cast("double")
    sx, sy, c, d = (0.5 + s / 20.0) * (0.5 + s / 20.0), F.lit(0.8) * 0.8, F.cos(s / 10.0), F.sin(s / 10.0)
    return table(spark, sf, "part").select("p_partkey", F.round(c * c * sx + d * d * sy, 6).alias("xx"), F.round(c * d * (sx - sy), 6).alias("xy"), F.round(d * d * sx + c * c * sy, 6).alias("yy"))


@query("ker_grid", "select y, x from (select unnest(range(-10, 11)) as y), (select unnest(range(-10, 11)) as x)")
def _(spark, sf):
    return spark.range(-10, 11).select(F.col("id").alias("y"), F.explode(F.sequence(F.lit(-10).cast("long"), F.lit(10).cast("long"))).alias("x"))


@query("ker_mixed")
def _(spark, sf):
    kinds = [("iso", 0.45), ("aniso", 0.25), ("generalized_iso", 0.12), ("generalized_aniso", 0.03), ("plateau_iso", 0.12), ("plateau_aniso", 0.03)]
    u = lambda s, lo, hi: draws.between(lo, hi, 19, s, "p_partkey")
    chosen = table(spark, sf, "part").select("p_partkey", draws.choice(kinds, draws.uniform(19, "kind", "p_partkey")).alias("kind"), u("sx", 0.2, 3).alias("sx"), u("sy", 0.2, 3).alias("sy"), u("t", -3.14, 3.14).alias("t"), u("beta", 0.5, 4).alias("beta"))
    iso = F.col("kind").endswith("iso") & ~F.col("kind").endswith("aniso")
    sy, t = F.when(iso, F.col("sx")).otherwise(F.col("sy")), F.when(iso, 0.0).otherwise(F.col("t"))
    made = F.when(F.col("kind").startswith("plateau"), arrays.gaussian_kernel(7, F.col("sx"), sy, t, F.col("beta"), True)).when(F.col("kind").startswith("gen"), arrays.gaussian_kernel(7, F.col("sx"), sy, t, F.col("beta"))).otherwise(arrays.gaussian_kernel(7, F.col("sx"), sy, t))
    return chosen.select("p_partkey", "kind", made.alias("k")).select("p_partkey", "kind", F.round(arrays.total(F.col("k")), 6).alias("total"))


@query("smp_worker_seed", "select event_id, 8 * (event_id % 4) + event_id % 8 + 1234 as seed from events")
def _(spark, sf):
    i = F.col("event_id")
    return table(spark, sf, "events").select("event_id", (8 * (i % 4) + i % 8 + 1234).alias("seed"))


@query("smp_source_mix")
def _(spark, sf):
    batch = F.floor(F.col("event_id") / 16)
    return table(spark, sf, "events").select("event_id", F.when(draws.gate(0.3, 23, "source", batch), "paired").otherwise("otf").alias("source"))


def _mixed(spark, sf):
    rows = images(spark, sf).withColumn("batch", F.floor(F.col("vec_id") / 10))
    return batch_augment.joined(batch_augment.partners(rows, "batch", "vec_id", 29), "batch", "vec_id", "p")


@query("aug_cutmix")
def _(spark, sf):
    m = _mixed(spark, sf)
    return m.select("vec_id", "partner", *_digest(batch_augment.boxed(F.col("p"), F.col("other"), 8, *batch_augment.box(8, 8, 0.6, 29, F.col("batch")))))


@query("aug_cutblur")
def _(spark, sf):
    rows = images(spark, sf).withColumn("batch", F.floor(F.col("vec_id") / 10))
    return rows.select("vec_id", *_digest(batch_augment.cutblur(F.col("p"), 8, 8, 2, *batch_augment.box(8, 8, 0.6, 31, F.col("batch")))))


@query("aug_moa")
def _(spark, sf):
    m = _mixed(spark, sf)
    kind = draws.choice([("mixup", 0.3), ("cutmix", 0.3), ("none", 0.4)], draws.uniform(37, "moa", "batch"))
    out = F.when(F.col("kind") == "mixup", arrays.mix(F.col("p"), F.col("other"), 0.5)).when(F.col("kind") == "cutmix", batch_augment.boxed(F.col("p"), F.col("other"), 8, *batch_augment.box(8, 8, 0.6, 37, F.col("batch")))).otherwise(F.col("p"))
    return m.withColumn("kind", kind).select("vec_id", "kind", *_digest(out))


def _pairs16(spark, sf, rgb: bool = False):
    four = lambda c: F.concat(*[F.concat(F.slice(c, k * 8 + 1, 8), F.slice(c, k * 8 + 1, 8)) for k in range(8)] * 2)
    planes = (lambda c: F.concat(four(c), F.reverse(four(c)), four(c))) if rgb else four
    return image_pairs(spark, sf).select("vec_id", F.lit(3 if rgb else 1).alias("c"), F.lit(16).alias("h"), F.lit(16).alias("w"), planes("p").alias("lq"), planes("q").alias("gt"))


for _name in spectral.LOSSES:

    def _loss(spark, sf, name=_name):
        return spectral.pair_losses(_pairs16(spark, sf, name in spectral.RGB), "vec_id", [name]).withColumnRenamed(name, "value")

    query(_name)(_loss)
