"""Losses, metrics and datasets by the type that options name, and the queries that show them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.functions import arrays, draws
from pairloom.operators import frames as fr, options
from pairloom.operators.registry import Registry
from pairloom.plans.base import IMG, PAIR, image_pairs, images, query
from pairloom.plans.files import _DATA, _folder
from pairloom.sources import image_files, manifests
from pairloom.sources.manifests import table

LOSSES, METRICS, DATASETS = (Registry(n) for n in ("losses", "metrics", "datasets"))


def _loss(name: str):
    def add(fn):
        fn.__name__ = name
        return LOSSES.register(fn)

    return add


@_loss("L1Loss")
def _(a: Column, b: Column, loss_weight: float = 1.0) -> Column:
    return arrays.l1(a, b) * loss_weight


@_loss("MSELoss")
def _(a: Column, b: Column, loss_weight: float = 1.0) -> Column:
    return arrays.mse(a, b) * loss_weight


@_loss("CharbonnierLoss")
def _(a: Column, b: Column, loss_weight: float = 1.0, eps: float = 1e-12) -> Column:
    return arrays.charbonnier(a, b, eps) * loss_weight


@_loss("HuberLoss")
def _(a: Column, b: Column, loss_weight: float = 1.0, delta: float = 1.0) -> Column:
    return arrays.huber(a, b, delta) * loss_weight


@_loss("GANLoss")
def _(a: Column, b: Column, gan_type: str = "vanilla", real: bool = True, loss_weight: float = 1.0) -> Column:
    """a: scores; b is not looked at."""
    return arrays.gan_loss(a, gan_type, real) * loss_weight


def built_loss(a: Column, b: Column, given: dict) -> Column:
    """The loss that given["type"] names, in any case, with the other options; a GAN of type r3gan is R3GANLoss. An unknown option is a TypeError."""
    more = {k: v for k, v in given.items() if k != "type"}
    kind = given["type"]
    if kind.lower() == "ganloss" and str(more.get("gan_type", "")).lower() == "r3gan":
        kind = "R3GANLoss"
    return LOSSES.get(kind)(a, b, **more)


def _inside(pixels: Column, size: int, border: int) -> Column:
    return arrays.crop_border(pixels, size, size, border) if border else pixels


@METRICS.register
def calculate_psnr(a: Column, b: Column, size: int, crop_border: int = 0) -> Column:
    return arrays.psnr(_inside(a, size, crop_border), _inside(b, size, crop_border), 1.0)


@METRICS.register
def calculate_psnr_pt(a: Column, b: Column, size: int, crop_border: int = 0) -> Column:
    return arrays.psnr_unit(_inside(a, size, crop_border), _inside(b, size, crop_border))


def calculated(a: Column, b: Column, size: int, given: dict) -> Column:
    """The metric that given["type"] names, of square images of one channel."""
    return METRICS.get(given["type"])(a, b, size, **{k: v for k, v in given.items() if k != "type"})


@DATASETS.register
def singleimagedataset(spark: SparkSession, root: str, mean: list[float] | None = None, std: list[float] | None = None) -> DataFrame:
    return image_files.single_images(spark, root, mean=mean, std=std)


@DATASETS.register
def pairedimagedataset(spark: SparkSession, root: str, gt_root: str, scale: int = 4) -> DataFrame:
    names = [manifests.listing(spark, p, ".png").select(F.col("rel_path").alias("name")) for p in (root, gt_root)]
    return image_files.paired_images(names[0].join(names[1], "name"), root, gt_root, scale)


@DATASETS.register
def singlevideodataset(spark: SparkSession, root: str, clip_size: int = 5) -> DataFrame:
    return image_files.video_clips(spark, root, clip_size)


def built_dataset(spark: SparkSession, given: dict) -> DataFrame:
    return DATASETS.get(given["type"])(spark, **{k: v for k, v in given.items() if k != "type"})


def _rows(df: DataFrame, given: dict[str, Column], *keys: str) -> DataFrame:
    """One row a label."""
    return df.select(*keys, F.explode(F.array(*[F.struct(F.lit(k).alias("label"), F.round(v, 6).alias("value")) for k, v in given.items()])).alias("e")).select(*keys, "e.*")


_D = lambda f, p="p", q="q": f"list_avg(list_transform(list_zip({p}, {q}), lambda z: {f}))"
_CENTRE = lambda a: f"list_transform(range(0, 36), lambda k: {a}[(k // 6 + 1) * 8 + k % 6 + 2])"
_SQ = "(z[1] - z[2]) * (z[1] - z[2])"
_MSE, _MSE2 = _D(_SQ), _D(_SQ, _CENTRE("p"), _CENTRE("q"))


@query("reg_loss", f"select vec_id, unnest(['a', 'b', 'c', 'd']) as label, round(unnest([{_D('abs(z[1] - z[2])')} * 0.5::double, {_D('sqrt(' + _SQ + ' + 1e-6)')}, {_D('case when abs(z[1] - z[2]) < 0.1::double then 0.5::double * ' + _SQ + ' else 0.1::double * (abs(z[1] - z[2]) - 0.05::double) end')}, {_D('greatest(0, 1 - z[1])')} * 2]), 6) as value from {PAIR}")
def _(spark, sf):
    """Losses as options name them."""
    given = {"a": {"type": "l1loss", "loss_weight": 0.5}, "b": {"type": "CharbonnierLoss", "eps": 1e-6}, "c": {"type": "HuberLoss", "delta": 0.1}, "d": {"type": "ganloss", "gan_type": "hinge", "loss_weight": 2.0}}
    return _rows(image_pairs(spark, sf), {k: built_loss(F.col("p"), F.col("q"), v) for k, v in given.items()}, "vec_id")


@query("met_dispatch", f"select vec_id, unnest(['psnr', 'psnr_inner', 'psnr_pt']) as label, round(unnest([10 * log10(1 / {_MSE}), 10 * log10(1 / {_MSE2}), 10 * log10(1 / ({_MSE} + 1e-8))]), 6) as value from {PAIR}")
def _(spark, sf):
    """Metrics as options name them."""
    given = {"psnr": {"type": "calculate_psnr"}, "psnr_inner": {"type": "calculate_psnr", "crop_border": 1}, "psnr_pt": {"type": "calculate_psnr_pt"}}
    return _rows(image_pairs(spark, sf), {k: calculated(F.col("p"), F.col("q"), 8, v) for k, v in given.items()}, "vec_id")


@query("reg_dataset", f"select 'single' as dataset, label || '/' || vec_id || '.png' as item, a[1]::int as first from {_DATA} union all select 'paired', label || '/' || vec_id || '.png', a[1]::int from {_DATA}")
def _(spark, sf):
    """Datasets as options name them, over one folder."""
    root = _folder(spark, sf)
    first = lambda c: F.round(F.get(c, F.lit(0)) * 255).cast("int").alias("first")
    one = built_dataset(spark, {"type": "SingleImageDataset", "root": root}).select(F.lit("single").alias("dataset"), F.col("name").alias("item"), first("data"))
    two = built_dataset(spark, {"type": "PairedImageDataset", "root": root, "gt_root": root, "scale": 1}).select(F.lit("paired").alias("dataset"), F.col("name").alias("item"), first("gt.data"))
    return one.union(two)


@query("opt_schema", "select * from (values ('CharbonnierLoss', 'eps', 'double', true), ('CharbonnierLoss', 'loss_weight', 'double', true), ('GANLoss', 'gan_type', 'string', true), ('GANLoss', 'loss_weight', 'double', true), ('GANLoss', 'real', 'boolean', true), ('HuberLoss', 'delta', 'double', true), ('HuberLoss', 'loss_weight', 'double', true), ('L1Loss', 'loss_weight', 'double', true), ('MSELoss', 'loss_weight', 'double', true)) t(name, field, type, optional)")
def _(spark, sf):
    """Options of each loss as fields; columns are no options."""
    rows = [(fn.__name__, f.name, f.dataType.simpleString(), f.nullable) for fn in LOSSES.items.values() for f in options.schema(fn)]
    return spark.createDataFrame(rows, "name string, field string, type string, optional boolean")


_CELLS = "list_transform(range(0, 49), lambda i: {})"
_X, _Y = "(i % 7 - 3)", "(i // 7 - 3)"
_WEIGHED = lambda e: f"round(list_sum(list_transform({e}, lambda x, i: x * i)), 6)"


@query("ker_pdf", f"select p_partkey, {_WEIGHED(_CELLS.format(f'exp(-0.5::double * (4 * {_X} * {_X} - 1.0::double * {_X} * {_Y} + s * {_Y} * {_Y}) / (4 * s - 0.25::double))'))} as digest from (select p_partkey, (1 + p_size)::double as s from part)")
def _(spark, sf):
    """A density that is not normalised, of a covariance by the part's size."""
    k = arrays.gaussian_density(7, 1.0 + F.col("p_size"), F.lit(0.5), F.lit(4.0))
    return table(spark, sf, "part").select("p_partkey", F.round(arrays.total(F.transform(k, lambda x, i: x * (i + 1))), 6).alias("digest"))


_LINE = _CELLS.format(f"case when abs({_Y} * cos(radians(a)) + {_X} * sin(radians(a))) < 0.5 then 1.0::double else 0 end")


@query("ker_motion", f"select p_partkey, {_WEIGHED('list_transform(k, lambda x: x / list_sum(k))')} as digest from (select p_partkey, {_LINE} as k from (select p_partkey, (7 * p_size + 1)::double as a from part))")
def _(spark, sf):
    """A line at an angle by the part's size."""
    k = arrays.motion_kernel(7, (7 * F.col("p_size") + 1).cast("double"))
    return table(spark, sf, "part").select("p_partkey", F.round(arrays.total(F.transform(k, lambda x, i: x * (i + 1))), 6).alias("digest"))


_CELL = lambda r, c: f"(case when {r} between 0 and 7 and {c} between 0 and 7 then p[({r}) * 8 + {c} + 1] else 0 end)"
_TURNED = f"""select vec_id, round(sum((i + 1) * (({_CELL('t', 'l')} * (1 - fx) + {_CELL('t', 'l + 1')} * fx) * (1 - fy) + ({_CELL('t + 1', 'l')} * (1 - fx) + {_CELL('t + 1', 'l + 1')} * fx) * fy)), 5) as digest
from (select vec_id, p, i, floor(sx)::int as l, floor(sy)::int as t, sx - floor(sx) as fx, sy - floor(sy) as fy
from (select vec_id, p, i, (cos(a) * (i % 8 - 4) - sin(a) * (i // 8 - 4)) / 1.5::double + 4 as sx, (sin(a) * (i % 8 - 4) + cos(a) * (i // 8 - 4)) / 1.5::double + 4 as sy
from (select vec_id, p, radians((vec_id * 7 % 360 + 0.5)::double) as a, unnest(range(0, 64)) as i from {IMG}))) group by vec_id"""


@query("arr_rotate", _TURNED)
def _(spark, sf):
    """By an angle of each image's own, half as large again."""
    turned = arrays.rotated(F.col("p"), 8, 8, (F.col("vec_id") * 7 % 360 + 0.5).cast("double"), 1.5)
    return images(spark, sf).select("vec_id", F.round(arrays.total(F.transform(turned, lambda x, i: x * (i + 1))), 5).alias("digest"))


@query("flt_threshold_drop", "select p_partkey, (h - 16) // 12 + 1 as fit, (h - 16) % 12 > 4 as last_kept, (h - 16) // 12 + 1 + ((h - 16) % 12 > 4)::int as n from (select p_partkey, 16 + p_size as h from part)")
def _(spark, sf):
    """Tiles that fit, and whether what they leave uncovered is worth one more."""
    h = 16 + F.col("p_size")
    n, plain = (F.size(fr.tile_origins(h, 16, 12, t)).cast("long") for t in (4, 1 << 30))
    return table(spark, sf, "part").select("p_partkey", plain.alias("fit"), (n > plain).alias("last_kept"), n.alias("n"))


@query("agg_enlarge_auto", "select source, count(*) as n, greatest(2000 * 16 // count(*), 1) as ratio from documents group by source")
def _(spark, sf):
    """How often each set is gone through in one epoch of at least 2,000 batches of 16."""
    n = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return n.select("source", "n", F.greatest(F.floor(F.lit(2000 * 16) / F.col("n")), F.lit(1)).cast("long").alias("ratio"))


_TEXT = "case event_id % 5 when 0 then '{\"a\": ' || user_id when 1 then '[1, {\"b\": null}, ' || user_id || ']' when 2 then '\"' || event_type || '\"' when 3 then '{\"a\": [true, 1.5]}' else event_type end"


@query("flt_json_compatible", f"select event_id, json_valid({_TEXT}) as ok from events")
def _(spark, sf):
    """Whether a text is a JSON value all through."""
    return table(spark, sf, "events").select("event_id", F.try_parse_json(F.expr(_TEXT.replace("\\", "\\\\"))).isNotNull().alias("ok"))


_RUNS = "case when first < 41.67::double then 500 when first < 500 then 10 else 5 end"


@query("agg_timing", f"select user_id, min(runs)::int as runs, count(*) as n, round(sum(value) / (count(*) * 1000), 9) as mean_s, max(value) as peak from (select *, {_RUNS} as runs from (select *, row_number() over w as k, first_value(value) over w as first from (select * from events where event_id % 11 <> 0) window w as (partition by user_id order by ts, event_id))) where k > 1 and k <= runs + 1 group by user_id")
def _(spark, sf):
    """The first time of each user decides how many of the next are averaged; values are milliseconds."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf, "events").where("event_id % 11 != 0").select("user_id", "value", F.row_number().over(w).alias("k"), F.first("value").over(w).alias("first"))
    rows = rows.where("k <= 501")  # a limit that Spark applies to each group before the shuffle
    runs = F.when(F.col("first") < 41.67, 500).when(F.col("first") < 500, 10).otherwise(5)
    kept = rows.withColumn("runs", runs).where((F.col("k") > 1) & (F.col("k") <= F.col("runs") + 1))
    return kept.groupBy("user_id").agg(F.min("runs").alias("runs"), F.count("*").alias("n"), F.round(F.sum("value") / (F.count("*") * 1000), 9).alias("mean_s"), F.max("value").alias("peak"))


@query("smp_gate")
def _(spark, sf):
    """One draw a batch of 32: all its rows pass a step of chance 0.4, or none."""
    batch = F.floor(F.col("vec_id") / 32)
    return images(spark, sf).select("vec_id", batch.alias("batch"), draws.gate(0.4, 89, "gate", batch).alias("on"))
