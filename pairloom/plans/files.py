"""Queries that write the test tables' images as files or stores and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairloom.functions import arrays
from pairloom.plans.base import IMG, images, query
from pairloom.plans.engine import _coloured
from pairloom.sources import image_files as files, manifests

# One image: 8 x 8 of three channels, the second one reversed, in steps of 1/255.
_Q = "list_transform({}, lambda x: greatest(0, least(255, round_even(x * 255, 0)))::int)"
_DATA = f"(select vec_id, label, {_Q.format('list_concat(p, list_reverse(p), p)')} as a from {IMG})"
_SUM = "list_sum(list_transform({}, lambda x, i: x * i))::bigint"
_NAME = "label || '/' || vec_id || '.png'"


def _named(spark, sf, name=None):
    """Image rows named label/vec_id.png."""
    label = images(spark, sf).select("vec_id", "label")
    name = F.concat_ws("/", F.col("label").cast("string"), F.concat(F.col("vec_id").cast("string"), F.lit(".png"))) if name is None else name
    return _coloured(spark, sf).join(label, "vec_id").withColumn("name", name)


def _digest(data, peak: int = 255):
    """Place-weighted sum of the stored values."""
    return arrays.total(F.transform(data, lambda x, i: F.round(x * peak) * (i + 1))).cast("long").alias("digest")


def _folder(spark, sf) -> str:
    path = files.scratch(spark, "images")
    files.write_images(_named(spark, sf), path)
    return path


@query("sink_png_worker", f"select vec_id::varchar as key, 3 as c, 8 as h, 8 as w, {_SUM.format('a')} as digest from {_DATA}")
def _(spark, sf):
    """Key, size and PNG of each image; the PNG by what it decodes to."""
    coded = files.encode(_coloured(spark, sf).select(F.col("vec_id").cast("string").alias("key"), "c", "h", "w", "data"))
    return files.decode(coded.select("key", "content"), flag="unchanged").select("key", "c", "h", "w", _digest(F.col("data")))


_LUMA = "list_transform(range(1, 65), lambda i: (a[i] * 4899 + a[64 + i] * 9617 + a[128 + i] * 1868 + 8192) >> 14)"


@query("src_decode_bytes", f"select vec_id, flag, case when flag = 'grayscale' then 1 else 3 end as c, case when flag = 'grayscale' then {_SUM.format(_LUMA)} else {_SUM.format('a')} end as digest from {_DATA}, (values ('color'), ('grayscale'), ('unchanged')) f(flag)")
def _(spark, sf):
    """Each image's bytes decoded in the three ways."""
    coded = files.encode(_coloured(spark, sf)).select("vec_id", "content")
    ways = [files.decode(coded, flag=f).select("vec_id", F.lit(f).alias("flag"), "c", _digest(F.col("data"))) for f in ("color", "grayscale", "unchanged")]
    return ways[0].union(ways[1]).union(ways[2])


@query("src_disk_backend", "select doc_id, sha256(text) as sha256, octet_length(encode(text)) as n from documents")
def _(spark, sf):
    """The bytes of files, each asked for by its name."""
    path = files.scratch(spark, "texts")
    docs = manifests.table(spark, sf, "documents").where("text is not null").select("doc_id", F.concat_ws("/", F.col("doc_id").cast("string"), F.lit("text")).alias("name"), F.encode("text", "UTF-8").alias("content"))
    files.write_files(docs, path)
    found = files.lookup("disk", docs.select("doc_id", "name"), path)
    return found.select("doc_id", F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("n"))


_ASKED = "select vec_id + 250 as vec_id from embeddings"


def _store(spark, sf) -> str:
    path = files.scratch(spark, "store")
    files.image_store(_coloured(spark, sf).select(F.col("vec_id").cast("string").alias("key"), "c", "h", "w", "data"), path)
    return path


def _looked_up(spark, sf, backend: str):
    if backend == "disk":
        path = files.scratch(spark, "images")
        files.write_images(_named(spark, sf, F.col("vec_id").cast("string")), path)
    else:
        path = _store(spark, sf)
    asked = images(spark, sf).select((F.col("vec_id") + 250).alias("vec_id"))
    found = files.lookup(backend, asked.withColumn("name", F.col("vec_id").cast("string")), path)
    return files.decode(found.select("vec_id", "content"), strict=False).select("vec_id", F.lit(backend).alias("backend"), "c", _digest(F.col("data")))


_BACKEND = f"select k.vec_id, {{}} as backend, case when a is not null then 3 end as c, {_SUM.format('a')} as digest from ({_ASKED}) k left join {_DATA} d on d.vec_id = k.vec_id"


@query("src_lmdb_backend", _BACKEND.format("'lmdb'"))
def _(spark, sf):
    """Values of a store by key; half of the keys that are asked for may be missing."""
    return _looked_up(spark, sf, "lmdb")


@query("src_file_client", f"{_BACKEND.format(chr(39) + 'lmdb' + chr(39))} union all {_BACKEND.format(chr(39) + 'disk' + chr(39))}")
def _(spark, sf):
    """The same keys by both backends."""
    return _looked_up(spark, sf, "lmdb").union(_looked_up(spark, sf, "disk"))


@query("sink_lmdb_build", f"select vec_id || '.png (8,8,3) 1' as line, vec_id::varchar as key, {_SUM.format('a')} as digest from {_DATA}")
def _(spark, sf):
    """The lines of a store's manifest, each with its image."""
    path = _store(spark, sf)
    lines = spark.read.text(f"{path}/meta_info").select(F.col("value").alias("line"), F.split_part("value", F.lit("."), F.lit(1)).alias("key"))
    found = manifests.read_store(spark, path, lines)
    return files.decode(found.withColumnRenamed("value", "content")).select("line", "key", _digest(F.col("data")))


@query("sink_imwrite", f"select {_NAME} as name, 8 as h, 8 as w, 3 as c from {_DATA}")
def _(spark, sf):
    """Files by label, read by Spark's own decoder."""
    path = _folder(spark, sf)
    tail = F.substring_index("path", "/", -2).alias("name")
    return files.read_images(spark, path).select(tail, "h", "w", "c")


@query("src_folder_paths", "select vec_id || '.png' as name from embeddings where label = 1")
def _(spark, sf):
    """The files of one folder itself."""
    path = _folder(spark, sf)
    return files.folder_paths(spark, f"{path}/1").select(F.substring_index("path", "/", -1).alias("name"))


_NORMAL = "list_transform(range(1, 193), lambda i: round((a[i] / 255.0::double - (case when i <= 64 then 0.4 when i <= 128 then 0.5 else 0.6 end)::double) / 0.25::double * 1000)::bigint * i)"


@query("src_single_image", f"select {_NAME} as name, 3 as c, 8 as h, 8 as w, list_sum({_NORMAL})::bigint as digest from {_DATA}")
def _(spark, sf):
    """Decoded files of a folder and those below it, normalised by channel."""
    rows = files.single_images(spark, _folder(spark, sf), mean=[0.4, 0.5, 0.6], std=[0.25] * 3)
    return rows.select("name", "c", "h", "w", _digest(F.col("data"), 1000))


# The input is the first 3 x 3 of each channel; the ground truth, twice as large and more, is trimmed to 6 x 6.
_PART = lambda n: f"list_transform(range(0, {3 * n * n}), lambda k: a[k // {n * n} * 64 + k % {n * n} // {n} * 8 + k % {n} + 1])"


@query("src_paired_image", f"select {_NAME} as name, {_SUM.format(_PART(3))} as lq, 6 as gt_h, 6 as gt_w, {_SUM.format(_PART(6))} as gt from {_DATA}")
def _(spark, sf):
    """Two folders paired by name, the ground truth trimmed to the input's size times 2."""
    gt, lq = _folder(spark, sf), files.scratch(spark, "inputs")
    small = _named(spark, sf).withColumn("data", F.filter("data", lambda x, i: (i % 8 < 3) & (i % 64 < 24))).withColumn("h", F.lit(3)).withColumn("w", F.lit(3))
    files.write_images(small, lq)
    names = [manifests.listing(spark, p, ".png").select(F.col("rel_path").alias("name")) for p in (lq, gt)]
    both = files.paired_images(names[0].join(names[1], "name"), lq, gt, 2)
    return both.select("name", _digest(F.col("lq.data")).alias("lq"), F.col("gt.h").alias("gt_h"), F.col("gt.w").alias("gt_w"), _digest(F.col("gt.data")).alias("gt"))


@query(
    "src_single_video",
    f"""select label::varchar as scene, row_number() over w - 1 as start, 3 as n, {_SUM.format('a')} + {_SUM.format('b')} + {_SUM.format('c')} + 192 * (list_sum(b) + 2 * list_sum(c))::bigint as digest
    from (select *, lead(a) over v as b, lead(a, 2) over v as c from {_DATA} window v as (partition by label order by vec_id)) where c is not null window w as (partition by label order by vec_id)""",
)
def _(spark, sf):
    """Clips of three frames a label."""
    path = files.scratch(spark, "frames")
    files.write_images(_named(spark, sf, F.format_string("%d/%d_%08d.png", F.col("label"), F.col("label"), F.col("vec_id"))), path)
    return files.video_clips(spark, path, 3).select("scene", "start", "n", _digest(F.col("data")))


_TILES = "(values (1, 0, 0), (2, 0, 3), (3, 0, 4), (4, 3, 0), (5, 3, 3), (6, 3, 4), (7, 4, 0), (8, 4, 3), (9, 4, 4)) t(k, y, x)"
_TILE = "list_transform(range(0, 48), lambda i: a[i // 16 * 64 + (y + i % 16 // 4) * 8 + x + i % 4 + 1])"


@query("sink_subimages", f"select 'a' || vec_id || '_s00' || k || '.png' as name, {_SUM.format(_TILE)} as digest from {_DATA}, {_TILES}")
def _(spark, sf):
    """Tiles of 4 x 4 at steps of 3, and the last full ones, as files."""
    path, named = files.scratch(spark, "tiles"), _named(spark, sf, F.concat(F.lit("ax2"), F.col("vec_id").cast("string"), F.lit(".png")))
    files.write_images(files.sub_images(named, 4, 3, 0), path)
    return files.single_images(spark, path).select("name", _digest(F.col("data")))
