"""Pairing joins and their integrity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pair(lq: DataFrame, gt: DataFrame, on: list[str]) -> DataFrame:
    """Inner join on the keys."""
    return gt.join(lq, on)


def presence(lq: DataFrame, gt: DataFrame, on: list[str]) -> DataFrame:
    """Each key of either side and whether it is in both, lq_only or gt_only: one shuffle for the pairing and both checks."""
    left = lq.select(*on).distinct().withColumn("in_lq", F.lit(True))
    right = gt.select(*on).distinct().withColumn("in_gt", F.lit(True))
    side = F.when(F.col("in_lq").isNull(), "gt_only").when(F.col("in_gt").isNull(), "lq_only").otherwise("both")
    return left.join(right, on, "full_outer").select(*on, side.alias("side"))


def missing_report(lq: DataFrame, gt: DataFrame, key: str, examples: int = 10) -> DataFrame:
    """How many keys of lq have no ground truth, and the smallest of them: one row, none is collected."""
    gone = lq.join(gt, key, "left_anti").select(F.col(key).cast("string").alias("name"))
    first = gone.orderBy("name").limit(examples)
    return gone.agg(F.count("*").alias("n_missing")).crossJoin(first.agg(F.array_join(F.array_sort(F.collect_list("name")), ",").alias("examples")))


def pair_counts(lq: DataFrame, gt: DataFrame, by: str) -> DataFrame:
    a, b = (x.groupBy(by).agg(F.count("*").alias(n)) for x, n in ((lq, "n_lq"), (gt, "n_gt")))
    both = a.join(b, by, "full_outer").fillna(0, ["n_lq", "n_gt"])
    return both.withColumn("ok", F.col("n_lq") == F.col("n_gt"))


def scale_check(pairs: DataFrame, scale: int, patch: int) -> DataFrame:
    """Sizes are columns, so no pixel is decoded: ok if ground truth is scale times the input and the input holds a patch."""
    exact = (F.col("gt_h") == F.col("lq_h") * scale) & (F.col("gt_w") == F.col("lq_w") * scale)
    return pairs.withColumn("ok", exact & (F.least("lq_h", "lq_w") >= patch))


def positional(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """The i-th row of one side with the i-th of the other; both orders must be total."""
    return numbered(left, left_order).join(numbered(right, right_order), "ordinal")


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """ordinal (from 0) in a total order, without putting all rows in one task: range-sorted parts, and each part's offset."""
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    # range bounds come from a sample, so both uses below must see the same cut, also after an executor is lost
    cut = settled(df.repartitionByRange(int(parts), *order).withColumn("_part", F.spark_partition_id()))
    sized = cut.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sized.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_start")
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return cut.withColumn("_k", within).join(F.broadcast(starts), "_part").withColumn("ordinal", F.col("_k") + F.col("_start")).drop("_part", "_k", "_start")


def settled(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a checkpoint in the folder that the cluster shares."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or f"{df.sparkSession.conf.get('spark.sql.warehouse.dir')}/.checkpoints")
    return df.checkpoint()


def first_root(paths: DataFrame, roots: list[str], path: str = "path") -> DataFrame:
    """root: the first of the given roots that is a proper prefix of each path; null where none is. Repeated paths stay rows of their own."""
    out = F.coalesce(*[F.when(F.col(path).startswith(root + "/"), root) for root in roots]) if roots else F.lit(None).cast("string")
    return paths.withColumn("root", out)


def template_diff(user: DataFrame, template: DataFrame) -> DataFrame:
    """path and value of two flattened option trees: paths whose values differ, or that only one has."""
    joined = user.select("path", F.col("value").alias("user_value")).join(template.select("path", F.col("value").alias("template_value")), "path", "full_outer")
    return joined.where(~F.col("user_value").eqNullSafe(F.col("template_value")))


def lookup(rows: DataFrame, facts: DataFrame, on: list[str], value: str, missing: str = "-") -> DataFrame:
    return rows.join(facts, on, "left").withColumn(value, F.coalesce(F.col(value).cast("string"), F.lit(missing)))


def template_name(template: str, basename: Column, ext: Column) -> Column:
    return F.concat(F.replace(F.lit(template), F.lit("{}"), basename), ext)
