"""Layouts, drawn strengths, crops of lists, texts of options and spans of time."""

from __future__ import annotations

import datetime

import duckdb
import numpy as np
import pytest
from pairloom.functions import arrays, strings
from pairloom.operators import images, registry
from pairloom.plans.base import image_pairs
from pairloom.plans.catalog import ORACLE, QUERIES
from pyspark.sql import functions as F


def test_layouts(spark):
    x = np.arange(24.0)
    p = F.array(*[F.lit(v) for v in x.tolist()])
    got = spark.range(1).select(arrays.channels_last(p, 4).alias("a"), arrays.to_three(p, F.lit(4)).alias("b"), arrays.to_three(p, F.lit(3)).alias("c"), arrays.to_three(F.slice(p, 1, 2), F.lit(1)).alias("d")).first()
    assert got.a == x.reshape(4, 6).T.ravel().tolist() and got.b == x.reshape(6, 4)[:, :3].ravel().tolist() and got.c == x.tolist() and got.d == [0, 0, 0, 1, 1, 1]
    with pytest.raises(Exception, match="one channel"):
        spark.range(1).select(arrays.to_three(p, F.lit(2))).collect()
    with pytest.raises(ValueError):
        arrays.turned(p, 4, 6, F.lit(True), F.lit(True), F.lit(True))


def test_crops_of_lists(spark, sf):
    whole = {r.vec_id: (np.reshape(r.p, (8, 8)), np.reshape(r.q, (8, 8))) for r in image_pairs(spark, sf).collect()}
    rows = QUERIES["arr_random_crop_list"](spark, sf).collect()
    places = {}
    for r in rows:
        assert r.patch == whole[r.vec_id][r.k][r.top : r.top + 4, r.left : r.left + 4].ravel().tolist()
        places.setdefault(r.vec_id, set()).add((r.top, r.left))
    assert len(rows) == 2 * len(whole) and any(len(v) == 2 for v in places.values())


def test_drawn_strengths(spark, sf):
    whole = {r.vec_id: np.array([r.p, r.p[::-1], r.p]).reshape(3, 8, 8) for r in image_pairs(spark, sf).collect()}
    for r in QUERIES["deg_jpeg_rand"](spark, sf).collect():
        if r.vec_id in whole:
            assert 75 <= r.quality < 95 and r.data == pytest.approx(images.jpeg(whole[r.vec_id], r.quality).ravel(), abs=1e-6)
    strength = {r.vec_id: r.sigma for r in QUERIES["deg_gauss_rand"](spark, sf).collect()}
    assert len(set(strength.values())) > 100 and max(strength.values()) < 15


def test_spans_of_time(spark):
    seconds = [0, 59, 3600, 86399, 86400, 90061, 200000, 10_000_000]
    df = spark.createDataFrame([(float(s) + 0.5,) for s in seconds], "s double")
    assert [r[0] for r in df.select(strings.delta_text(F.col("s"))).collect()] == [str(datetime.timedelta(seconds=s)) for s in seconds]


def test_eta_past_the_last_iteration(spark, tmp_path):
    """Rows of the query's SQL where it is below zero or near a tie of the seventh decimal; the text by itself stays Python's."""
    ids = [0, 99998, 99999, 100003, 103700, 200000, 674302, 1500859, 1815278]
    spark.createDataFrame([(n,) for n in ids], "event_id long").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(ORACLE["date_eta"] + " order by event_id").fetchall()
    assert [tuple(r) for r in QUERIES["date_eta"](spark, str(tmp_path)).orderBy("event_id").collect()] == want
    seconds = [-1, -59, -86400, -86401, -200000]
    df = spark.createDataFrame([(float(s),) for s in seconds], "s double")
    assert [r[0] for r in df.select(strings.delta_text(F.col("s"))).collect()] == [str(datetime.timedelta(seconds=s)) for s in seconds]


def test_options_as_values_and_text():
    assert registry.json_compatible({"a": [1, 2.5, None, "x", {"b": (True,)}]})
    assert not registry.json_compatible({1: "a"}) and not registry.json_compatible([{1}]) and not registry.json_compatible({"a": object()})
    assert registry.dump_tree({"a": 1, "b": {"c": "x"}}) == "\n  a: 1\n  b:[\n    c: x\n  ]\n"
