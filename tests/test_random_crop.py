"""arr_random_crop_pair against a crop by slices."""

from __future__ import annotations

import numpy as np
import pytest
from pairloom.functions import arrays
from pairloom.plans.base import image_pairs
from pairloom.plans.catalog import QUERIES
from pyspark.sql import functions as F


def test_crops_are_at_the_drawn_places(spark, sf):
    images = {r.vec_id: (np.reshape(r.p, (8, 8)), np.reshape(r.q, (8, 8)).repeat(2, 0).repeat(2, 1)) for r in image_pairs(spark, sf).collect()}
    rows = QUERIES["arr_random_crop_pair"](spark, sf).collect()
    assert len(rows) == len(images) and {r.top for r in rows} == {r.left for r in rows} == set(range(5))
    for r in rows:
        lq, gt = images[r.vec_id]
        assert r.lq == lq[r.top : r.top + 4, r.left : r.left + 4].ravel().tolist()
        assert r.gt == gt[2 * r.top : 2 * r.top + 8, 2 * r.left : 2 * r.left + 8].ravel().tolist()


def test_sizes_are_checked(spark):
    zero, p = F.lit(0), F.array(*[F.lit(0.5)] * 64)
    with pytest.raises(ValueError):
        arrays.paired_crop(p, p, (8, 8), (8, 8), 8, 2, zero, zero)
    with pytest.raises(ValueError):
        arrays.paired_crop(p, p, (2, 2), (4, 4), 8, 2, zero, zero)
    with pytest.raises(Exception, match="not 16 x 16"):
        spark.range(1).select(*arrays.paired_crop(p, p, (8, 8), (16, 16), 8, 2, zero, zero)).collect()
