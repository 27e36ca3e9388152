"""op8: blocks of large buckets, recall near the threshold, and the two precisions of a source."""

from __future__ import annotations

import numpy as np
import pytest
from pairloom.llm import embedding_dedup


@pytest.fixture(scope="module")
def planted():
    """Unit vectors in pairs whose cosines run from 0.9 to 0.95, the hardest to meet, and one large group of near copies."""
    rng = np.random.default_rng(5)
    a = rng.standard_normal((300, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    other = rng.standard_normal(a.shape)
    other -= (other * a).sum(1, keepdims=True) * a
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = rng.uniform(0.9005, 0.95, (300, 1))
    b = cosine * a + np.sqrt(1 - cosine**2) * other
    group = rng.standard_normal(32) + 0.05 * rng.standard_normal((200, 32))
    return np.concatenate([a, b, group]).astype(np.float32)


def links(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return (x @ x.T >= 0.9).sum(1) - 1


def run(spark, x, kind):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"vec_id long, embedding array<{kind}>")
    return embedding_dedup.near_duplicates(df.repartition(5)).toPandas().set_index("vec_id").sort_index()


def test_recall_near_the_threshold(spark, planted):
    got, want = run(spark, planted, "float").n_links.to_numpy(), links(planted)
    assert (got <= want).all() and got[:600].sum() >= 0.98 * want[:600].sum() and (got[600:] == want[600:]).all()


def test_blocks_and_precisions_change_nothing(spark, planted, monkeypatch):
    whole = run(spark, planted, "float")
    assert whole.equals(run(spark, planted, "double"))
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    assert whole.equals(run(spark, planted, "float"))
