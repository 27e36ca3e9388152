"""op10 beyond the words that every task knows: pairs of all words count, whatever the head holds."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest
from pairloom.llm import ngram_lm

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute(train, docs):
    """Scores of the model over all words and all pairs."""
    tokens = lambda t: [None, *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), None]
    c, pairs = collections.Counter(), collections.Counter()
    for t in train:
        w = tokens(t)
        c.update(w[1:])
        pairs.update(zip(w[:-1], w[1:]))
    whole = sum(c.values()) + len(c) + 1
    p = lambda w: (c[w] + 1) / whole
    fit = {mu: sum(n * math.log((n - 1 + mu * p(w)) / (c[u] - 1 + mu)) for (u, w), n in pairs.items()) for mu in ngram_lm.MUS}
    mu = max(fit, key=fit.get)
    return [sum(math.log10((pairs[u, w] + mu * p(w)) / (c[u] + mu)) for u, w in zip(tokens(t)[:-1], tokens(t)[1:])) for t in docs]


def scores(spark, train, docs, **more):
    frame = lambda texts: spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return ngram_lm.learn_and_score(frame(train), frame(docs), **more).toPandas().set_index("doc_id").sort_index()


def test_a_vocabulary_above_the_head(spark):
    rng = random.Random(4)
    phrases = [f"a{k} b{k} c{k}" for k in range(24_000)]
    assert 3 * len(phrases) > ngram_lm.HEAD
    order = rng.sample(phrases, len(phrases)) + rng.sample(phrases, len(phrases))
    train = [" the ".join(order[k : k + 40]) for k in range(0, len(order), 40)]
    docs = train[:60] + [" ".join(rng.choice(phrases) for _ in range(30)) for _ in range(60)] + ["new words only", "", None, "a1 b2 c3 the the"]
    got, want = scores(spark, train, docs), brute(train, docs)
    assert np.abs(got.score - want).max() < 1e-4 * got.n_tokens.max()
    assert (got.score - want).abs().le(2e-4 * got.n_tokens).all()


@pytest.mark.parametrize("head", [0, 40, 1500])
def test_the_head_changes_no_score(spark, sf, head):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    got, want = scores(spark, texts[::2], texts, head=head), brute(texts[::2], texts)
    assert (got.score - want).abs().le(2e-4 * got.n_tokens).all()
    whole = scores(spark, texts[::2], texts)
    assert np.allclose(got.base_score, whole.base_score, rtol=1e-9) and (got.n_known == whole.n_known).all()
