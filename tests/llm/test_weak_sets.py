"""op9 where sets are made almost wholly of common passages: long runs, many weak sets, and links that only they have."""

from __future__ import annotations

import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pairloom.llm import ngram_join
from pairloom.llm.components import Forest

PASSAGE = [f"p{k}" for k in range(120)]


def texts(n, pairs, seed=6):
    """Each text: the passage with a few words changed and words of its own; some have a near copy of their own."""
    rng, out = random.Random(seed), []
    for i in range(n):
        t = list(PASSAGE) + [f"own{i}x{k}" for k in range(rng.randrange(28, 60))]
        for _ in range(rng.randrange(3)):
            t[rng.randrange(len(PASSAGE))] = f"c{rng.randrange(40)}"
        out.append(t)
    for i in range(pairs):
        t = list(out[i * (n // pairs)])
        t[rng.randrange(len(t))] = f"z{rng.randrange(9)}"
        out.append(t)
    return [" ".join(t) for t in out]


def linked(rows):
    """Components by counting shared shingles of all pairs that share one."""
    sets = [frozenset(ngram_join.shingles(t.encode()).tolist()) for t in rows]
    holders, forest = defaultdict(list), Forest()
    for i, s in enumerate(sets):
        both = defaultdict(int)
        for x in s:
            for j in holders[x]:
                both[j] += 1
            holders[x].append(i)
        for j, c in both.items():
            if 100 * c >= 75 * (len(s) + len(sets[j]) - c):
                forest.link(i, j)
    return [forest.root(i) for i in range(len(rows))]


@pytest.mark.parametrize("n, block", [(700, 64), (5000, 1024)])
def test_a_long_run_of_weak_sets(spark, monkeypatch, n, block):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    rows = texts(n, 60)
    want = linked(rows) if n < 1000 else None
    found = ngram_join.near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(6), shard=200_000).toPandas().set_index("doc_id").component_id
    if want is None:
        # the copies' own pairs, which the passage alone does not make
        own = {i * (n // 60): n + i for i in range(60)}
        assert all(found[a] == found[b] for a, b in own.items())
    else:
        assert found.sort_index().tolist() == want


def test_links_of_blocks_are_a_forest():
    """Near-equal sets: the pairs of blocks give one link fewer than sets, not all pairs."""
    rng = random.Random(2)
    sets = [ngram_join.shingles(" ".join([*PASSAGE, f"x{rng.randrange(10**6)}"]).encode()) for _ in range(50)]
    table = pa.table({
        "run": [7] * 50, "i": pa.array([0] * 50, pa.int32()), "j": pa.array([0] * 50, pa.int32()), "side": pa.array([0] * 50, pa.int32()),
        "cls": list(range(50)), "root": list(range(50)), "skip": list(range(50)), "n": [len(s) for s in sets],
        "sketch": [ngram_join.dense(s) for s in sets], "members": [s.tobytes() for s in sets],
    })
    assert sum(b.num_rows for b in ngram_join._near_sets(table.to_batches())) == 50
    assert sum(b.num_rows for b in ngram_join._joining(table.to_batches())) == 49
