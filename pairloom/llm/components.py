"""Connected components of links, without a driver-side graph.

Links are first contracted within partitions (union-find keeps a forest: at most one link per node). Then large-star and
small-star rounds, each ending in a written table, pull every node towards the smallest of its component until nothing
changes. Once at most SMALL links are left, one task finishes them by union-find; its memory is bounded by SMALL.

Null ends are ignored; repeated links and self-links change nothing; no links give an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import dropped, written

SMALL = 300_000
#: Links that a task holds before it contracts them.
HELD = 500_000


class Forest:
    """Union-find over whole numbers; the root of a tree is its smallest member."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (above := up.get(top, top)) != top:
            top = above
        while (above := up.get(x, x)) != top:
            up[x] = top
            x = above
        return top

    def link(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def stars(self) -> tuple[list[int], list[int]]:
        nodes = [x for x in self.up if self.root(x) != x]
        return nodes, [self.up[x] for x in nodes]


_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _contract(batches):
    forest = Forest()
    for batch in batches:
        pairs = np.stack([c.to_numpy() for c in batch.columns], 1)
        for a, b in np.unique(pairs, axis=0).tolist():
            forest.link(a, b)
        if len(forest.up) > HELD:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in forest.stars()], schema=_SCHEMA)
            forest = Forest()
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in forest.stars()], schema=_SCHEMA)


def components(links: DataFrame, small: int = SMALL) -> DataFrame:
    """links: two whole-number columns. One row for each node that is not the smallest of its component: a, and b, the smallest."""
    a, b = links.columns[:2]
    links = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a is not null and b is not null and a != b")
    now = written(links.mapInArrow(_contract, "a long, b long"), "links")
    while True:
        if now.count() <= small:
            out = written(now.coalesce(1).mapInArrow(_contract, "a long, b long"), "components")
            dropped(now)
            return out
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = written(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*").where("a != b").distinct()
        after = written(moved, "small")
        key = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        done = key(after) == key(now)
        dropped(large)
        dropped(now)
        now = after
        if done:
            return now
