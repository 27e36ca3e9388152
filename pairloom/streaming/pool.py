"""Streams: the shuffle pool, periodic actions and append-only sinks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def shuffle_pool(stream: DataFrame, shard: str, key: str, payload: str, size: int, seed: int = 0):
    """
    A pool of size rows for each shard: it fills first (rows pass unchanged); once full, each incoming row takes the place
    of a pooled one, which leaves. Every row leaves at most once, and state never exceeds size rows of a shard. Keys and
    payloads are held as a JSON list, so any text is kept as it is; null payloads stay null, keys keep their type.
    """
    whole = not isinstance(stream.schema[key].dataType, StringType)

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, turn = state.get if state.exists else ("[]", 0)
        pool = json.loads(held)
        for frame in frames:
            out = []
            for k, p in zip(frame[key], frame[payload], strict=True):
                item = [None if pd.isna(k) else int(k) if whole else k, None if pd.isna(p) else p]
                if len(pool) < size:
                    pool.append(item)
                    out.append((group[0], *item, True))
                    continue
                at = pd.util.hash_array(pd.array([seed * 1_000_003 + turn], "int64").to_numpy())[0] % size
                turn += 1
                gone, pool[at] = pool[at], item
                out.append((group[0], *gone, False))
            made = pd.DataFrame(out, columns=[shard, "key", "payload", "filling"])
            yield made.astype({"key": "Int64"}) if whole else made
        state.update((json.dumps(pool), turn))

    kind = stream.schema[shard].dataType.simpleString()
    return stream.groupBy(shard).applyInPandasWithState(step, f"{shard} {kind}, key {'long' if whole else 'string'}, payload string, filling boolean", "pool string, turn long", "append", GroupStateTimeout.NoTimeout)


def windowed(stream: DataFrame, ts: str, late: str, width: str, keys: list[str], value: str) -> DataFrame:
    """Counts and sums of event-time windows; events later than late are dropped once their window has closed."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def periodic(rows: DataFrame, counter: str, every: int) -> DataFrame:
    return rows.where(F.pmod(F.col(counter), F.lit(every)) == 0)


def accumulate(rows: DataFrame, counter: str, steps: int) -> DataFrame:
    """iteration: every steps micro-batches are one."""
    return rows.withColumn("iteration", F.floor((F.col(counter) - 1) / steps) + 1)


def append_scalars(batch: DataFrame, path: str, batch_id: int) -> None:
    """A foreachBatch sink: long rows, one folder per batch, so that a repeated batch replaces itself."""
    batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
