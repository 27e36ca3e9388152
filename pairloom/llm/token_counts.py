"""Token counts by rank-synchronous array merging.

Pre-tokens are held as ragged NumPy arrays of symbols; in each round every sequence merges its lowest-ranked pair, all
sequences at once, until none has a pair left. The symbols that survive are the tokens. A round takes the places of the
lowest rank from left to right, without overlaps, up to the first whose merge makes a pair of the same or a lower rank
beside it: that one is the next to be merged, and the places behind it wait for a later round. So a long pre-token takes
about as many rounds as it has different pairs, whatever its length.

Nulls and empty texts have no tokens; repeated rows are counted each for itself; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import Recent, as_texts, bundle, kept, pieces

#: Distinct pre-tokens in each generation of counts that a worker remembers.
REMEMBERED = 400_000


def _changes(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], x[1:] != x[:-1]])


class PieceCounter:
    """Counts as a byte-fallback BPE piece model does, without begin and end tokens."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or {p.type for p in model.pieces} & {4, 5}:
            raise ValueError(f"{model_path}: not a plain BPE piece model")
        self.prefix = " " if spec.add_dummy_prefix else ""
        pieces_ = {p.piece.replace("▁", " "): p.score for p in model.pieces if p.type == 1}
        self.bytes_fall_back = model.trainer_spec.byte_fallback
        self.ids = {p: i for i, p in enumerate(pieces_)}
        self.order = {s: i for i, s in enumerate(sorted(set(pieces_.values()), reverse=True))}
        ranks = np.array([self.order[s] for s in pieces_.values()], np.int64)
        #: (left, right) -> merged, for every way to cut a piece in two pieces
        cuts = {(self.ids[p[:k]], self.ids[p[k:]]): i for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids}
        self.ranks, n = ranks, len(self.ids)
        keys = np.array([a * n + b for a, b in cuts], np.int64)
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], np.array(list(cuts.values()), np.int64)[order]
        inner = any(" " in p.lstrip(" ") for p in pieces_)
        if inner:
            raise ValueError(f"{model_path}: pieces go across white space")
        self.cut = re.compile(" *[^ \n]+| +|\n" if not any("\n" in p for p in pieces_) else " *[^ ]+| +").findall
        self.known = Recent(REMEMBERED)

    def pairs(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray) -> np.ndarray:
        """The piece that each pair merges to, or -1."""
        key = left * len(self.ids) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(joined & (self.keys[at] == key) & (left >= 0) & (right >= 0), self.merged[at], -1)

    def width(self, char: str) -> int:
        """Tokens of a character that no piece has."""
        return len(char.encode()) if self.bytes_fall_back else 1

    def count_words(self, words: list[str]) -> list[int]:
        """The tokens of each pre-token."""
        out, get = np.zeros(len(words), np.int64), self.ids.get
        text = "".join(words)
        symbols = np.fromiter((get(c, -1) for c in text), np.int64, len(text))
        row = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        for at in np.flatnonzero(symbols < 0).tolist():
            out[row[at]] += self.width(text[at]) - 1
        pair = np.append(self.pairs(symbols[:-1], symbols[1:], row[:-1] == row[1:]), -1)  # what each symbol and the next merge to
        while len(symbols):
            spot = self.mergeable(symbols, row, pair)
            symbols[spot] = pair[spot]
            live = np.zeros(len(words), bool)
            live[row[spot]] = True
            keep = live[row]
            out += np.bincount(row[~keep], minlength=len(words))
            keep[spot + 1] = False
            spot = np.cumsum(keep)[spot] - 1
            symbols, row, pair = symbols[keep], row[keep], pair[keep]
            for at in (spot, spot[spot > 0] - 1):  # only pairs beside a merge are new
                nxt = np.minimum(at + 1, len(symbols) - 1)
                pair[at] = self.pairs(symbols[at], symbols[nxt], (row[at] == row[nxt]) & (at != nxt))
        return out.tolist()

    def mergeable(self, symbols: np.ndarray, row: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """Places of the lowest rank of each sequence that merging one by one, leftmost first, takes next, one after another."""
        spot = np.flatnonzero(pair >= 0)
        if not len(spot):
            return spot
        rank, firsts = self.ranks[pair[spot]], np.flatnonzero(_changes(row[spot]))
        rank_of = np.repeat(np.minimum.reduceat(rank, firsts), np.diff(np.append(firsts, len(spot))))
        spot, rank = spot[rank == rank_of], rank[rank == rank_of]
        # of overlapping places every other one
        order, fresh = np.arange(len(spot)), np.concatenate([[True], (spot[1:] != spot[:-1] + 1) | (row[spot[1:]] != row[spot[:-1]])])
        odd = (order - np.maximum.accumulate(np.where(fresh, order, 0))) & 1 == 1
        spot, rank = spot[~odd], rank[~odd]
        merged, own = pair[spot], row[spot]
        before, after = np.maximum(spot - 1, 0), np.minimum(spot + 2, len(symbols) - 1)
        beside = np.concatenate([[False], spot[1:] == spot[:-1] + 2])
        left = self.pairs(np.where(beside, np.concatenate([merged[:1], merged[:-1]]), symbols[before]), merged, (spot > 0) & (row[before] == own))
        right = self.pairs(merged, symbols[after], (spot + 2 < len(symbols)) & (row[after] == own))
        stop = (left >= 0) & (self.ranks[left] <= rank) | (right >= 0) & (self.ranks[right] <= rank)
        stops = np.cumsum(stop) - stop
        firsts = np.flatnonzero(_changes(own))
        return spot[stops == np.repeat(stops[firsts], np.diff(np.append(firsts, len(spot))))]

    def count(self, texts: list[str]) -> list[int]:
        cut = [self.cut(self.prefix + t.replace("▁", " ")) if t else [] for t in texts]
        new = list(self.known.missing(set().union(*cut)))
        known = self.known.now
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            known.update(zip(part, self.count_words(part), strict=True))
        return [sum(map(known.__getitem__, words)) for words in cut]


def count_tokens(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes and n_tokens of the whole text."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        key = ("pieces", model_path)
        for piece in pieces(batches, text_col, key=key):
            counter = kept(key, lambda: PieceCounter(model_path))
            texts = as_texts(piece.column(text_col))
            ids = piece.column(id_col)
            schema = pa.schema([(id_col, ids.type), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
            yield bundle(schema, ids, [len(t.encode()) for t in texts], counter.count(texts))

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long")


def over_limit(counts: DataFrame, limit: int = 4096) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
