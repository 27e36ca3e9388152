"""Language-model scores from an Elias-Fano n-gram trie.

Counts of all training documents make a two-level model over all words, none cut. Level one is the add-one distribution.
Level two has every pair of words that occurs (the end of a text is a word). With c the pair's count and a Dirichlet prior
of strength mu (the best of a grid by leave-one-out likelihood over all pairs)

    P(w | u) = (c(u, w) + mu P(w)) / (c(u) + mu)

so a text's score is its base score plus, for each token, log10(mu / (c(u) + mu)), plus log10(1 + ratio / mu) where the
pair was seen and ratio = c(u, w) / P(w). Only these ratios need pairs; they are kept, quantised in log space, in tries.

How a pair is keyed depends on its words, what it counts for does not. The most frequent words (HEAD at most, cut where
frequencies step) are known to every task and have short ids. Pairs of two such words are dealt by a hash of the pair, so
that no frequent word is one task's work. All other pairs belong to the shard of their rarer word's hash: the successor, or
the context if only that is rare. So a shard has all pairs that end in its words, and knows from them how often each word
occurs; a word that is not in the head has less than 1/HOT of all tokens. A shard of pairs of frequent words has its
contexts, an Elias-Fano sequence of pointers to each context's successors, one of the successors, and the quantised values;
one of rare words numbers the words it knows, and has an Elias-Fano sequence of pairs of these numbers. A task maps its
shard from a file of its own and answers the documents' queries by successor search relative to the context: the upper bits
lead to a handful of candidates, the lower bits decide.

Documents send, for each piece of rows, their distinct pairs with the rows that hold them; what comes back is sums for each
row. Very frequent pairs (at least 1/HOT of all tokens, so HOT at most) are answered where the documents are, by the
same quantised values, so that none is gathered in one task.

Null and empty texts are one end token. Repeated rows count, and are scored, each for itself; other columns are not read. Without
training documents every base score is 0. Words are known by a 64-bit hash.
"""

from __future__ import annotations

import os
import struct
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import LOWER, as_bytes, bundle, dropped, pieces, written

#: Frequent words with a short id; id 0 stands for any other word, which goes by its hash, and 1 is the end of a text.
HEAD, HOT = 65_000, 50_000
#: Added to the id of a frequent word that follows the rare word of a pair (that comes before it otherwise).
AFTER = 1 << 17
MUS = (10.0, 30.0, 100.0, 300.0, 1000.0, 3000.0, 10_000.0, 100_000.0)
#: Words counted before a task hands its counts on; tokens of which a shard of pairs, or words a shard of counts, has about this many.
COUNTED, SHARD_PAIRS, SHARD_WORDS = 300_000, 2_000_000, 250_000
ROWS, HELD = 8192, 2_000_000


class EliasFano:
    """A rising sequence of whole numbers below a limit: lower bits packed, upper bits in unary."""

    ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)
    #: The place of the k-th 0 of a byte.
    ZERO_AT = np.array([[*(np.flatnonzero(bits == 0)), *[8] * int(bits.sum())] for bits in ONES], np.int64)

    @staticmethod
    def pack(values: np.ndarray, limit: int) -> bytes:
        n = len(values)
        low = max(0, int(max(1, limit) // max(1, n)).bit_length() - 1)
        upper = np.zeros(n + (limit >> low) + 2, np.uint8)
        upper[(values >> low).astype(np.int64) + np.arange(n)] = 1
        lower = np.zeros((n, low), np.uint8)
        for k in range(low):
            lower[:, k] = (values >> k) & 1
        return struct.pack("<qqq", n, low, len(upper)) + np.packbits(upper).tobytes() + np.packbits(lower.ravel()).tobytes()

    def __init__(self, data: np.ndarray, at: int):
        self.n, self.low, size = struct.unpack("<qqq", data[at : at + 24].tobytes())
        at += 24
        self.upper = data[at : at + -(-size // 8)]
        at += len(self.upper)
        self.lower = data[at : at + -(-self.n * self.low // 8)]
        self.end = at + len(self.lower)
        self.zeros = np.concatenate([[0], np.cumsum(8 - np.bitwise_count(self.upper).astype(np.int64))])

    def lows(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for k in range(self.low):
            bit = at * self.low + k
            out |= ((self.lower[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1).astype(np.int64) << k
        return out

    def before(self, high: np.ndarray) -> np.ndarray:
        """How many values have upper bits below high."""
        k = np.maximum(high - 1, 0)
        byte = np.searchsorted(self.zeros, k, "right") - 1
        place = byte * 8 + self.ZERO_AT[self.upper[np.minimum(byte, len(self.upper) - 1)], k - self.zeros[byte]]
        return np.where(high > 0, place - k, 0)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value in the sequence (the first not less than it), or -1 if it is not there."""
        high = values >> self.low
        at, end = self.before(high), self.before(high + 1)
        want, out = values & ((1 << self.low) - 1), np.full(len(values), -1, np.int64)
        left = np.flatnonzero(at < end)
        for _ in range(4):
            here = self.lows(at[left])
            same = here == want[left]
            out[left[same]] = at[left[same]]
            at[left] += 1
            left = left[(here < want[left]) & (at[left] < end[left])]
        last = end.copy()
        many = left
        while len(left):
            middle = (at[left] + end[left]) >> 1
            less = self.lows(middle) < want[left]
            at[left[less]] = middle[less] + 1
            end[left[~less]] = middle[~less]
            left = left[at[left] < end[left]]
        many = many[at[many] < last[many]]
        many = many[self.lows(at[many]) == want[many]]
        out[many] = at[many]
        return out

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.upper))[: self.n]
        return (ones - np.arange(self.n)) << self.low | self.lows(np.arange(self.n))


def quantised(values: np.ndarray) -> tuple[np.ndarray, float, float]:
    """16-bit codes, and the least value and the step that read them."""
    least, most = (float(values.min()), float(values.max())) if len(values) else (0.0, 0.0)
    step = (most - least) / 65535 or 1.0
    return np.round((values - least) / step).astype("<u2"), least, step


_ZSTD = pa.Codec("zstd", 1)


def squeezed(values: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers for a shuffle: differences if they rise, byte by byte, compressed."""
    values = np.diff(values, prepend=values.dtype.type(0)) if rising else values
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return struct.pack("<q", planes.nbytes) + _ZSTD.compress(planes.tobytes(), asbytes=True)


def loosened(data, kind: str, rising: bool = False) -> np.ndarray:
    size = struct.unpack("<q", bytes(data[:8]))[0]
    planes = np.frombuffer(_ZSTD.decompress(pa.py_buffer(data)[8:] if size else b"", size) if size else b"", np.uint8)
    values = np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
    return np.cumsum(values, dtype=values.dtype) if rising else values


def pack_trie(pairs: np.ndarray, values: np.ndarray) -> bytes:
    """pairs: distinct u << 16 | w, sorted; values: to be quantised to 16 bits."""
    contexts, starts = np.unique(pairs >> 16, return_index=True)
    rank = np.repeat(np.arange(len(contexts)), np.diff(np.append(starts, len(pairs))))
    codes, least, step = quantised(values)
    return (
        struct.pack("<qdd", len(contexts), least, step) + contexts.astype("<u2").tobytes() + EliasFano.pack(starts.astype(np.int64), len(pairs) + 1)
        + EliasFano.pack(rank << 16 | (pairs & 65535), len(contexts) << 16) + codes.tobytes()
    )


def mapped(blob) -> np.ndarray:
    """The blob as a mapped file that lives in memory only."""
    with os.fdopen(os.memfd_create("trie"), "w+b") as f:
        f.write(blob)
        f.flush()
        return np.memmap(f, np.uint8, "r")


class Trie:
    """A shard of pairs of frequent words, mapped from a file."""

    def __init__(self, blob):
        self.data = data = mapped(blob)
        n, self.least, self.step = struct.unpack("<qdd", data[:24].tobytes())
        self.contexts = data[24 : 24 + 2 * n].view("<u2").astype(np.int64)
        pointers = EliasFano(data, 24 + 2 * n)
        self.successors = EliasFano(data, pointers.end)
        self.pointers = np.append(pointers.all(), self.successors.n)
        self.values = np.frombuffer(data, "<u2", self.successors.n, self.successors.end)

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """Each pair's value; -inf if it was not seen."""
        out = np.full(len(pairs), -np.inf)
        if not len(self.contexts):
            return out
        rank = np.minimum(np.searchsorted(self.contexts, pairs >> 16), len(self.contexts) - 1)
        known = np.flatnonzero(self.contexts[rank] == pairs >> 16)
        place = self.successors.find(rank[known] << 16 | (pairs[known] & 65535))
        seen = (place >= self.pointers[rank[known]]) & (place < self.pointers[rank[known] + 1])
        out[known[seen]] = self.values[place[seen]] * self.step + self.least
        return out


def pack_rare(words: np.ndarray, others: np.ndarray, counts: np.ndarray, values: np.ndarray) -> bytes:
    """words, others: distinct pairs, sorted; counts: how often each distinct word occurs; values: to be quantised to 16 bits."""
    known, rank = np.unique(words, return_inverse=True)
    second, place = np.unique(others, return_inverse=True)
    codes, least, step = quantised(values)
    return (
        struct.pack("<qqdd", len(known), len(second), least, step) + known.astype("<u8").tobytes() + counts.astype("<i8").tobytes() + second.astype("<i8").tobytes()
        + EliasFano.pack(rank * len(second) + place, len(known) * len(second)) + codes.tobytes()
    )


class RareTrie:
    """A shard of rare words with all their pairs, mapped from a file."""

    def __init__(self, blob):
        self.data = data = mapped(blob)
        n, m, self.least, self.step = struct.unpack("<qqdd", data[:32].tobytes())
        self.words, self.counts, self.others = np.frombuffer(data, "<u8", n, 32), np.frombuffer(data, "<i8", n, 32 + 8 * n), np.frombuffer(data, "<i8", m, 32 + 16 * n)
        self.pairs = EliasFano(data, 32 + 16 * n + 8 * m)
        self.values = np.frombuffer(data, "<u2", self.pairs.n, self.pairs.end)

    def find(self, words: np.ndarray, sizes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each word occurs, and the value of each of its pairs (sizes of others by word); -inf if it was not seen."""
        counts, out = np.zeros(len(words), np.int64), np.full(len(others), -np.inf)
        if not len(self.words):
            return counts, out
        rank = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        there = self.words[rank] == words
        counts[there] = self.counts[rank[there]]
        place = np.minimum(np.searchsorted(self.others, others), len(self.others) - 1)
        known = np.flatnonzero(np.repeat(there, sizes) & (self.others[place] == others))
        at = self.pairs.find(np.repeat(rank, sizes)[known] * len(self.others) + place[known])
        out[known[at >= 0]] = self.values[at[at >= 0]] * self.step + self.least
        return counts, out


@dataclass
class Base:
    """What every task knows of the words: bounded by HEAD."""

    words: np.ndarray  # hashes of the head, sorted
    ids: np.ndarray  # their ids
    counts: np.ndarray  # by id; 0 has all other words' tokens
    total: int  # N
    distinct: int  # V
    contexts: np.ndarray  # for each of MUS, the sum of c log(c - 1 + mu) over all words as contexts

    def share(self, counts: np.ndarray) -> np.ndarray:
        """P(w) by the add-one distribution."""
        return (counts + 1.0) / (self.total + self.distinct + 1)

    def find(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.ids[at], 0)

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and hashes of the tokens of all texts, with an end before the first and after each, and the texts' sizes with their ends."""
        words, sizes = [b""], []
        for text in texts:
            mine = text.translate(LOWER).split()
            words += mine
            words.append(b"")
            sizes.append(len(mine) + 1)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)
        sizes = np.array(sizes, np.int64)
        ids = self.find(hashes)
        ids[np.concatenate([[0], np.cumsum(sizes)])] = 1
        return ids, hashes, sizes


def split(ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """
    The pairs of neighbours: those of two frequent words, as u << 16 | w, with their places; those with a rare word, as that
    word's hash (the successor's if both are rare) and the other word, with their places.
    """
    u, w = ids[:-1], ids[1:]
    near = (u > 0) & (w > 0)
    far = np.flatnonzero(~near)
    last = w[far] == 0
    words = np.where(last, hashes[far + 1], hashes[far]).view(np.uint64)
    others = np.where(last, np.where(u[far] > 0, u[far], hashes[far]), AFTER + w[far])
    near = np.flatnonzero(near)
    return u[near] << 16 | w[near], near, words, others, far


def ends_in_word(others: np.ndarray) -> np.ndarray:
    """Whether the pairs of rare words have these as successors."""
    return (others < AFTER) | (others >= 2 * AFTER)


def shard_of_words(words: np.ndarray, shards: int) -> np.ndarray:
    """By range of the hash, so that sorted words are in the order of their shards."""
    return ((words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def shard_of(pairs: np.ndarray, shards: int) -> np.ndarray:
    return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shards


def learn_words(docs: DataFrame, text_col: str = "text", head: int = HEAD) -> Base:
    """The words' base, from the counts of all words."""

    def run(batches):
        counts = Counter()

        def out():
            words = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), np.uint64, len(counts)).view(np.int64)
            batch = pa.RecordBatch.from_arrays([pa.array(words), pa.array(list(counts.values()), pa.int64())], names=["h", "n"])
            counts.clear()
            return batch

        texts = 0
        for piece in pieces(batches, text_col):
            texts += piece.num_rows
            for text in as_bytes(piece.column(text_col)):
                counts.update(text.translate(LOWER).split())
            if len(counts) > COUNTED:
                yield out()
        yield out()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([texts], pa.int64())], names=["h", "n"])

    words = written(docs.select(text_col).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "words")
    as_contexts = [F.sum(F.when(F.col("n") > 0, F.col("n") * F.log(F.col("n") - 1 + mu))).alias(f"mu{k}") for k, mu in enumerate(MUS)]
    sums = words.agg(F.sum("n").alias("total"), F.count(F.when(F.col("n") > 0, 1)).alias("distinct"), F.sum(F.when(F.col("h").isNull(), F.col("n"))).alias("texts"), *as_contexts).first()
    # an order and limit would send the best of each task to the driver; steps of an eighth of an octave tell where to cut
    step = F.floor(F.log2("n") * 8)
    sizes = words.where("h is not null").groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    taken, whole, part, share = 0, [], None, 0.0
    for r in sizes:
        if taken + r["count"] > head:
            part, share = r.step, 0.97 * (head - taken) / r["count"]  # of the step that does not fit as a whole, by hash
            break
        taken += r["count"]
        whole.append(r.step)
    least = whole[-1] if whole else 1 << 30
    fits = (step >= least) | ((step == (-1 if part is None else part)) & (F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < int(share * (1 << 30))))
    top = sorted(words.where(F.col("h").isNotNull() & fits).collect(), key=lambda r: (-r.n, r.h))[:head]
    by_hash = sorted((r.h, k + 2, r.n) for k, r in enumerate(top))
    counts = np.array([0, sums.texts or 0, *(r.n for r in top)], np.float64)
    counts[0] = (sums.total or 0) - counts.sum()
    hashed, ids = (np.array([x[i] for x in by_hash], np.int64) for i in (0, 1))
    dropped(words)
    return Base(hashed, ids, counts, sums.total or 0, sums.distinct or 0, np.array([sums[f"mu{k}"] or 0.0 for k in range(len(MUS))]))


def by_word(words: np.ndarray, others: np.ndarray, shards: int, rows: np.ndarray | None = None):
    """For each shard: distinct words, how many distinct pairs each has, their others, how often each pair comes, and the rows."""
    order = np.lexsort((others, words))
    words, others = words[order], others[order]
    rows = None if rows is None else rows[order].astype("<u2")
    cuts = np.searchsorted(shard_of_words(words, shards), np.arange(shards + 1))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if b > a:
            w, o = words[a:b], others[a:b]
            fresh = np.concatenate([[True], w[1:] != w[:-1]])
            starts = np.flatnonzero(fresh | np.concatenate([[True], o[1:] != o[:-1]]))
            firsts = np.flatnonzero(fresh[starts])
            sizes, times = np.diff(np.append(firsts, len(starts))), np.diff(np.append(starts, b - a))
            yield k, squeezed(w[starts[firsts]], True), squeezed(sizes.astype("<u4")), squeezed(o[starts]), squeezed(times.astype("<u4")), None if rows is None else squeezed(rows[a:b])


#: kind 0: pairs of frequent words (in pairs, 32 bits each); 1: pairs of rare words (words, and sizes of their pairs, 64 bits each).
_COUNTS = pa.schema([("kind", pa.int32()), ("shard", pa.int64()), ("words", pa.binary()), ("sizes", pa.binary()), ("pairs", pa.binary()), ("counts", pa.binary())])


def shards_of(base: Base) -> tuple[int, int]:
    """How many shards of pairs of frequent words, and of rare words."""
    rare = int(base.counts[0])
    return max(1, -(-base.total // SHARD_PAIRS)), max(1, -(-base.distinct // SHARD_WORDS), -(-2 * rare // SHARD_PAIRS))


def learn_pairs(docs: DataFrame, base: Base, text_col: str = "text") -> tuple[DataFrame, dict[int, float], float]:
    """The tries' shards (a table), the hot pairs with their values, and mu."""
    shards, rare_shards = shards_of(base)
    hot_from, shares = max(2, -(-base.total // HOT)), base.share(base.counts)

    def run(batches):
        held, rare, size = [], [], 0

        def out():
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            shard = shard_of(pairs, shards)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            pairs, n = pairs[order].astype("<u4"), n[order].astype("<u4")
            rows = [(0, k, None, None, squeezed(pairs[a:b], True), squeezed(n[a:b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            rows += [(1, *x[:5]) for x in by_word(*(np.concatenate(x) for x in zip(*rare, strict=True)), rare_shards)]
            for at in range(0, len(rows), 64):
                yield bundle(_COUNTS, *map(list, zip(*rows[at : at + 64], strict=True)))

        for piece in pieces(batches, text_col, ROWS):
            ids, hashes, _ = base.tokens(as_bytes(piece.column(text_col)))
            pairs, _, words, others, _ = split(ids, hashes)
            held.append(pairs.astype(np.uint32))
            rare.append((words, others))
            size += len(ids) - 1
            if size > HELD:
                yield from out()
                held, rare, size = [], [], 0
        if held:
            yield from out()

    def summed(keys: tuple, n: np.ndarray):
        """Distinct keys, sorted by the last first, and the sum of n for each."""
        order = np.lexsort(keys)
        keys, n = [k[order] for k in keys], n[order]
        fresh = np.ones(len(n), bool)
        fresh[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        starts = np.flatnonzero(fresh)
        return [k[starts] for k in keys], np.add.reduceat(n, starts)

    def build(table: pa.Table) -> pa.Table:
        def all_of(column, kind, rising=False):
            return np.concatenate([loosened(x.as_buffer(), kind, rising) for x in table.column(column)])

        n = all_of("counts", "<u4").astype(np.int64)
        if table.column("kind")[0].as_py() == 0:
            (pairs,), n = summed((all_of("pairs", "<u4", True).astype(np.int64),), n)
            p, hot = shares[pairs & 65535], n >= hot_from
            values = np.log10(n / p)
            codes, least, step = quantised(values)
            trie, hot_pairs, hot_values = pack_trie(pairs, values), pairs[hot], codes[hot] * step + least
        else:
            (others, words), n = summed((all_of("pairs", "<i8"), np.repeat(all_of("words", "<u8", True), all_of("sizes", "<u4"))), n)
            last = ends_in_word(others)
            starts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
            counts = np.add.reduceat(n * last, starts)  # all tokens of a word end a pair, and all these pairs are here
            p = base.share(np.repeat(counts, np.diff(np.append(starts, len(words)))))
            p[~last] = shares[others[~last] - AFTER]
            trie, hot_pairs, hot_values = pack_rare(words, others, counts, np.log10(n / p)), n[:0], np.zeros(0)
        fit = [float((n * np.log(n - 1 + mu * p)).sum()) for mu in MUS]
        return pa.table({
            "kind": table.column("kind").slice(0, 1), "shard": table.column("shard").slice(0, 1), "trie": pa.array([trie], pa.binary()), "hot": pa.array([hot_pairs.tobytes()], pa.binary()),
            "hot_values": pa.array([hot_values.tobytes()], pa.binary()), "fit": pa.array([fit], pa.list_(pa.float64())),
        })

    counted = docs.select(text_col).mapInArrow(run, "kind int, shard long, words binary, sizes binary, pairs binary, counts binary")
    made = counted.groupBy("kind", "shard").applyInArrow(build, "kind int, shard long, trie binary, hot binary, hot_values binary, fit array<double>")
    made = written(made, "trie")
    known = made.where("kind = 0").select("hot", "hot_values").collect()  # HOT pairs at most, as all counts add up to N
    hot = {k: v for r in known for k, v in zip(np.frombuffer(bytes(r.hot), np.int64).tolist(), np.frombuffer(bytes(r.hot_values)).tolist(), strict=True)}
    fits = made.agg(*[F.sum(F.col("fit")[k]) for k in range(len(MUS))]).first()
    return made.select("kind", "shard", "trie"), hot, MUS[int(np.argmax(np.array([x or 0.0 for x in fits]) - base.contexts))]


#: kinds as in _COUNTS, and 2: what is known where the documents are, with the piece as its shard.
_QUERY = pa.schema([("kind", pa.int32()), ("shard", pa.int64()), ("piece", pa.int64()), ("words", pa.binary()), ("sizes", pa.binary()), ("pairs", pa.binary()), ("times", pa.binary()), ("rows", pa.binary())])
_ANSWER = pa.schema([("piece", pa.int64()), ("rows", pa.binary()), ("tail", pa.binary()), ("known", pa.binary()), ("gain", pa.binary()), ("ids", pa.binary()), ("tokens", pa.binary())])


def _grouped(pairs: np.ndarray, rows: np.ndarray, shards: int):
    """For each shard: distinct pairs, how often each comes, and the rows (a row comes as often as it holds the pair)."""
    shard = shard_of(pairs, shards)
    order = np.lexsort((pairs, shard))
    pairs, rows, shard = pairs[order], rows[order].astype("<u2"), shard[order]
    cuts = np.searchsorted(shard, np.arange(shards + 1))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if b > a:
            starts = np.flatnonzero(np.concatenate([[True], pairs[a + 1 : b] != pairs[a : b - 1]]))
            times = np.diff(np.append(starts, b - a)).astype("<u4")
            yield k, None, None, squeezed(pairs[a:b][starts].astype("<u4"), True), squeezed(times), squeezed(rows[a:b])


def score(docs: DataFrame, base: Base, trie: DataFrame, hot: dict[int, float], mu: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, n_known, base_score, score."""
    kind = docs.schema[id_col].dataType.simpleString()
    shards, rare_shards = shards_of(base)
    hot_pairs = np.array(sorted(hot), np.int64)
    hot_gain = np.log10(1 + 10 ** np.array([hot[k] for k in hot_pairs.tolist()], np.float64) / mu)
    log_counts, miss, seen = np.log10(base.counts + 1), np.log10(mu / (base.counts + mu)), (base.counts > 0).astype(np.float64)
    log_counts[0] = miss[0] = seen[0] = 0  # rare words' shards know these
    each = np.log10(base.total + base.distinct + 1)
    # the piece's number: the partition (upper bits) and the piece within it
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("part"))
    local_schema = pa.schema([*_QUERY, ("ids", pa.binary()), ("tokens", pa.binary()), ("tail", pa.binary()), ("known", pa.binary()), ("gain", pa.binary())])

    def ask(batches):
        number = 0
        for piece in pieces(batches, "text", ROWS):
            key = (piece.column("part")[0].as_py() << 32) + number
            number += 1
            ids, hashes, sizes = base.tokens(as_bytes(piece.column("text")))
            n = len(sizes)
            rows = np.repeat(np.arange(n), sizes)
            known, tail, gain = (np.bincount(rows, v, minlength=n) for v in (seen[ids[1:]], log_counts[ids[1:]], miss[ids[:-1]]))
            known = known.round().astype(np.int64)
            pairs, near, words, others, far = split(ids, hashes)
            near = rows[near]
            if len(hot_pairs):
                at = np.minimum(np.searchsorted(hot_pairs, pairs), len(hot_pairs) - 1)
                hit = hot_pairs[at] == pairs
                gain += np.bincount(near[hit], hot_gain[at[hit]], minlength=n)
                pairs, near = pairs[~hit], near[~hit]
            out = [(0, *x) for x in _grouped(pairs, near, shards)] if base.total else []
            out += [(1, *x) for x in by_word(words, others, rare_shards, rows[far])] if base.total else []
            for at in range(0, len(out), 64):
                part = out[at : at + 64]
                nothing = [None] * len(part)
                kinds, where, *asked_for = map(list, zip(*part, strict=True))
                yield bundle(local_schema, kinds, where, [key] * len(part), *asked_for, nothing, nothing, nothing, nothing, nothing)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("id", piece.column("id").type)])) as w:
                w.write_batch(pa.RecordBatch.from_arrays([piece.column("id")], names=["id"]))
            yield bundle(local_schema, [2], [key], [key], *[[None]] * 5, [sink.getvalue().to_pybytes()], [sizes.tobytes()], [tail.tobytes()], [known.tobytes()], [gain.tobytes()])

    asked = source.mapInArrow(ask, "kind int, shard long, piece long, words binary, sizes binary, pairs binary, times binary, rows binary, ids binary, tokens binary, tail binary, known binary, gain binary")

    def answer(model: pa.Table, table: pa.Table) -> pa.Table:
        if table.num_rows and table.column("kind")[0].as_py() == 2:
            return table.select(_ANSWER.names)
        blob = model.column("trie")[0].as_buffer() if model.num_rows else None

        def of_pairs(shard, words, sizes, pairs):
            pairs = loosened(pairs, "<u4", True).astype(np.int64)
            return None, None, np.log10(1 + 10 ** shard.find(pairs) / mu) if shard else np.zeros(len(pairs))

        def of_words(shard, words, sizes, pairs):
            words, sizes, others = loosened(words, "<u8", True), loosened(sizes, "<u4"), loosened(pairs, "<i8")
            counts, value = shard.find(words, sizes, others) if shard else (np.zeros(len(words), np.int64), np.full(len(others), -np.inf))
            # a token of a rare word ends one of its pairs, where it is counted both as a word and as the next one's context
            last = ends_in_word(others)
            log_count, known, miss = (np.repeat(v, sizes) * last for v in (np.log10(counts + 1.0), (counts > 0).astype(np.float64), np.log10(mu / (counts + mu))))
            return log_count, known, miss + np.log10(1 + 10**value / mu)

        rare = table.num_rows and table.column("kind")[0].as_py() == 1
        shard, value = (RareTrie if rare else Trie)(blob) if blob is not None and table.num_rows else None, of_words if rare else of_pairs
        out = []
        for piece, *asked_for in zip(*(table.column(c) for c in ("piece", "words", "sizes", "pairs", "times", "rows")), strict=True):
            words, sizes, pairs, times, rows = (x.as_buffer() for x in asked_for)
            tail, known, gain = value(shard, words, sizes, pairs)
            times, rows = loosened(times, "<u4"), loosened(rows, "<u2").astype(np.int64)
            mine, at = np.unique(rows, return_inverse=True)
            sums = [np.zeros(len(mine)) if v is None else np.bincount(at, np.repeat(v, times), minlength=len(mine)) for v in (tail, known, gain)]
            out.append((piece.as_py(), mine.astype("<u2").tobytes(), *(s.tobytes() for s in sums), None, None))
        return pa.Table.from_batches([bundle(_ANSWER, *map(list, zip(*out, strict=True)))] if out else [], schema=_ANSWER)

    answers = trie.groupBy("kind", "shard").cogroup(asked.groupBy("kind", "shard")).applyInArrow(answer, "piece long, rows binary, tail binary, known binary, gain binary, ids binary, tokens binary")

    def total(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r for r in rows if r["ids"] is not None)
        ids = pa.ipc.open_stream(own["ids"]).read_all().column("id")
        tokens, known = (np.frombuffer(own[c], np.int64) for c in ("tokens", "known"))
        known, tail, gain = known.astype(np.float64), np.frombuffer(own["tail"]).copy(), np.frombuffer(own["gain"]).copy()
        for r in rows:
            if r["ids"] is None:
                at = np.frombuffer(r["rows"], "<u2")
                known[at] += np.frombuffer(r["known"])
                tail[at] += np.frombuffer(r["tail"])
                gain[at] += np.frombuffer(r["gain"])
        base_score = tail - tokens * each
        return pa.table({"id": ids, "n_tokens": tokens, "n_known": known.round().astype(np.int64), "base_score": base_score, "score": base_score + gain})

    out = answers.groupBy("piece").applyInArrow(total, f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)


def learn_and_score(train: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD) -> DataFrame:
    """One row per document of docs: id, n_tokens, n_known, train_tokens, base_score, score by a model of train's texts. Only speed depends on head."""
    base = learn_words(train, text_col, head)
    trie, hot, mu = learn_pairs(train, base, text_col)
    return score(docs, base, trie, hot, mu, id_col, text_col).withColumn("train_tokens", F.lit(base.total).cast("long"))
