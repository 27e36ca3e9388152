"""N-gram Jaccard join with parity sketches.

A document's set is its distinct shingles (five words; a shorter text as a whole). Documents with equal sets are one class.

Sketch: each shingle flips a bit, so two sketches differ in no more bits than the symmetric difference of their sets has
members. Per size band a sketch is cut into parts, more parts than two sets that link can differ in shingles, so some part
is equal (pigeonhole). Bits are drawn from so wide a range that a part is held as the XOR of its shingles' hashes. Classes
with an equal, non-empty part meet in a run. Band j serves pairs whose smaller set is in band j; bands grow by 4/3, so a set
takes part in its own band and the one below.

- A run of up to RUN classes gives all its pairs. A longer one gives the pairs with its least class, and its members count
  one "common" part each.
- A pair must share at least (parts - greatest difference - empty parts - common parts of either set) parts that were
  counted; pairs below that, or whose dense sketches differ in too many bits, cannot link. Nothing else is left out.
- A set with so many common parts that this number is 0 or less is "weak": only two weak sets can have been missed, and
  these share a long run. The home of a weak set is the longest of its runs. Sets of one home are compared first, block by
  block, then sets of different homes that are not connected yet: the pairs of homes that meet in a run of at most HOMES
  homes, once each, and the other runs, each for itself. A pair of blocks gives the sets that have
  a partner by their sketches, then, with the sets themselves, the links that join two components: rows in proportion to
  sets, never pairs.
- All remaining pairs are verified on the sets themselves: 100 * intersection >= 75 * union.

Null texts and texts without words have an empty set and link with nothing. Repeated rows are of one class. A null doc_id is kept; its component is the least doc_id of
its component, itself (null) if there is none. Classes are known by a 64-bit hash of their sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import LOWER, as_bytes, bundle, dropped, groups, pieces, written
from pairloom.llm.components import Forest, components

WIDTH, RUN, GROW, SPARE, DENSE = 5, 8, 4 / 3, 1.15, 1024
#: Signatures in a shard, which one task holds (about 60 bytes each while it sorts them).
SHARD = 2_000_000
#: Shingles, and sets, of a block of weak sets; links of a star that one task verifies with the centre's set; parts of a component's join.
BLOCK_SHINGLES, BLOCK_SETS, STAR, SALTS = 1 << 19, 1024, 256, 16
#: A run of more homes is gone through itself. Classes of so many copies that each has more than a HEAVYth of all rows are broadcast.
HOMES, HEAVY = 32, 2000
#: Bits of the filter that tells which classes have candidates; a fuller filter only lets more sets through.
FILTER = 1 << 24
_M1, _M2, _P = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = text.translate(LOWER).split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(WIDTH, n)
    x = w[: n - width + 1] + np.uint64(width)
    for k in range(1, width):
        x = (x ^ (x >> np.uint64(29))) * _P + w[k : n - width + 1 + k]
    return np.unique(mixed(x))


def class_of(shingle_set: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(shingle_set.tobytes()), np.uint64).astype(np.int64))


def _bands() -> np.ndarray:
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * GROW))))
    return np.array(out, np.int64)


LOWS = _bands()


def band_of(n: int) -> int:
    return int(np.searchsorted(LOWS, n, "right")) - 1


def parts_in(band: int) -> int:
    """More than the greatest difference of a pair whose smaller set is in the band, and some to spare for empty parts."""
    top = int(LOWS[band + 1]) - 1
    return int(np.ceil(((top + 4 * top // 3) // 7 + 1) * SPARE))


def signatures(shingle_set: np.ndarray, below: bool) -> tuple[np.ndarray, int]:
    """
    One number for each non-empty part in the set's own band, or the one below, and by how many these exceed the greatest
    difference of a pair there. A set that does not exceed it gives its shingles as well: two such sets may have only
    empty parts in common, but share a shingle if they link.
    """
    n = len(shingle_set)
    band = band_of(n) - below
    if band < 0 or below and (int(LOWS[band + 1]) - 1) * 4 // 3 < n:
        return np.zeros(0, np.uint64), 0
    parts = parts_in(band)
    part = ((shingle_set >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # sorted, as the set is
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    content = np.bitwise_xor.reduceat(mixed(shingle_set ^ np.uint64(77)), starts)
    signs, slack = mixed(content + np.uint64(band * 1_000_003)), len(starts) - (2 * n // 7 if below else greatest(n))
    return (signs if slack > 0 else np.concatenate([signs, mixed(shingle_set + np.uint64(band * 2_000_003 + 1))])), slack


def greatest(n):
    """The greatest symmetric difference of a set of n and a linked set at least as large."""
    return (n + 4 * n // 3) // 7


def dense(shingle_set: np.ndarray) -> bytes:
    flips = np.bincount((mixed(shingle_set ^ np.uint64(1234567)) % np.uint64(DENSE)).astype(np.int64), minlength=DENSE) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def measure(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: id, n, class, dense sketch, and the slack of its parts in either band: parts less empty ones, less the greatest difference."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for piece in pieces(batches, text_col):
            out = []
            for text in as_bytes(piece.column(text_col)):
                s = shingles(text)
                n = len(s)
                if not n:
                    out.append((0, None, None, 0, 0))
                    continue
                out.append((n, class_of(s), dense(s), signatures(s, False)[1], signatures(s, True)[1]))
            ids = piece.column(id_col)
            schema = pa.schema([("id", ids.type), ("n", pa.int64()), ("cls", pa.int64()), ("sketch", pa.binary()), ("slack0", pa.int64()), ("slack1", pa.int64())])
            yield bundle(schema, ids, *map(list, zip(*out, strict=True)))

    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, n long, cls long, sketch binary, slack0 long, slack1 long")


_PACKED = pa.schema([("shard", pa.int32()), ("classes", pa.binary()), ("sizes", pa.binary()), ("owners", pa.binary()), ("signs", pa.binary())])


def _pack(shards: int, text_col: str):
    """For each piece of documents and each shard one row: the classes there and their sizes, and for each signature its owner (place, band) and 40 bits of it."""

    def run(batches):
        for piece in pieces(batches, text_col, 8192):
            sets = {class_of(s): s for text in as_bytes(piece.column(text_col)) if len(s := shingles(text))}
            if not sets:
                continue
            classes, sizes = np.array(list(sets), "<i8"), np.array([len(s) for s in sets.values()], "<u4")
            signs, owners = [], []
            for k, s in enumerate(sets.values()):
                for below in (False, True):
                    own = signatures(s, below)[0]
                    signs.append(own)
                    owners.append(np.full(len(own), 2 * k + below, "<u2"))
            signs, owners = np.concatenate(signs), np.concatenate(owners)
            shard = ((signs >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
            order = np.argsort(shard, kind="stable")
            signs, owners, shard = signs[order], owners[order], shard[order]
            low = signs.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
            cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
            rows = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own, place = np.unique(owners[a:b] >> 1, return_inverse=True)
                rows.append((int(shard[a]), classes[own].tobytes(), sizes[own].tobytes(), (place << 1 | owners[a:b] & 1).astype("<u2").tobytes(), low[a:b].tobytes()))
                if len(rows) == 64:
                    yield bundle(_PACKED, *map(list, zip(*rows, strict=True)))
                    rows = []
            if rows:
                yield bundle(_PACKED, *map(list, zip(*rows, strict=True)))

    return run


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("band", pa.int32())])


def _runs(table: pa.Table) -> pa.Table:
    """
    Of one shard: pairs (a, b, number of shared parts; band -1), and members of long runs (class, run, its length; band 0: own, 1: below).
    """
    signs, cls, size, below = [], [], [], []
    for classes, sizes, owners, low in zip(*(table.column(c).to_pylist() for c in ("classes", "sizes", "owners", "signs")), strict=True):
        own = np.frombuffer(owners, "<u2")
        wide = np.zeros((len(own), 8), np.uint8)
        wide[:, :5] = np.frombuffer(low, np.uint8).reshape(-1, 5)
        signs.append(wide.view("<u8").ravel())
        cls.append(np.frombuffer(classes, "<i8")[own >> 1])
        size.append(np.frombuffer(sizes, "<u4")[own >> 1])
        below.append((own & 1).astype(np.int8))
    signs, cls, size, below = map(np.concatenate, (signs, cls, size, below))
    order = np.lexsort((cls, signs))
    signs, cls, size, below = signs[order], cls[order], size[order], below[order]
    fresh = np.concatenate([[True], (signs[1:] != signs[:-1]) | (cls[1:] != cls[:-1])])
    signs, cls, size, below = signs[fresh], cls[fresh], size[fresh], below[fresh]
    starts = np.flatnonzero(np.concatenate([[True], signs[1:] != signs[:-1]]))
    lengths = np.diff(np.append(starts, len(signs)))
    many = np.repeat(lengths, lengths)
    keep = many > 1
    run, first, many = np.repeat(np.arange(len(starts)), lengths)[keep], np.repeat(cls[starts], lengths)[keep], many[keep]
    size_first = np.repeat(size[starts], lengths)[keep]
    signs, cls, size, below = signs[keep], cls[keep], size[keep], below[keep]
    a, b = [], []
    for k in range(1, RUN):
        at = np.flatnonzero((run[:-k] == run[k:]) & (many[:-k] <= RUN))
        near = 4 * np.minimum(size[at], size[at + k]).astype(np.int64) >= 3 * np.maximum(size[at], size[at + k]).astype(np.int64)
        a.append(cls[at[near]])
        b.append(cls[at[near] + k])
    long = many > RUN
    star = long & (cls != first) & (4 * np.minimum(size, size_first).astype(np.int64) >= 3 * np.maximum(size, size_first).astype(np.int64))
    a.append(first[star])
    b.append(cls[star])
    a, b = np.concatenate(a), np.concatenate(b)  # a < b, as classes are sorted within a run
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(a)))
    columns = (a[starts], cls[long]), (b[starts], signs[long].astype(np.int64)), (counts, many[long]), (np.full(len(starts), -1), below[long])
    return pa.Table.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND)


def _distance(x: list[bytes], y: list[bytes]) -> np.ndarray:
    x, y = (np.frombuffer(b"".join(v), np.uint64).reshape(len(v), -1) for v in (x, y))
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)


def _possible(batches):
    """Of pairs with what is known of both: those that may link."""
    for batch in batches:
        c = {n: batch.column(n) for n in batch.schema.names}
        get = lambda n, c=c: c[n].to_numpy().astype(np.int64)
        na, nb = get("n_a"), get("n_b")
        most = (na + nb) // 7
        small = np.minimum(na, nb)
        slack = np.where(na <= nb, get("slack_a") - get("common_a"), get("slack_b") - get("common_b")) + greatest(small) - most
        ok = get("shared") >= np.maximum(1, slack)
        at = np.flatnonzero(ok)
        if len(at):
            near = _distance(c["sketch_a"].take(pa.array(at)).to_pylist(), c["sketch_b"].take(pa.array(at)).to_pylist()) <= most[at]
            at = at[near]
        yield pa.RecordBatch.from_arrays([c["a"].take(pa.array(at)), c["b"].take(pa.array(at))], names=["a", "b"])


_WEAK = pa.schema([("run", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("side", pa.int32()), ("cls", pa.int64()), ("root", pa.int64()), ("skip", pa.int64())])


def _near_sets(batches):
    """Of each pair of blocks, the sets that may link with one of another component: sketches near enough, and neither both of one side nor of one skip."""
    part = 256
    for table in groups(batches, ("run", "i", "j")):
        cls, root, skip, n, side = (table.column(c).to_numpy() for c in ("cls", "root", "skip", "n", "side"))
        if len(cls) < 2 or (root == root[0]).all():
            continue
        bits = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(cls), -1)
        across, on = table.column("i")[0] != table.column("j")[0], np.zeros(len(cls), bool)
        for x in (slice(k, k + part) for k in range(0, len(cls), part)):
            for y in (slice(k, k + part) for k in range(x.start, len(cls), part)):
                ok = (root[x][:, None] != root[y][None]) & (skip[x][:, None] != skip[y][None]) & (4 * np.minimum(n[x][:, None], n[y][None]) >= 3 * np.maximum(n[x][:, None], n[y][None]))
                if across:
                    ok &= side[x][:, None] != side[y][None]
                p, q = np.nonzero(ok)
                near = np.bitwise_count(bits[x][p] ^ bits[y][q]).sum(axis=1, dtype=np.int64) <= (n[x][p] + n[y][q]) // 7
                on[p[near] + x.start] = on[q[near] + y.start] = True
        if on.any():
            yield from table.filter(pa.array(on)).select(_WEAK.names).cast(_WEAK).combine_chunks().to_batches()


def _joining(batches):
    """Of each pair of blocks with their sets: the links that join two components."""
    for table in groups(batches, ("run", "i", "j")):
        cls, root, skip, side = (table.column(c).to_numpy() for c in ("cls", "root", "skip", "side"))
        across = table.column("i")[0] != table.column("j")[0]
        sets = [np.frombuffer(x, np.uint64) for x in table.column("members").to_pylist()]
        sizes = np.array([len(s) for s in sets], np.int64)
        words = np.concatenate(sets)
        order = np.argsort(words, kind="stable")
        words, owner = words[order], np.repeat(np.arange(len(sets)), sizes)[order]  # whose each shingle is
        forest, out = Forest(), []
        for k, s in enumerate(sets):
            ok = (skip != skip[k]) & (np.arange(len(sets)) > k) & (4 * np.minimum(sizes, sizes[k]) >= 3 * np.maximum(sizes, sizes[k]))
            if across:
                ok &= side != side[k]
            if not ok.any():
                continue
            start, end = np.searchsorted(words, s, "left"), np.searchsorted(words, s, "right")
            times = end - start
            both = np.bincount(owner[np.arange(times.sum()) + np.repeat(start - np.cumsum(times) + times, times)], minlength=len(sets))
            for m in np.flatnonzero(ok & (100 * both >= 75 * (sizes + sizes[k] - both))).tolist():
                if forest.link(int(root[k]), int(root[m])):
                    out.append((int(cls[k]), int(cls[m])))
        if out:
            yield bundle(pa.schema([("a", pa.int64()), ("b", pa.int64())]), *map(list, zip(*out, strict=True)))


def _fits(most: Column) -> Column:
    """Sets in a block, by the size of the largest."""
    return F.greatest(F.lit(1), F.least(F.lit(BLOCK_SETS), F.floor(F.lit(BLOCK_SHINGLES) / most)))


def _side(blocks: str) -> Column:
    return F.pmod(F.xxhash64("cls"), F.col(blocks)).cast("int")


def _in_runs(members: DataFrame) -> DataFrame:
    """members: run, cls, root, n, sketch, skip. The pairs of blocks of each run that has more than one root and skip."""
    runs = members.groupBy("run").agg(F.count("*").alias("size"), F.max("n").alias("most"), F.min("root").alias("r0"), F.max("root").alias("r1"), F.min("skip").alias("s0"), F.max("skip").alias("s1"))
    runs = runs.where("r0 != r1 and s0 != s1").select("run", F.ceil(F.col("size") / _fits(F.col("most"))).cast("int").alias("blocks"))
    placed = members.join(runs, "run").withColumn("side", _side("blocks"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other")).drop("other", "blocks")


def _in_pairs(homes: DataFrame, pairs: DataFrame) -> DataFrame:
    """
    homes: home, cls, root, n, sketch. pairs: x, y. The pairs of blocks of each home and the sets of all smaller homes that
    it is paired with, so that a large home goes to its partners' blocks, not to each partner.
    """
    known = homes.groupBy("home").agg(F.count("*").alias("size"), F.max("n").alias("most"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    whole = F.struct("size", F.col("home").alias("name"), "most", "r0", "r1")
    for x in ("x", "y"):
        pairs = pairs.join(known.select(F.col("home").alias(x), whole.alias(f"k{x}")), x)
    pairs = pairs.where("kx.r0 != kx.r1 or ky.r0 != ky.r1 or kx.r0 != ky.r0")
    large, small = F.greatest("kx", "ky"), F.least("kx", "ky")
    pairs = pairs.select(large["name"].alias("run"), F.ceil(large["size"] / _fits(large["most"])).cast("int").alias("others"), F.when(large["r0"] == large["r1"], large["r0"]).alias("same"), small["name"].alias("home"))
    far = pairs.join(homes, "home").where("same is null or root != same").select("run", "others", "cls", "root", "n", "sketch", F.col("home").alias("skip"))
    far = written(far, "far")
    blocks = far.groupBy("run").agg(F.first("others").alias("others"), F.ceil(F.count("*") / _fits(F.max("n"))).cast("int").alias("own"))
    near = homes.join(blocks.select(F.col("run").alias("home"), F.col("others").alias("own"), F.col("own").alias("others")), "home").select(F.col("home").alias("run"), "cls", "root", "n", "sketch", F.col("home").alias("skip"), "own", "others", F.lit(0).alias("side"))
    far = far.join(blocks.select("run", "own"), "run").select("run", "cls", "root", "n", "sketch", "skip", "own", "others", F.lit(1).alias("side"))
    rows = near.unionByName(far).withColumn("mine", _side("own")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    first = F.col("side") == 0
    i, j = (2 * F.when(c, F.col("mine")).otherwise(F.col("other")) + k for k, c in enumerate((first, ~first)))
    return rows.select("run", "cls", "root", "n", "sketch", "skip", "side", i.alias("i"), j.alias("j"))


def _weak_links(spread: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Links between weak sets of different components, one for each two components that a pair of blocks joins."""
    near = spread.repartition("run", "i", "j").sortWithinPartitions("run", "i", "j").mapInArrow(_near_sets, "run long, i int, j int, side int, cls long, root long, skip long")
    near = written(near, f"{name}-near")
    whole = near.join(sets, "cls").repartition("run", "i", "j").sortWithinPartitions("run", "i", "j")
    return written(whole.mapInArrow(_joining, "a long, b long"), name)


def _links(batches):
    """Rows sorted by centre and part, its own first (without b): the pairs that link."""
    centre = None
    for batch in batches:
        a, b = [], []
        for x, y, members in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "members")), strict=True):
            s = np.frombuffer(members, np.uint64)
            if y is None:
                centre = s
                continue
            both = len(np.intersect1d(centre, s, assume_unique=True))
            if 100 * both >= 75 * (len(centre) + len(s) - both):
                a.append(x)
                b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _sets(docs: DataFrame, text_col: str, classes: DataFrame) -> DataFrame:
    """The sets of the classes in cls (and of a few others): a filter of fixed size tells which texts give theirs."""
    place = F.pmod("cls", F.lit(FILTER))
    maps = classes.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    bits = np.zeros((FILTER // 32768 + 2, 4096), np.uint8)
    for r in maps:
        bits[r.bucket] = np.frombuffer(bytes(r.bits), np.uint8)
    start = 1  # bucket 1 has the bits of 1 to 32768, bucket 0 those of 0 and below

    def has(cls: int, flat=bits.ravel()) -> bool:
        p = cls % FILTER
        bucket = 0 if p == 0 else start + (p - 1) // 32768
        bit = 0 if p == 0 else (p - 1) % 32768
        return bool(flat[bucket * 4096 + bit // 8] >> (bit % 8) & 1)

    def run(batches):
        schema, seen = pa.schema([("cls", pa.int64()), ("members", pa.binary())]), set()
        for piece in pieces(batches, text_col):
            out = []
            for text in as_bytes(piece.column(text_col)):
                s = shingles(text)
                if len(s) and has(c := class_of(s)) and c not in seen:
                    seen.add(c)
                    out.append((c, s.tobytes()))
            if len(seen) > 500_000:
                seen.clear()
            if out:
                yield bundle(schema, *map(list, zip(*out, strict=True)))

    return written(docs.select(text_col).mapInArrow(run, "cls long, members binary").dropDuplicates(["cls"]), "sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs of classes: those that link. A star's centre sends its set once to each part of its star, not with each link."""
    stars = pairs.groupBy("a").count().where(F.col("count") > STAR).select("a", F.ceil(F.col("count") / STAR).cast("int").alias("parts"))
    dealt = pairs.join(stars, "a", "left").withColumn("part", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int")).select("a", "b", "part")
    ends = dealt.join(sets.withColumnRenamed("cls", "b"), "b").select("a", "part", "b", "members")
    centres = dealt.select("a", "part").distinct().join(sets.withColumnRenamed("cls", "a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "members")
    rows = ends.unionByName(centres).repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return written(rows.mapInArrow(_links, "a long, b long"), "verified")


def _placed(docs: DataFrame, id_col: str, text_col: str, shard: int) -> DataFrame:
    """One row per document: id, n, cls, and its component's least id and class (nulls without a set)."""
    known = written(measure(docs, id_col, text_col), "measured")
    whole = known.agg(F.sum("n").alias("n"), F.count("*").alias("rows")).first()
    shards = max(1, -(-int(0.75 * (whole.n or 0)) // shard))
    found = docs.select(text_col).mapInArrow(_pack(shards, text_col), "shard int, classes binary, sizes binary, owners binary, signs binary")
    found = written(found.groupBy("shard").applyInArrow(_runs, "a long, b long, n long, band int"), "runs")
    long = found.where("band >= 0").select(F.col("a").alias("cls"), F.col("b").alias("run"), "n", "band")
    common = long.groupBy("cls").agg(F.count(F.when(F.col("band") == 0, 1)).alias("common0"), F.count(F.when(F.col("band") == 1, 1)).alias("common1"))
    classes = known.where("cls is not null").groupBy("cls").agg(*[F.first(c).alias(c) for c in ("n", "slack0", "slack1", "sketch")], F.min("id").alias("least"), F.count("*").alias("copies"))
    classes = written(classes.join(common, "cls", "left").fillna(0, ["common0", "common1"]), "classes")

    def side(x: str) -> DataFrame:
        return classes.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("slack0").alias(f"slack_{x}"), F.col("common0").alias(f"common_{x}"), F.col("sketch").alias(f"sketch_{x}"))

    pairs = found.where("band < 0").groupBy("a", "b").agg(F.sum("n").alias("shared"))
    pairs = written(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_possible, "a long, b long"), "pairs")
    weak = classes.where("slack0 <= common0 or slack1 <= common1").select("cls", "slack0", "slack1", "common0", "common1")
    members = long.join(weak, "cls").where("(band = 0 and slack0 <= common0) or (band = 1 and slack1 <= common1)").select("run", "n", "band", "cls")
    members = written(members, "weak")
    dropped(found)
    sets = _sets(docs, text_col, pairs.select(F.explode(F.array("a", "b")).alias("cls")).unionByName(members.select("cls")).distinct())
    links = _verified(pairs, sets)
    roots = components(links)
    if not members.isEmpty():
        homes = members.groupBy("cls", "band").agg(F.max(F.struct("n", "run"))["run"].alias("home"))
        members = written(members.join(homes, ["cls", "band"]).select("run", "cls", "home"), "members")
        homes = written(homes.select("home", "cls"), "homes-of")

        def rooted(rows: DataFrame) -> DataFrame:
            return rows.join(roots.select(F.col("a").alias("cls"), "b"), "cls", "left").withColumn("root", F.coalesce("b", "cls")).drop("b")

        def known_by(rows: DataFrame) -> DataFrame:
            return rows.join(classes.select("cls", "n", "sketch"), "cls")

        def more(spread: DataFrame, name: str) -> None:
            nonlocal links, roots
            found = _weak_links(spread, sets, name)
            if not found.isEmpty():
                links = links.unionByName(found)
                roots = components(links)

        more(_in_runs(known_by(rooted(homes)).select(F.col("home").alias("run"), "cls", "root", "n", "sketch", F.col("cls").alias("skip"))), "homes")
        # a run of a few homes gives their pairs, which many runs have in common; one of more homes is gone through itself
        met = rooted(members).groupBy("run", "home").agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
        runs = written(met.groupBy("run").agg(F.count("*").alias("homes"), F.min("r0").alias("r0"), F.max("r1").alias("r1")).where("homes > 1 and r0 != r1").select("run", "homes"), "runs-of")
        few = met.join(runs.where(F.col("homes") <= HOMES).select("run"), "run").groupBy("run").agg(F.array_sort(F.collect_list("home")).alias("homes"))
        two = few.select(F.posexplode("homes").alias("k", "x"), "homes").select("x", F.explode(F.slice("homes", F.col("k") + 2, F.size("homes"))).alias("y")).distinct()
        more(_in_pairs(known_by(rooted(homes)), written(two, "home-pairs")), "pairs-of-homes")
        many = members.join(runs.where(F.col("homes") > HOMES).select("run"), "run")
        more(_in_runs(known_by(rooted(many)).withColumnRenamed("home", "skip")), "between")
    dropped(sets)
    linked = roots.select(F.col("a").alias("cls"), F.col("b").alias("root")).unionByName(roots.select(F.col("b").alias("cls"), F.col("b").alias("root")).distinct())
    linked = linked.join(classes.select("cls", "least"), "cls")
    # a component may have any number of classes: it is joined in parts
    least = linked.groupBy("root").agg(F.min("least").alias("component_id")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    linked = linked.withColumn("part", F.pmod(F.xxhash64("cls"), F.lit(SALTS)).cast("int")).join(least, ["root", "part"]).select("cls", "root", "component_id")
    named = classes.select("cls", "least", "copies").join(linked, "cls", "left").select("cls", "copies", F.coalesce("root", "cls").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    named = written(named, "named")
    # classes of very many copies (HEAVY at most, as their rows add up to all rows) go to all tasks; their rows get keys that scatter them
    heavy = named.where(F.col("copies") > max(1000, whole.rows // HEAVY)).select("cls", F.struct("root", "component_id").alias("hot"))
    rows = known.select("id", "n", "cls").join(F.broadcast(heavy), "cls", "left").withColumn("key", F.when(F.col("hot").isNull(), F.col("cls")).otherwise(F.xxhash64("id", F.lit("hot"))))
    rows = rows.join(named.select(F.col("cls").alias("key"), F.struct("root", "component_id").alias("own")), "key", "left").withColumn("found", F.coalesce("hot", "own"))
    return rows.select("id", "n", "cls", "found.root", "found.component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """One row per document: id, n_shingles, component_id."""
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return _placed(docs, id_col, text_col, shard).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """
    One document of each group of near-duplicates (the one with the least id), with all its columns; rows without an id
    stay. Where rows repeat an id, each is judged by its own text, and one row of a group stays of those with its least id.
    """
    found = written(_placed(docs, id_col, text_col, SHARD).where("id is not null and cls is not null").select("id", "cls", "root", "component_id"), "kept")
    repeated = found.groupBy("id").count().where("count > 1").select("id")
    gone = found.where("id != component_id")
    if repeated.isEmpty():
        return docs.join(gone.select(F.col("id").alias(id_col)), id_col, "left_anti").select(*docs.columns)
    fields = ", ".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in docs.schema)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        for piece in pieces(batches):
            own = [class_of(s) if len(s := shingles(t)) else None for t in as_bytes(piece.column("text"))]
            yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(own, pa.int64())], names=["row", "cls"])

    rows = row.mapInArrow(run, f"row struct<{fields}>, cls long").withColumn("id", F.col("row")[id_col])
    judged = rows.join(found.select("id", "cls", "root", "component_id").distinct(), ["id", "cls"], "left")
    stay = judged.where("component_id is null").select("row.*")
    return stay.unionByName(judged.where("id = component_id").dropDuplicates(["root"]).select("row.*"))
