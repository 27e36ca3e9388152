"""Language identification by rank-order profiles.

A language's profile is its TOP most frequent n-grams (1 to 3 letters of words with a mark at each end) in order of
frequency. A document's own profile is compared to each by out-of-place distance: the sum of how far each of its n-grams is
from its place in the language's profile, TOP for one that is not there. The nearest language is predicted.

Null texts and texts without a letter are ``und`` with score 0; so is everything if no language was learned. Ties go to the
language that sorts first. Repeated rows are judged each for itself; other columns are not read.

Profiles are learned from about TRAIN_DOCS labelled documents of each language, chosen by a hash of the id (all of them,
if there are fewer); whole texts count.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import Recent, as_texts, bundle, pieces

TOP, SIZES, TRAIN_DOCS = 300, (1, 2, 3), 5_000
#: Distinct words in each generation that a worker remembers, and n-grams that it numbers before it begins anew.
WORDS, GRAMS = 100_000, 100_000

#: Letters with the marks that follow them; superscripts, fractions and numerals that are no letters do not count.
_words = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall


def grams_of(word: str) -> list[str]:
    marked = f"_{word}_"
    return [g for n in SIZES for i in range(len(marked) - n + 1) if (g := marked[i : i + n]) != "_"]


class Profiler:
    """Numbers n-grams, and gives a document's most frequent ones."""

    def __init__(self, profiles: dict[str, list[str]]):
        self.langs = sorted(profiles)
        known = sorted({g for p in profiles.values() for g in p})
        self.column = {g: i for i, g in enumerate(known)}
        self.places = np.full((len(self.langs), len(known) + 1), -1, np.int64)  # the last column: in no profile
        for i, lang in enumerate(self.langs):
            for place, g in enumerate(profiles[lang]):
                self.places[i, self.column[g]] = place
        self.forget()

    def forget(self) -> None:
        self.words = Recent(WORDS)
        self.ids: dict[int, int] = {}
        self.ties = np.zeros(1024, np.int64)
        self.columns = np.zeros(1024, np.int64)

    def number(self, code: int) -> int:
        """The number of an n-gram, given as its code points (21 bits each)."""
        if (i := self.ids.get(code)) is None:
            i = self.ids[code] = len(self.ids)
            if i == len(self.ties):
                self.ties, self.columns = (np.concatenate([a, np.zeros(len(a), np.int64)]) for a in (self.ties, self.columns))
            gram = "".join(chr(c) for k in range(3) if (c := code >> 21 * k & 0x1FFFFF))
            self.ties[i] = (1 << 32) - 1 - zlib.crc32(gram.encode())
            self.columns[i] = self.column.get(gram, len(self.column))
        return i

    def learn_words(self, new: list[str]) -> None:
        """The n-grams of many words at once, as grams_of() has them."""
        points = np.frombuffer("".join([f"_{w}_" for w in new]).encode("utf-32-le"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, new), np.int64, len(new)) + 2
        word = np.repeat(np.arange(len(new)), sizes)
        room = np.cumsum(sizes)[word] - np.arange(len(points))  # points up to the word's end
        after = np.concatenate([points, [0, 0]])
        two = points | after[1:-1] << 21
        codes = np.stack([points, two, two | after[2:] << 42], 1)
        real = room[:, None] >= np.array(SIZES)
        real[:, 0] &= points != ord("_")
        found, at = np.unique(codes[real], return_inverse=True)
        ids = np.fromiter(map(self.number, found.tolist()), np.int32, len(found))[at]
        ends = np.cumsum(np.bincount(np.repeat(word[:, None], 3, 1)[real], minlength=len(new)))
        self.words.now.update(zip(new, np.split(ids, ends[:-1]), strict=True))

    def top(self, counts: Counter) -> np.ndarray:
        """Profile columns of the most frequent n-grams, most frequent first (ties by a checksum)."""
        known = self.words.now
        lists = [known[w] for w in counts]
        ids = np.concatenate(lists)
        weight = np.repeat(np.fromiter(counts.values(), np.int64, len(counts)), np.fromiter(map(len, lists), np.int64, len(lists)))
        if len(ids) * 8 < len(self.ids):
            at, where = np.unique(ids, return_inverse=True)
            total = np.bincount(where, weight)
        else:
            total = np.bincount(ids, weight)
            at = np.flatnonzero(total)
            total = total[at]
        key = total.astype(np.int64) << 32 | self.ties[at]
        if len(key) > TOP:
            best = np.argpartition(-key, TOP)[:TOP]
            key, at = key[best], at[best]
        return self.columns[at[np.argsort(-key, kind="stable")]]

    def judge(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score of each text."""
        if not self.langs:
            return [("und", 0.0)] * len(texts)
        if len(self.ids) > GRAMS:
            self.forget()
        counts = [Counter(_words(t.lower())) for t in texts]
        if new := list(self.words.missing(set().union(*counts))):
            self.learn_words(new)
        return [self.nearest(c) if c else ("und", 0.0) for c in counts]

    def nearest(self, counts: Counter) -> tuple[str, float]:
        columns = self.top(counts)
        places = self.places[:, columns]
        distance = np.where(places < 0, TOP, np.abs(places - np.arange(len(columns)))).sum(1)
        best = int(np.argmin(distance))
        return self.langs[best], float(1 - distance[best] / (TOP * len(columns)))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_docs: int = TRAIN_DOCS) -> dict[str, list[str]]:
    """Profiles of the languages of labelled documents; only TOP n-grams of each language reach the driver."""
    labelled = docs.where(F.col(lang_col).isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy(lang_col).count().collect()}
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1.0, train_docs / n) * (1 << 30)))])
    chosen = labelled.where(F.pmod(F.xxhash64(F.lit("lang-id"), id_col), F.lit(1 << 30)) < share[F.col(lang_col)]).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def count(batches):
        totals: dict[str, Counter] = {}

        def out():
            rows = [(lang, g, n) for lang, c in totals.items() for g, n in c.items()]
            totals.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "gram", "n"])

        for piece in pieces(batches):
            words: dict[str, Counter] = {}
            for lang, text in zip(piece.column("lang").to_pylist(), as_texts(piece.column("text")), strict=True):
                words.setdefault(lang, Counter()).update(_words(text.lower()))
            for lang, c in words.items():
                total = totals.setdefault(lang, Counter())
                for w, n in c.items():
                    for g in grams_of(w):
                        total[g] += n
            if sum(map(len, totals.values())) > GRAMS:
                yield out()
        yield out()

    grams = chosen.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = [F.desc("n"), F.col("gram")]
    # the best of each slice of a language's n-grams first, so that no task holds a whole language
    best = grams.withColumn("slice", F.pmod(F.xxhash64("gram"), F.lit(16))).withColumn("k", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("k") <= TOP)
    best = best.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("k") <= TOP)
    profiles: dict[str, list[str]] = {}
    for r in sorted(best.select("lang", "k", "gram").collect()):
        profiles.setdefault(r.lang, []).append(r.gram)
    return profiles


def predict(docs: DataFrame, profiles: dict[str, list[str]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred and score (1: exactly the language's profile; 0: nothing of it)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        profiler = Profiler(profiles)
        for piece in pieces(batches, text_col):
            judged = profiler.judge(as_texts(piece.column(text_col)))
            ids = piece.column(id_col)
            yield bundle(pa.schema([(id_col, ids.type), ("lang_pred", pa.string()), ("score", pa.float64())]), ids, [x for x, _ in judged], [x for _, x in judged])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


#: Below this a text is of no language that was learned.
LEAST_SCORE = 0.1


def keep(docs: DataFrame, profiles: dict[str, list[str]], text_col: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """The documents of a learned language (neither ``und`` nor below the least score), with all their columns. Without languages all stay."""
    if not profiles:
        return docs
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches):
        profiler = Profiler(profiles)
        for piece in pieces(batches, text_col):
            judged = profiler.judge(as_texts(piece.column(text_col)))
            yield piece.filter(pa.array([lang != "und" and score >= least for lang, score in judged], pa.bool_()))

    return docs.mapInArrow(run, fields)
