"""Benchmark decontamination by a prefix-filtered set join.

Words are the tokens. A window (13 consecutive words of an item, or the whole of a shorter one) can only occur in a
document that holds all its words, so the necessary prefix of a window is its rarest word: words are ordered by how often
all documents use them. Documents join with windows on that word alone. The positional bound puts the window's start in the
document, the length bound drops windows that would reach over either end, and the exact check compares outwards from the
rare word, for all windows of the item that lean on it at once.

Null or wordless documents have no words and are clean; null or wordless items have no windows; a null item_id is written
as the empty text; items that repeat count once by item_id; repeated documents are judged each for itself; an empty
benchmark leaves all documents clean. Other columns are not read.

The index over the benchmark is sent to the tasks in blocks of at most BLOCK_WORDS words; each block beyond the first
costs another pass over the documents.
"""

from __future__ import annotations

from collections import Counter, defaultdict, deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import as_bytes, bundle, pieces, written

WINDOW = 13
#: Benchmark words in an index that is sent to every task (about 100 bytes each).
BLOCK_WORDS = 1_000_000
#: Distinct words that a task counts before it drops those of no benchmark item.
COUNTED = 200_000

_word = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _word else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def word_counts(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """How often all documents use each word of the vocabulary (the result is bounded by the vocabulary)."""

    def run(batches):
        counts, total = Counter(), Counter()

        def keep():
            total.update({w: n for w, n in counts.items() if w in vocabulary})
            counts.clear()

        for piece in pieces(batches, text_col):
            for text in as_bytes(piece.column(text_col)):
                counts.update(words_of(text))
            if len(counts) > COUNTED:
                keep()
        keep()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    found = docs.select(text_col).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in found.collect()}


class WindowIndex:
    """For each rare word: the item, the word's place in it, and the first and last start of the windows that lean on it."""

    def __init__(self, items: list[tuple[str, list[bytes]]], counts: dict[bytes, int], window: int = WINDOW):
        self.items, self.window = items, window
        self.by_word: dict[bytes, list[tuple[int, int, int, int]]] = defaultdict(list)
        for k, (_, words) in enumerate(items):
            size, rank = min(window, len(words)), [(counts.get(w, 0), w) for w in words]
            low: deque[int] = deque()  # places of falling rarity: the first is the rarest of the window
            leans: dict[int, list[int]] = {}
            for end in range(len(words)):
                while low and rank[low[-1]] > rank[end]:
                    low.pop()
                low.append(end)
                start = end - size + 1
                if start >= 0:
                    while low[0] < start:
                        low.popleft()
                    leans.setdefault(low[0], [start, start])[1] = start
            for place, (first, last) in leans.items():
                self.by_word[words[place]].append((k, place, first, last))

    def find(self, words: list[bytes]) -> tuple[bytearray, set[str]]:
        """Which of a document's words are hit, and by which items."""
        hit, names, n, by_word = bytearray(len(words)), set(), len(words), self.by_word
        if by_word.keys().isdisjoint(words):
            return hit, names
        for at, word in enumerate(words):
            if word not in by_word:
                continue
            for k, place, first, last in by_word[word]:
                name, item = self.items[k]
                size, shift = min(self.window, len(item)), at - place
                first, last = max(first, -shift), min(last, n - size - shift)  # length: within the document
                if first > last:
                    continue
                left, right = place, place
                while left > first and words[left - 1 + shift] == item[left - 1]:
                    left -= 1
                while right < last + size - 1 and words[right + 1 + shift] == item[right + 1]:
                    right += 1
                first, last = max(first, left), min(last, right - size + 1)
                if first <= last:
                    hit[first + shift : last + size + shift] = b"\1" * (last + size - first)
                    names.add(name)
        return hit, names


def _items(benchmark: DataFrame, block: int, blocks: int) -> list[tuple[str, list[bytes]]]:
    rows = benchmark.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.col("text").cast("binary").alias("text")).distinct()
    return [(r.name, words) for r in rows.collect() if (words := words_of(bytes(r.text or b"")))]


def find_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", keep_text: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """
    One row per document: row (a struct of its other columns), its text if asked for, n_words, n_hit, hit (a byte for each
    word, 1 if it lies in an occurring window) and items (the item_ids, as text).
    """
    total = benchmark.select(F.sum(F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "a")) + 1).alias("n")).first().n or 0
    blocks = max(1, -(-total // block_words))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")
    out = docs.select(row, F.col(text_col).alias("text"), F.lit(None).cast("binary").alias("hit"), F.array().cast("array<string>").alias("items"))
    kind = out.schema["row"].dataType.simpleString()
    for block in range(blocks):
        items = _items(benchmark, block, blocks)
        index = WindowIndex(items, word_counts(docs, {w for _, ws in items for w in ws}, text_col) if items else {})
        final = block == blocks - 1
        texts = keep_text or not final

        def run(batches, index=index, final=final, texts=texts):
            for piece in pieces(batches):
                hits, names, sizes = [], [], []
                for text, before, held in zip(as_bytes(piece.column("text")), piece.column("hit").to_pylist(), piece.column("items").to_pylist(), strict=True):
                    words = words_of(text)
                    hit, found = index.find(words)
                    if before is not None:
                        hit = bytes(a | b for a, b in zip(hit, before, strict=True))
                    hits.append(bytes(hit))
                    names.append(sorted({*found, *held}))
                    sizes.append(len(words))
                fields = [("row", piece.column("row").type), *[("text", piece.column("text").type)] * texts, *[("n_words", pa.int64()), ("n_hit", pa.int64())] * final, ("hit", pa.binary()), ("items", pa.list_(pa.string()))]
                yield bundle(pa.schema(fields), piece.column("row"), *[piece.column("text")] * texts, *[sizes, [sum(h) for h in hits]] * final, hits, names)

        out = out.mapInArrow(run, f"row {kind}, {'text string, ' * texts}{'n_words long, n_hit long, ' * final}hit binary, items array<string>")
        if not final:
            out = written(out, "decontaminate")
    return out


#: At least a twentieth of the words is hit.
CONTAMINATED = "n_hit > 0 and 20 * n_hit >= n_words"


def judge(hits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256 and contaminated."""
    return hits.select(
        F.col("row")[id_col].alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        F.expr(CONTAMINATED).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    kept = find_hits(docs, benchmark, text_col, keep_text=True).where(f"not ({CONTAMINATED})")
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
