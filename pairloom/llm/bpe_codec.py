"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct pre-tokens of a piece of rows form a trie, which is walked depth first, in sorted order, with a stack. The
state of a node is the last token of its prefix's encoding. A prefix's encoding ends in the one vocabulary suffix that
agrees with the state of the node before that suffix, so the state of each shared prefix is found once. A word's tokens
are read by going back from its end by whole tokens.

Two tokens agree if encoding their joined bytes gives the same two tokens; a sequence is the encoding of its bytes
exactly if all neighbours agree.

Nulls and empty texts have no tokens; each row is encoded for itself; other columns are not read. ids are packed as
little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import json
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from pairloom.llm.common import Recent, as_texts, bundle, kept, pieces

#: Distinct stretches of text in each generation, and pairs of tokens, that a worker remembers.
REMEMBERED, PAIRS = 80_000, 200_000
#: Unicode white space, and the published pre-token pattern of byte-level BPE.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: visible Latin-1 as itself, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def pack(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def token_bytes(spec: dict) -> list[bytes]:
    """The bytes of each id: all that decoding needs."""
    alphabet, added = byte_alphabet(), spec["added_tokens"]
    out = [b""] * (1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in added)]))
    for token, i in spec["model"]["vocab"].items():
        out[i] = bytes(alphabet[c] for c in token)
    for t in added:
        out[t["id"]] = t["content"].encode()
    return out


class BpeCodec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        pre = spec["pre_tokenizer"]
        if model["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            raise ValueError(f"{path}: not a plain byte-level BPE")
        raw = lambda token: bytes(alphabet[c] for c in token)
        self.ids = {raw(t): i for t, i in model["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(self.ids[raw(a)], self.ids[raw(b)]): (rank, self.ids[raw(a) + raw(b)]) for rank, (a, b) in enumerate(merges)}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take in their surroundings")
        self.added = {c: pack([i]) for c, i in added.items()}
        self.bytes = token_bytes(spec)
        #: Every ending of a token, with the token's id, or -1 if it is none itself.
        self.tails = {b[k:]: -1 for b in self.ids for k in range(1, len(b))} | self.ids
        self.cut = regex.compile(PATTERN).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")").split if added else lambda t: [t]
        self.has_added = lambda t: any(a in t for a in added)
        self.runs = re.compile(rf"[{SPACE}][{SPACE}]|^[{SPACE}]|[{SPACE}]$").search
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.agrees: dict[int, bool] = {}
        self.known = Recent(REMEMBERED)

    def merge(self, word: bytes) -> list[int]:
        """Plain merging by rank, of the bytes of one or two tokens."""
        out = [self.single[b] for b in word]
        while len(out) > 1:
            best, at = min(((r[0], i) for i in range(len(out) - 1) if (r := self.ranks.get((out[i], out[i + 1])))), default=(None, 0))
            if best is None:
                break
            out[at : at + 2] = [self.ranks[out[at], out[at + 1]][1]]
        return out

    def fits(self, before: int, token: int) -> bool:
        """Whether token may follow before (-1: stand first)."""
        key = (before + 1) << 32 | token
        if (found := self.agrees.get(key)) is None:
            if len(self.agrees) >= PAIRS:
                self.agrees.clear()
            both = self.bytes[before] + self.bytes[token] if before >= 0 else self.bytes[token]
            found = self.agrees[key] = self.merge(both) == ([before, token] if before >= 0 else [token])
        return found

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word; words are sorted and distinct."""
        tails, sizes, out, agrees, fits = self.tails, [len(b) for b in self.bytes], [], self.agrees, self.fits
        last, previous = [-1], b""  # last[i]: the last token of the first i bytes
        for word in words:
            n, shared, most = len(word), 0, min(len(word), len(previous))
            if word[:most] == previous[:most]:
                shared = most
            else:
                while word[shared] == previous[shared]:
                    shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, n + 1):
                for start in range(end - 1, -1, -1):
                    token = tails.get(word[start:end])
                    if token is None:
                        raise ValueError("a prefix without an encoding")
                    if token >= 0:
                        found = agrees.get((last[start] + 1) << 32 | token)
                        if found or found is None and fits(last[start], token):
                            last.append(token)
                            break
                else:
                    raise ValueError("a prefix without an encoding")
            got, at = [], n
            while at:
                got.append(last[at])
                at -= sizes[last[at]]
            got.reverse()
            out.append(pack(got))
            previous = word
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        rows = [self.stretches(t) for t in texts]
        new = self.known.missing(set().union(*rows))
        known = self.known.now
        known.update((w, self.added[w[2:]]) for w in new if w[:2] == "\n\n")
        cut = {w: self.cut(w[1:] if w[0] == " " else w if w[0] == "\n" else " " + w) for w in new if w[:2] != "\n\n"}
        words = sorted({w.encode() for ws in cut.values() for w in ws})
        packed = dict(zip(words, self.encode_words(words), strict=True))
        known.update((w, packed[ws[0].encode()] if len(ws) == 1 else b"".join([packed[x.encode()] for x in ws])) for w, ws in cut.items())
        return [b"".join(map(known.__getitem__, r)) for r in rows]

    def stretches(self, text: str) -> list[str]:
        """
        Parts of a text that are encoded each for itself. "\\n\\nx" is an added token x, " x" is x, "\\nx" is itself, and any
        other x is " x": pre-tokens take in one space before them, and where no two white space characters meet, each
        space begins a pre-token and each line feed is one.
        """
        if not text:
            return []
        if self.has_added(text):
            return [w for i, p in enumerate(self.special(text)) for w in (["\n\n" + p] if i % 2 else [" " + x for x in self.cut(p)])]
        if self.runs(text):
            return [" " + x for x in self.cut(text)]
        out = text.replace("\n", " \n").split(" ")
        out[0] = " " + out[0]
        return out

    def decode(self, packed: list[bytes]) -> list[str]:
        return unpack(packed, self.bytes)


def unpack(packed: list[bytes], table: list[bytes]) -> list[str]:
    return [b"".join([table[i] for i in np.frombuffer(p, "<u4").tolist()]).decode("utf-8", "replace") for p in packed]


def codec(path: str) -> BpeCodec:
    return kept(("bpe", path), lambda: BpeCodec(path))


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens and ids (packed), and if asked for decoded, the text of the packed ids (by the same worker)."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for piece in pieces(batches, text_col, key=("bpe", path)):
            ids, packed = piece.column(id_col), codec(path).encode(as_texts(piece.column(text_col)))
            more = [codec(path).decode(packed)] * decoded
            schema = pa.schema([(id_col, ids.type), ("n_tokens", pa.int64()), ("ids", pa.binary()), *[("decoded", pa.string())] * decoded])
            yield bundle(schema, ids, [len(p) // 4 for p in packed], packed, *more)

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids binary{', decoded string' * decoded}")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: the other columns, with decoded (the text of the packed ids) appended; a column of that name gives way."""
    df = df.drop("decoded")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def run(batches):
        with open(path, encoding="utf-8") as f:
            table = token_bytes(json.load(f))
        for piece in pieces(batches, ids_col, key=("bpe", path)):
            texts = unpack([x or b"" for x in piece.column(ids_col).to_pylist()], table)
            yield piece.append_column("decoded", pa.array(texts, pa.string()))

    return df.mapInArrow(run, f"{fields}, decoded string")
