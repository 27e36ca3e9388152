"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, URL schemes and words that announce an
identifier. From each anchor a local parser goes outwards to the boundaries and checks what it found (octets, digit
counts, Luhn and mod-97 sums); what fails is dropped and not tried again from within.

Base kinds are email, ip, card and phone, each leftmost and without overlaps among its own kind. The method adds login (user and
password in a URL), iban, ssn, account, passport and secret, which need a scheme or an announcing word. Spans are in code points,
end exclusive.

Nulls and empty texts have no spans; repeated rows are searched each for itself; other columns are not read by find().
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import as_texts, bundle, pieces

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "iban", "ssn", "account", "passport", "secret")
ORDER = {k: i for i, k in enumerate(KINDS)}

#: Words that announce an identifier, and its kind.
CUES = {
    "iban": "iban", "ssn": "ssn", "social security": "ssn", "account": "account", "acct": "account", "konto": "account", "cuenta": "account", "compte": "account",
    "passport": "passport", "reisepass": "passport", "passeport": "passport", "pasaporte": "passport",
    "api_key": "secret", "apikey": "secret", "api-key": "secret", "secret": "secret", "password": "secret", "passwd": "secret", "token": "secret",
}

LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_ip = re.compile(r"[0-9]+(?:\.[0-9]+){3}").match
_digits = re.compile(r"[0-9]+").match
_card = re.compile(r"[0-9](?:[ -]?[0-9])+").match
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").match
_userinfo = re.compile(r"[^\s/?#@]+(?=@)").match
#: What may stand between an announcing word and what it announces, then the identifier itself.
_after = {
    "iban": re.compile(r"[:#\s]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])").match,
    "ssn": re.compile(r"(?:\s+(?i:no|number|nr))?\.?[:#\s]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])").match,
    "account": re.compile(r"(?:\s+(?i:no|number|nr|num))?\.?[:#\s]{0,4}([0-9](?:[ -]?[0-9]){5,17})(?![0-9])").match,
    "passport": re.compile(r"(?:\s+(?i:no|number|nr))?\.?[:#\s]{0,4}([A-Z]{0,2}[0-9]{6,9})(?![A-Za-z0-9])").match,
    "secret": re.compile(r"[\"']?\s{0,3}[:=]\s{0,3}[\"']?([^\s\"']{8,})").match,
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    text = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in text)) % 97 == 1


def _automaton() -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for c in "0123456789":
        auto.add_word(c, ("digit", 1))
    auto.add_word("@", ("at", 1))
    auto.add_word("+", ("plus", 1))
    auto.add_word("://", ("scheme", 3))
    for word, kind in CUES.items():
        auto.add_word(word, (kind, len(word)))
    auto.make_automaton()
    return auto


_AUTO = None
_LOWER = {c: c + 32 for c in range(65, 91)}


def lowered(text: str) -> str:
    """ASCII letters in lower case, each at its place."""
    low = text.lower()
    # no other letter than the Kelvin sign becomes a single ASCII one
    return low if len(low) == len(text) and "\u212a" not in text else text.translate(_LOWER)


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind."""
    global _AUTO
    if _AUTO is None:
        _AUTO = _automaton()
    out = []
    add = out.append
    email_end = ip_end = card_end = at_end = run_end = 0
    for last, (what, size) in _AUTO.iter(lowered(text)):
        at = last - size + 1
        if what == "digit":
            if at < run_end:
                continue
            run_end = _digits(text, at).end()
            if at >= ip_end and text[run_end : run_end + 1] == "." and (m := _ip(text, at)):
                ip_end = m.end()
                # leading zeros do not matter; int() of very long digits is refused by Python, so strip them first
                if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m[0].split(".")):
                    add(("ip", at, ip_end))
            if at >= card_end and (m := _card(text, at)):
                card_end = m.end()
                if 14 <= card_end - at <= 37 and 14 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
                    add(("card", at, card_end))
        elif what == "at":
            low = max(email_end, at_end)
            start = low + len(text[low:at].rstrip(LOCAL))
            at_end = at + 1
            if start < at and (m := _domain(text, at + 1)):
                email_end = m.end()
                add(("email", start, email_end))
        elif what == "plus":
            if (m := _phone(text, at)) and 10 <= sum(map("0123456789".__contains__, m[0])) <= 15:
                add(("phone", at, m.end()))
        elif what == "scheme":
            if at and text[at - 1].isalnum() and (m := _userinfo(text, last + 1)):
                add(("login", m.start(), m.end()))
        elif (not at or not text[at - 1].isalnum()) and (m := _after[what](text, last + 1)):
            if what != "iban" or mod97(m[1].replace(" ", "")):
                add((what, m.start(1), m.end(1)))
    return sorted(set(out), key=lambda s: (s[1], ORDER[s[0]], s[2]))


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and spans (kind, start, end), by start, then kind."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for piece in pieces(batches, text_col):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t)] for t in as_texts(piece.column(text_col))]
            ids = piece.column(id_col)
            yield bundle(pa.schema([(id_col, ids.type), ("spans", pa.list_(span))]), ids, found)

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def written_spans(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    def of(kind: str):
        return lambda s: s["kind"] == kind

    count = [F.size(F.filter("spans", of(k))).cast("long").alias(f"n_{k}") for k in BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    every = [F.size("spans").cast("long").alias("n_spans"), (F.size("spans") > 0).alias("has_pii")]
    return found.select(id_col, *count, F.sha2(written_spans(base), 256).alias("base_sha256"), written_spans(F.col("spans")).alias("spans"), *every)


def redacted(text: str) -> str:
    """The text with each stretch of touching or overlapping spans written as <KIND> of its first."""
    out, at, end = [], 0, 0
    for kind, a, b in spans_of(text):
        if a >= end:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = end = max(end, b)
    return "".join([*out, text[at:]]) if out else text


def redact(df: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with redacted texts; nulls stay null. chars_col, if there is one, is counted anew."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    at = df.columns.index(text_col)

    def run(batches):
        for piece in pieces(batches, text_col):
            texts = pa.array([t if t is None else redacted(t) for t in piece.column(text_col).to_pylist()], piece.schema.field(text_col).type)
            yield piece.set_column(at, piece.schema.field(text_col), texts)

    out = df.mapInArrow(run, fields)
    if chars_col in df.columns:
        out = out.withColumn(chars_col, F.when(F.col(text_col).isNull(), F.col(chars_col)).otherwise(F.length(text_col)).cast(df.schema[chars_col].dataType))
    return out
