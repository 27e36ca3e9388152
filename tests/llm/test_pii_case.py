"""op6 and the pipeline's redaction: announcing words in any case."""

from __future__ import annotations

import pytest
from pairloom.llm.pii import lowered, redacted, spans_of


@pytest.mark.parametrize("text,kind,secret", [
    ("Account Number: 12345678", "account", "12345678"), ("ACCOUNT NUMBER: 12345678", "account", "12345678"), ("Account No. 12345678", "account", "12345678"), ("aCCt nr 12345678", "account", "12345678"),
    ("SSN No. 123-45-6789", "ssn", "123-45-6789"), ("Social Security Number 123-45-6789", "ssn", "123-45-6789"), ("Passport NO 123456789", "passport", "123456789"), ("Api_Key = 'Abcdefgh12'", "secret", "Abcdefgh12"),
    ("İİ é Account Number: 12345678", "account", "12345678"),
])
def test_cues_in_any_case(text, kind, secret):
    at = text.index(secret)
    assert (kind, at, at + len(secret)) in spans_of(text)
    assert secret not in redacted(text)


def test_lowered_keeps_places():
    assert lowered("\u0130Ab") == "\u0130ab" and lowered("\u212aEY") == "\u212aey"
    assert not spans_of("to\u212aen = abcdefgh") and spans_of("toKen = abcdefgh")
