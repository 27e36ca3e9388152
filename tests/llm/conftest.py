from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, score double, hit string, row string, decoded string, cls string, part string"
LONG = "Lorem ipsum dolor sit amet " * 20_000
NEAR = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"


def edge_rows():
    """Nulls everywhere, empty and very long texts, ties, repeated rows, and extra columns with the operators' own names."""
    texts = [None, "", " ", "\n", "a", "123 !!", LONG, "x" * 50_000, NEAR, NEAR, NEAR + " more", "Ça va très bien, merci <|endoftext|> ▁ \x00 😀", "mail a.b@c.de or +1 (555) 123-4567 from 10.0.0.1", "日本語テキスト"]
    rows = [(i, t, "en" if i % 3 else None, None, None if t is None else len(t), 1, 0.5, "h", "r", "d", "c", "p") for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, NEAR, "en", None, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
