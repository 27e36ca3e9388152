"""Long pre-tokens, letters, random starts of the classifier, and SQL of the operators."""

from __future__ import annotations

import os
import random
import shutil
import subprocess
import sys
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from pairloom.llm import catalog, lang_id, oracle, toxicity
from pairloom.llm.token_counts import PieceCounter

PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def test_long_pre_tokens_equal_the_library():
    rng, want, mine = random.Random(8), sentencepiece.SentencePieceProcessor(model_file=PIECES), PieceCounter(PIECES)
    words = ["the", "ation", "er", "ing", "un", "re", "a", "b", "日", "é", "12", "'s", "http://", "==", "aa", "aaa"]
    texts = [unit * (n // len(unit) + 1) for n in (1, 2, 3, 191, 192, 193, 1000, 5000) for unit in ("a", "ab", "aab", "the", "=", "-=", "xyx", "日本")]
    texts += ["".join(rng.choice(words) for _ in range(n)) for n in (5, 50, 60, 70, 400, 3000) for _ in range(6)]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (190, 200, 2000, 10_000)] + ["ab" * 25_000]
    assert mine.count(texts) == [len(x) for x in want.encode(texts, num_threads=1)]


def test_what_is_no_letter_is_no_language(spark):
    rows = [(0, "² ½ Ⅷ ① ٣ _"), (1, "été est la"), (2, "中"), (3, "⁴⁵ 12"), (4, None), (5, "")]
    found = lang_id.predict(spark.createDataFrame(rows, "doc_id long, text string"), {"fr": ["_e", "es", "st", "la"]}).toPandas().set_index("doc_id")
    assert [found.lang_pred[i] for i in range(6)] == ["und", "fr", "fr", "und", "und", "und"]
    assert lang_id._words("été") == ["été"]


def test_out_of_place_distance_against_a_plain_form():
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    texts = [t for t in docs.text.dropna() if t.strip()][:60]
    profiles = {}
    for lang, part in docs.groupby("lang"):
        counts = {}
        for t in part.text.dropna():
            for w in lang_id._words(t.lower()):
                for g in lang_id.grams_of(w):
                    counts[g] = counts.get(g, 0) + 1
        profiles[lang] = sorted(counts, key=lambda g: (-counts[g], g))[: lang_id.TOP]

    def plain(text):
        counts = {}
        for w in lang_id._words(text.lower()):
            for g in lang_id.grams_of(w):
                counts[g] = counts.get(g, 0) + 1
        if not counts:
            return "und", 0.0
        own = sorted(counts, key=lambda g: (-counts[g], zlib.crc32(g.encode())))[: lang_id.TOP]
        far = {lang: sum(abs(p.index(g) - k) if g in p else lang_id.TOP for k, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        return best, 1 - far[best] / (lang_id.TOP * len(own))

    got = lang_id.Profiler(profiles).judge(texts)
    assert [x for x, _ in got] == [plain(t)[0] for t in texts]
    assert np.allclose([x for _, x in got], [plain(t)[1] for t in texts])


def test_a_random_start_learns():
    sf = "/root/testdata/sf0.1"
    marked = pd.read_parquet(f"{sf}/documents.parquet").merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    marked["words"] = [toxicity.hashed((t or "").encode()).astype(np.int64) for t in marked.text]
    held = marked.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    train, rest = marked[~held], marked[held]
    model = toxicity.fit(train.words.tolist(), train.toxic.tolist(), train.lang.fillna("").tolist(), evidence=False)
    rank, n = pd.Series(model.score(rest.words.tolist())).rank().to_numpy(), int(rest.toxic.sum())
    assert (rank[rest.toxic == 1].sum() - n * (n + 1) / 2) / (n * (len(rest) - n)) > 0.85


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in "documents embeddings benchmark conversations".split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(oracle.ORACLE[name]).df()
    got = catalog.QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    key = want.columns[0]
    pd.testing.assert_frame_equal(got.sort_values(key, ignore_index=True), want.sort_values(key, ignore_index=True), check_dtype=False)


@pytest.mark.parametrize("case", ["gone", "only caches left", "a library is missing"])
def test_the_entry_without_the_subpackage(tmp_path, case):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{root}/pairloom", tmp_path / "pairloom", ignore=shutil.ignore_patterns("__pycache__"))
    for f in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(f"{root}/{f}", tmp_path)
    before = ""
    if case == "a library is missing":
        before = "import sys; sys.modules['ahocorasick'] = None; "
    else:
        shutil.rmtree(tmp_path / "pairloom/llm")
        if case == "only caches left":
            (tmp_path / "pairloom/llm/__pycache__").mkdir(parents=True)
        else:
            os.unlink(tmp_path / "corpus_pipeline.py")
    code = before + "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 150 and not any(n.startswith('op1') for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
