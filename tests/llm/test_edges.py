"""Every operator and stage on odd rows and on empty tables."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import pytest
from pairloom.llm import bpe_codec, chat_format, decontaminate, embedding_dedup, lang_id, ngram_join, ngram_lm, pii, token_counts, toxicity

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
BENCH = "item_id string, text string, n_words long"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def operators(spark, docs, some):
    bench = spark.createDataFrame([("i1", "one two three four five six seven eight nine ten eleven twelve thirteen", 1), (None, "a", 1), ("i2", None, 1), ("i2", "", 1)] if some else [], BENCH)
    marks = labels(spark, [(i, i % 2) for i in range(14)] + [(1, None), (None, 1), (3, 0)] if some else [])
    yield "toxicity", toxicity.score(docs, toxicity.learn(docs, marks))
    yield "tokens", token_counts.over_limit(token_counts.count_tokens(docs, PIECES))
    yield "bpe", bpe_codec.decode(bpe_codec.encode(docs, BYTES), BYTES)
    yield "decontaminate", decontaminate.judge(decontaminate.find_hits(docs, bench))
    yield "pii", pii.digests(pii.find(docs))
    yield "lang", lang_id.predict(docs, lang_id.learn(docs))
    yield "join", ngram_join.near_duplicates(docs)
    yield "lm", ngram_lm.learn_and_score(docs, docs)


def test_odd_rows_give_one_row_each(spark, edge):
    n = edge.count()
    got = {name: df.toPandas() for name, df in operators(spark, edge, True)}
    assert {k: len(v) for k, v in got.items()} == dict.fromkeys(got, n)
    assert got["lang"].loc[got["lang"].doc_id.isin([0, 1, 2, 3, 5]), "lang_pred"].eq("und").all()
    assert got["toxicity"].score.between(0, 1).all()
    assert got["tokens"].set_index("doc_id").n_tokens.loc[[0, 1]].eq(0).all()
    join = got["join"].set_index("doc_id")
    assert join.n_shingles.loc[[0, 1, 2, 3]].eq(0).all() and join.component_id.loc[0] == 0
    assert join.component_id.loc[[8, 9, 10]].eq(8).all()
    assert join[join.index.isna() & (join.n_shingles > 0)].component_id.eq(8).all()
    lm = got["lm"].set_index("doc_id")
    assert lm.n_tokens.loc[[0, 1, 2, 3]].eq(1).all() and (lm.n_known == lm.n_tokens).all()


def test_empty_tables(spark, empty):
    for name, df in operators(spark, empty, False):
        assert df.count() == 0, name


def test_nothing_to_learn_from(spark, edge, empty):
    assert set(toxicity.score(edge, toxicity.learn(empty, labels(spark, []))).toPandas().score) == {0.0}
    assert set(lang_id.predict(edge, lang_id.learn(empty)).toPandas().lang_pred) == {"und"}
    lm = ngram_lm.learn_and_score(empty, edge).toPandas()
    assert lm.base_score.eq(0).all() and lm.n_known.eq(0).all() and lm.train_tokens.eq(0).all()


@pytest.mark.parametrize("k", range(5))
def test_stages(spark, edge, empty, tmp_path, k):
    spark.createDataFrame([("i1", "alpha beta", 1)], BENCH).write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (edge, empty):
        out = corpus_pipeline.STAGES[k][1](spark, docs, str(tmp_path))
        rows = out.count()
        assert rows <= docs.count()
        if k < 4:
            assert out.columns == docs.columns


def test_chat_edges(spark):
    rows = [(1, 0, "user", None, "x"), (1, 1, "assistant", "", "x"), (1, 1, "assistant", "", "x"), (None, None, None, None, None), (2, 0, "tool\n\\n", "<|im_end|> <\\| \\", "x"), (3, None, "assistant", "b", "x"), (3, None, "assistant", "a", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example string")
    got = chat_format.digests(chat_format.expand(turns)).toPandas().set_index("conv_id")
    assert len(got) == 4 and got.n_turns.loc[1] == 3 and got.loss_chars.loc[3] == 2
    assert chat_format.digests(chat_format.expand(turns.limit(0))).count() == 0


def test_embedding_edges(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 0.0], [1.0, 0.0], [2.0, 0.1], [0.0, 1.0], [1.0, 0.0, 0.0], [1e-300, 0.0]]
    rows = [(i, v, 0, 1) for i, v in enumerate(vectors)] + [(6, [1.0, 0.0], 0, 1), (None, [1.0, 0.0], 0, 1), (None, None, None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cid int, key int")
    got = embedding_dedup.near_duplicates(df).toPandas()
    assert len(got) == len(rows)
    by = got[got.vec_id.notna()].drop_duplicates("vec_id").set_index("vec_id")
    assert by.n_links.loc[[0, 1, 2, 3, 4, 5, 9, 10]].eq(0).all()
    assert by.component_id.loc[[6, 7, 8, 11]].eq(6).all() and by.n_links.loc[6] == 5
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
