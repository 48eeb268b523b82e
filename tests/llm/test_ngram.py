"""The language model where every n-gram repeats often, and what it leaves behind."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pytest

from tablegate.llm import common, ngram
from tests.llm.test_corpus import brute_trigram_scores


@pytest.mark.parametrize("texts", [["a b c"] * 12, ["a b c"] * 12 + ["a b d"], ["a b c d e"] * 6 + ["x y"] * 9, ["a"] * 15])
def test_trigrams_seen_five_times_or_more(spark, texts):
    rows = [(i, text) for i, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in ngram.trained_and_scored(table, order=3).collect()}
    expected = {doc: score for doc, _, score in brute_trigram_scores(rows)}
    assert got.keys() == expected.keys()
    assert np.allclose([got[d] for d in expected], list(expected.values()), rtol=1e-9)


def test_model_is_removed_when_a_step_fails(spark, monkeypatch):
    def broken(*args):
        raise RuntimeError("no scores")

    folder = spark.conf.get("spark.checkpoint.dir")
    before = {name for name in os.listdir(folder) if name.startswith("ngram-model")}
    monkeypatch.setattr(ngram, "scores", broken)
    table = spark.createDataFrame([(1, "a b c"), (2, "a b d")], "doc_id long, text string")
    with pytest.raises(RuntimeError, match="no scores"):
        ngram.trained_and_scored(table, order=3)
    assert {name for name in os.listdir(folder) if name.startswith("ngram-model")} == before


def test_too_many_words_are_refused(spark, monkeypatch):
    monkeypatch.setattr(ngram, "MOST_WORDS", 3)
    table = spark.createDataFrame([(i, "a b c d e") for i in range(5)], "doc_id long, text string")
    with pytest.raises(ValueError, match="different words"):
        ngram.trained_and_scored(table, order=3)


def test_few_open_maps(spark, monkeypatch):
    """With one map at a time the scores are the same."""
    monkeypatch.setattr(ngram, "MOST_MAPS", 1)
    monkeypatch.setattr(ngram, "TOKENS_PER_SHARD", 50)
    rows = [(i, f"a b c {i % 7} d {i % 5} e a b") for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in ngram.trained_and_scored(table, order=3).collect()}
    for doc, _, score in brute_trigram_scores(rows):
        assert np.isclose(got[doc], score, rtol=1e-9)


def test_words_and_bigrams_are_looked_up_once(spark, tmp_path, monkeypatch):
    """However often a batch holds an n-gram, its arrays are searched once for it."""
    table = spark.createDataFrame([("a b c " * 500,), ("b a d",)], "text string")
    model = ngram.train(table, str(tmp_path), order=3)
    looked_up = []

    def counted(known, codes, found_in=ngram.found_in):
        looked_up.append(len(codes))
        return found_in(known, codes)

    monkeypatch.setattr(ngram, "found_in", counted)
    scorer = ngram.Scorer(model)
    for tokens in ngram.batches_of_tokens([pa.array(["a b c " * 500, "a b c " * 500])]):
        assert len(tokens.index) == 3002
        scorer.score(tokens)
    assert 0 < sum(looked_up) <= 12


def test_tokens_are_those_of_split_bytes(monkeypatch):
    monkeypatch.setattr(common, "BYTES_AT_ONCE", 8)
    monkeypatch.setattr(ngram, "TOKENS_AT_ONCE", 5)
    odd = "".join(f"A{chr(c)}Z" for c in range(256))
    texts = ["", None, "  ", "\x0b a\x1cB \u00c9a\x00\n", odd, "x " * 40, None, "y"]
    got = []
    for tokens in ngram.batches_of_tokens([pa.array(texts, pa.string()), pa.array([], pa.string())]):
        ends = np.cumsum(tokens.lengths)
        for a, b in zip(ends - tokens.lengths, ends):
            got.append([tokens.words[i] for i in tokens.index[a:b]])
    assert got == [(t or "").encode().lower().split() + [ngram.END] for t in texts]


def test_blocks_come_back_whole():
    codes = np.array([0, 5, 7 << 32, 7 << 32 | 3, (1 << 62) | (1 << 31)], np.int64)
    counts = np.array([1, 2, 70000, 255, 256], np.int64)
    for n in (0, 1, 5):
        for got, expected in zip(ngram.unpack(ngram.pack(codes[:n], counts[:n])), (codes[:n], counts[:n])):
            assert got.tolist() == expected.tolist()


def test_texts_without_words():
    (tokens,) = ngram.batches_of_tokens([pa.array(["", None, " "], pa.string())])
    assert (tokens.words, tokens.index.tolist(), tokens.lengths.tolist()) == ([ngram.END], [0, 0, 0], [1, 1, 1])
