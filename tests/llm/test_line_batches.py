"""What line dedup sends to a Python worker at a time."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tablegate.llm import lines


def test_long_texts_come_in_small_batches(spark, monkeypatch):
    def bytes_at_once(texts: pd.Series, numbers: pd.Series, digest_lists: pd.Series) -> pd.DataFrame:
        size = sum(map(len, texts))
        return pd.DataFrame({"text": [str(size)] * len(texts), "removed": [[]] * len(texts)})

    monkeypatch.setattr(lines, "strip_lines", bytes_at_once)
    long_text = F.concat(F.col("id").cast("string"), F.repeat(F.lit(" word"), 10_000))
    docs = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), long_text.alias("text"))
    sizes = [int(r["clean_text"]) for r in lines.dedup_lines(docs).collect()]
    assert len(sizes) == 400
    assert max(sizes) <= 8 << 20


def test_frequent_words_are_counted_over_batches(spark, monkeypatch):
    docs = spark.createDataFrame([("A b\n c a ",), (None,), ("",), ("c a",)], "text string")
    words, total = lines.frequent_words(docs)
    assert total == 6
    assert sorted(words, key=words.get)[-2:] == [b"c", b"a"] and set(words) == {b"a", b"b", b"c"}
    assert lines.frequent_words(docs.filter("false")) == ({}, 0)
