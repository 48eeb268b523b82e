"""The pipeline as a whole: what each stage takes away, and what is left on disk."""

from __future__ import annotations

import os
import random

import corpus_pipeline


def test_run(spark, tmp_path):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(900)]

    def prose(n):
        own = [rng.choice(words) for _ in range(n)]
        return "\n".join(" ".join(own[i : i + 11]) for i in range(0, n, 11))

    clean = [(i, prose(90), "en", "s0") for i in range(40)]
    passage = prose(40).replace("\n", " ")
    made = [
        *clean,
        (100, "too short", "en", "s0"),
        (101, "again and again " * 40, "en", "s0"),
        (102, clean[3][1], "en", "s0"),
        (103, prose(60) + "\n" + passage, "en", "s0"),
        (104, prose(60) + "\n" + clean[5][1].split("\n")[2], "en", "s0"),
        (105, None, None, None),
        (None, prose(70), None, None),
    ]
    rows = [(*r, None if r[1] is None else len(r[1])) for r in made]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    result = corpus_pipeline.run(spark, str(tmp_path))
    found = {r["doc_id"]: r for r in result.collect()}
    stages = {name.replace(" ", "-") for name, _ in corpus_pipeline.STAGES}
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before} & stages
    assert left == {corpus_pipeline.STAGES[-1][0].replace(" ", "-")}

    # Stage by stage: what is there before the draws of the last stage.
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = {r["doc_id"]: r for r in docs.collect()}
    assert set(kept) == {*range(40), 104, None}
    assert kept[104]["text"].count("\n") == made[44][1].count("\n") - 1
    assert all(kept[i]["text"] == clean[i][1] for i in range(40))
    assert kept[104]["n_chars"] == len(kept[104]["text"])
    assert set(found) <= set(kept)
    assert all(found[doc]["text"] == kept[doc]["text"] for doc in found)
