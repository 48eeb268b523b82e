"""Repeated passages against brute force."""

from __future__ import annotations

import random
import re

import pytest

from tablegate.llm import passages

SCHEMA = "doc_id long, text string, lang string, begin int, span string, n int"


def brute(rows, least):
    """Spans of each distinct (doc_id, text), by comparing the words of all units."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    first, units = {}, []
    for at, (doc, text) in enumerate(docs):
        found = list(re.finditer(r"[^\x20\x09-\x0d]+", text))
        for i in range(len(found) - least + 1):
            if i == 0 or found[i - 1].group()[-1] in ".!?" or "\n" in text[found[i - 1].end() : found[i].start()]:
                words = tuple(m.group().encode().lower() for m in found[i : i + least])
                rank = (doc is not None, doc or 0, i)
                first[words] = min(first.get(words, rank), rank)
                units.append((at, i, found[i].start(), found[i + least - 1].end(), rank, words))
    spans = []
    for at, i, begin, end, rank, words in units:
        if rank == first[words]:
            continue
        if spans and spans[-1][0] == at and i <= spans[-1][2]:
            spans[-1][2], spans[-1][4] = i + least, max(end, spans[-1][4])
        else:
            known, doc, _ = first[words]
            spans.append([at, i, i + least, begin, end, doc if known else None])
    return sorted(map(str, ((docs[s[0]][0], s[3], s[4], s[2] - s[1], s[5]) for s in spans)))


def sentence(rng, words):
    return " ".join(rng.choice(words) for _ in range(rng.randint(1, 9))) + rng.choice([".", "!", "?", ",", ""])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)] + ["Über", "A", "a", "x.y"]
    shared = [" ".join(sentence(rng, words) for _ in range(12)) for _ in range(4)]
    made = [(0, None), (1, ""), (2, " \n"), (3, "a b c.")]
    for i in range(60):
        parts = [sentence(rng, words) for _ in range(rng.randint(0, 25))]
        if i % 3 == 0:
            copy = rng.choice(shared).split(" ")
            at = sorted(rng.sample(range(len(copy)), 3))
            for k in at:  # the same passage, broken into other lines
                copy[k] = rng.choice(["\n", "  ", "\t"]) + copy[k]
            parts.insert(rng.randint(0, len(parts)), rng.choice(["\n", "lead-in without an end "]) + " ".join(copy))
        made.append((10 + i, rng.choice([" ", "\n"]).join(parts)))
    long_text = " ".join(sentence(rng, words) for _ in range(3000))
    made += [(100, long_text), (101, long_text + " more."), (102, "start. " + long_text), (103, "loop it. " * 60)]
    return made + [made[20], made[21], (made[22][0], shared[0]), (None, shared[1]), (None, shared[1] + " z")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "en", 1, "clash", 2) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("least", [20, 50])
def test_against_brute_force(docs, rows, least):
    got = sorted(str(tuple(r)) for r in passages.repeated_passages(docs, least).collect())
    expected = brute(rows, least)
    assert got == expected and len(got) > 10


def test_hot_digests_are_split_off(spark, monkeypatch):
    text = "one two three four. " * 3
    many = spark.createDataFrame([(i, f"{text}{i % 40} and so on to the end.") for i in range(200)], "doc_id long, text string")
    expected = sorted(map(str, passages.repeated_passages(many, 8).collect()))
    monkeypatch.setattr("tablegate.llm.common.BROADCAST_LIMIT_BYTES", 0)
    monkeypatch.setattr(passages.with_firsts, "__defaults__", (20,))
    assert sorted(map(str, passages.repeated_passages(many, 8).collect())) == expected


def test_short_repeats_are_left_alone(spark):
    boiler = "All rights reserved by the owner of this page."
    table = spark.createDataFrame([(i, f"{boiler}\ntext {i}\n{boiler}") for i in range(50)], "doc_id long, text string")
    assert passages.repeated_passages(table).count() == 0


def test_empty(spark):
    assert passages.repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0
