"""Repeated passages from any word on, against brute force."""

from __future__ import annotations

import random
import re

import pytest

from tablegate.llm import windows

SCHEMA = "doc_id long, text string"


def brute(rows, least):
    """Spans of each distinct (doc_id, text), by comparing the words of all units."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    first, units = {}, []
    for at, (doc, text) in enumerate(docs):
        found = list(re.finditer(r"[^\x20\x09-\x0d]+", text))
        for i in range(len(found) - least + 1):
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


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["Über", "A", "a", "x.y", "日本", "End."]
    shared = [[rng.choice(words) for _ in range(90)] for _ in range(4)]
    made = [(0, None), (1, ""), (2, " \n"), (3, "a b c.")]
    for i in range(80):
        text = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):  # parts of passages, from any word to any word
            copy = rng.choice(shared)
            begin = rng.randint(0, 45)
            at = rng.randint(0, len(text))
            text[at:at] = copy[begin : begin + rng.randint(15, 80)]
        made.append((10 + i, "".join(w + rng.choice([" ", " ", "\n", "\t ", " \n "]) for w in text)))
    long_text = " ".join(rng.choice(words) for _ in range(9000))
    made += [(200, long_text), (201, "more " + long_text), (202, long_text[100:]), (203, "loop it " * 80)]
    made += [(204, "same " * 130), (205, "other " + "same " * 60)]
    return made + [made[20], made[21], (made[22][0], " ".join(shared[0])), (None, " ".join(shared[1])), (None, " ".join(shared[1]) + " z")]


@pytest.mark.parametrize("least, hot", [(50, 10_000), (20, 3), (7, 2)])
def test_against_brute_force(spark, rows, least, hot):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(str(tuple(r)) for r in windows.repeated_windows(docs, least, hot).collect())
    assert got == brute(rows, least) and len(got) > 10


def test_passage_without_sentences(spark):
    """A passage that begins and ends inside a line, among other words on each side."""
    rng = random.Random(2)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(52))
    made = [(i, " ".join([f"a{i}x{k}" for k in range(30 + i)] + [passage] + [f"b{i}x{k}" for k in range(9)])) for i in range(6)]
    got = sorted(map(tuple, windows.repeated_windows(spark.createDataFrame(made, SCHEMA)).collect()))
    assert got == [(i, t.index(passage), t.index(passage) + len(passage), 52, 0) for i, t in made[1:]]


def test_without_broadcast(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr("tablegate.llm.common.BROADCAST_LIMIT_BYTES", 0)
    got = sorted(str(tuple(r)) for r in windows.repeated_windows(docs, 20, 3).collect())
    assert got == brute(rows, 20)


def test_nothing_repeats(spark):
    made = [(i, " ".join(f"u{i}x{k}" for k in range(80))) for i in range(5)]
    assert windows.repeated_windows(spark.createDataFrame(made, SCHEMA)).count() == 0
    assert windows.repeated_windows(spark.createDataFrame([], SCHEMA)).count() == 0
