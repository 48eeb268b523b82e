"""The pairs of lines that line dedup looks at: split words, their order, packed postings."""

from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablegate.llm import lines

T = Fraction(4, 5)


def code(codes, word):
    return int(codes[int(lines.hashes_of(pa.array([word], pa.binary()))[0]) & (lines.BUCKETS - 1)])


def bit(word):
    hashes = lines.hashes_of(pa.array([word.encode()], pa.binary()))
    return int(lines.mixed(hashes, 5)[0]) & 63


def packed(spark, docs):
    order, total = lines.word_order(docs, lines.FREQUENT)
    codes = spark.sparkContext.broadcast(order)
    sets = lines.line_sets(docs, codes, T).withColumn("open", F.lit(False))
    return lines.postings(sets, codes, T, lines.GROUPS)


TEXTS = [
    None, "", "\n", "a\n", "\na", "One\r\n two\tTWO \n\n  \x0bthree\x0c", "Ünï ÜNÏ  x\x1cy z z", "\n\n",
    "w" * 8 + " " + "w" * 9 + " " + "w" * 16 + " " + "w" * 17 + "\n" + "v" * 600 + " " + "v" * 601, "end", "a",
]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_are_those_of_split_lines(kind):
    texts = pa.array(["cut off", *TEXTS, "cut off"], kind).slice(1, len(TEXTS))
    hashes, text, number, counts = lines.tokens(texts)
    at = np.cumsum(counts)[:-1]
    got = [(t, n, h.tolist()) for t, n, h in zip(text.tolist(), number.tolist(), np.split(hashes, at))]
    expected = [
        (t, n, lines.hashes_of(pa.array(line.split(), pa.binary())).tolist())
        for t, x in enumerate(TEXTS)
        for n, line in enumerate(lines.lines_of(x))
        if line.split()
    ]
    assert got == expected
    assert len(set(hashes.tolist())) == len({w for x in TEXTS for line in lines.lines_of(x) for w in line.split()})


def test_sets_are_sorted_also_when_sorting_keys_tie():
    hashes = np.array([(5 << 32) + 1, (5 << 32) + 2, (5 << 32) + 1, 7, 5 << 32, 5 << 32], np.uint64)
    keys, sizes = lines.word_sets(hashes, np.array([4, 2]))
    assert sizes.tolist() == [3, 1]
    assert keys.tolist() == [7, (5 << 32) + 1, (5 << 32) + 2, 5 << 32]


def test_words_below_the_frequent_ones_are_ordered_by_their_count(spark):
    rare = [(f"once{i} " + "seldom " * (i < 3) + "sometimes " * (i < 30),) for i in range(2000)]
    docs = spark.createDataFrame([*rare, ("often " * 9000,), (None,)], "text string")
    codes, total = lines.word_order(docs, 4)
    assert total == 2000 + 3 + 30 + 9000
    assert set(lines.frequent_words(docs, 4)[0]) == {b"often"}
    assert 0 == code(codes, b"once7") < code(codes, b"seldom") < code(codes, b"sometimes") < lines.PLACES
    assert code(codes, b"often") >= lines.PLACES
    assert lines.word_order(docs.filter("false"), 4)[1] == 0


def test_postings_travel_as_few_rows(spark):
    """As many rows as there are groups in each task, however many lines share words."""
    words = [f"w{i}" for i in range(500)]
    rng = random.Random(1)
    rows = [(i, "\n".join(" ".join(rng.sample(words, 12)) for _ in range(10))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    postings = packed(spark, docs)
    assert postings.count() <= 2 * lines.GROUPS
    assert postings.agg(F.sum(F.length("unit"))).first()[0] == 8 * 300 * 10 * 3


def test_unrelated_long_lines_leave_no_pairs(spark):
    """Lines of 65 to 96 words that share but one word: 64 bits could not tell them apart."""
    rng = random.Random(2)
    common = [f"c{i}" for i in range(40)]
    rows = [(i, " ".join([common[i % 40], *(f"x{rng.randrange(900)}" for _ in range(95))])) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert lines.candidates(packed(spark, docs), T, every=False).count() == 0


@pytest.mark.parametrize("limit", [lines.OPEN_KEYS, 0])
def test_partners_beyond_the_first_are_looked_at(spark, monkeypatch, limit):
    """Words on one bit of the sketches make partners that pass the filters and then fail."""
    monkeypatch.setattr(lines, "OPEN_KEYS", limit)
    alike = [w for w in (f"v{i}" for i in range(4000)) if bit(w) == 5][:40]
    shared = [f"s{i}" for i in range(8)]
    rows = [(i, " ".join([*shared[:7], *alike[2 * i : 2 * i + 2]])) for i in range(14)]
    rows.append((20, " ".join([*shared, alike[30]])))
    rows.append((21, " ".join([*shared, alike[31]])))
    # These words are common elsewhere, so the shared ones make the prefixes.
    rows += [(100 + i, f"{w} o{i} p{i} q{i} s7 {j}") for i, w in enumerate(alike) for j in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    calls, words_in = [], lines.words_in
    monkeypatch.setattr(lines, "words_in", lambda sets: calls.append(sets) or words_in(sets))
    got = {r["row"]["doc_id"]: r["removed"] for r in lines.dedup_lines(docs).collect() if r["row"]["doc_id"] < 100}
    assert got == {**{i: [] for i in range(14)}, 20: [], 21: [0]}
    assert len(calls) == 1


def test_shared_words():
    xs, ys = pa.array(["a b b c", "", "x" * 2_000_000 + " a"]), pa.array(["c  b d", "a", "a"])
    counts = lines.shared_words(xs, ys)
    assert [c.tolist() for c in counts] == [[3, 0, 2], [3, 1, 1], [2, 0, 1]]


def test_postings_of_hot_words_are_repeated_for_pairs_of_blocks(spark):
    """Each line of a hot word goes to one unit for every block, and the units to all groups."""
    rows = [(i, "\n".join(f"hot warm x{i}y{j} z{i}y{j}" for j in range(40))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    order, _ = lines.word_order(docs, lines.FREQUENT)
    codes = spark.sparkContext.broadcast(np.maximum(order, 1))
    sets = lines.line_sets(docs, codes, Fraction(1, 10)).withColumn("open", F.lit(False))
    hot = {r["key"]: r["n"] for r in lines.hot_words(sets, codes, Fraction(1, 10), 8).collect()}
    assert sorted(hot.values()) == [800, 800]
    keys = np.sort(np.array([*hot], np.int64).view(np.uint64))
    blocks = spark.sparkContext.broadcast((keys, np.array([100, 100])))
    postings = lines.postings(sets, codes, Fraction(1, 10), lines.GROUPS, blocks)
    assert postings.agg(F.sum(F.length("pos"))).first()[0] == 4 * (800 * 2 * 100 + 800 * 2)
    assert postings.select("part").distinct().count() == lines.GROUPS
