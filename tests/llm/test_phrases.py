"""Phrase collocations against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablegate.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, a int, words string, hash int"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_counts(rows, most):
    counts, totals = {k: Counter() for k in range(1, most + 1)}, Counter()
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in counts:
                counts[k].update((lang or "und", *words[i : i + k]) for i in range(len(words) - k + 1))
    return counts, totals


def brute(rows, support=10, most=3, inside=50, top=2000):
    counts, totals = brute_counts(rows, most)
    every = {key: n for own in counts.values() for key, n in own.items()}
    found = {key: n for k in range(2, most + 1) for key, n in counts[k].items() if n >= support}
    ranked = {}
    for (lang, *words), a in found.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = every[lang, *words[:k]], every[lang, *words[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        longer = [
            n for (other, *more), n in found.items()
            if other == lang and len(more) > len(words)
            and any(more[i : i + len(words)] == words for i in range(len(more) - len(words) + 1))
        ]
        if not longer or 100 * max(longer) < inside * a:
            ranked.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, own in ranked.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)] + ["Of", "of", "ß", "été", "ÉTÉ", "\x0b", "x y", "-"]
    weights = [1 / (i + 1) for i in range(len(words))]
    made = [(0, " ", "empty"), (1, None, "en"), (2, "", "de"), (3, " .,;\t\n", None), (4, "A b. a B! a b", "en"), (5, "one two " * 3000, "fr")]
    for i in range(150):
        own = rng.choices(words, weights, k=rng.randint(1, 80))
        for at in range(rng.randint(0, 6)):
            own[at * 7 % len(own)] = rng.choice(["new york city", "Hong Kong", "a, b", "very very very"])
        made.append((10 + i, rng.choice([" ", "  ", "\t"]).join(own) + rng.choice(["", ".", "\n"]), rng.choice(["en", "de", None, "und"])))
    return made + [made[30], made[31], (None, made[32][1], "en")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in rows], SCHEMA).repartition(3)


# Shards of one size hold a text or two, of the other all rows of a task.
@pytest.mark.parametrize("shard_words", [20, 400, phrases.SHARD_WORDS])
@pytest.mark.parametrize(("support", "most", "inside", "top"), [(10, 3, 50, 2000), (4, 4, 80, 25)])
def test_against_brute_force(docs, rows, support, most, inside, top, shard_words):
    result = phrases.collocations(docs, support, most, inside, top, shard_words)
    assert [kind for name, kind in result.dtypes if name not in ("lang", "phrase")] == ["bigint"] * 6
    assert sorted(map(tuple, result.collect())) == brute(rows, support, most, inside, top)


def test_exact_beyond_64_bits(spark):
    """The product of two counts and a million needs more than 64 bits."""
    big = 3_000_000_007
    found = spark.createDataFrame([("en", "a b", 2, big)], "lang string, phrase string, words int, a long")
    words = spark.createDataFrame([("en", "a", big + 1), ("en", "b", 2 * big)], "lang string, phrase string, a long")
    row = phrases.scored(found, words).first()
    assert row["score"] == 1000000 * big * big // ((big + 1) * 2 * big)


def test_hashes_are_sparks(spark):
    words = ["a", "été", "-", "a" * 50]
    table = spark.createDataFrame([("de", w) for w in words], "lang string, word string")
    got = [r[0] for r in table.select(F.xxhash64("lang", "word")).collect()]
    assert phrases.word_hashes("de", [w.encode() for w in words]).view(np.int64).tolist() == got


def test_bitmap_holds_all(spark):
    hashes = spark.range(5000).select(F.xxhash64("id").alias("hash"))
    known = np.array([r[0] for r in hashes.collect()]).view(np.uint64)
    bitmap = phrases.Bitmap(hashes, 5000)
    others = np.random.default_rng(0).integers(0, 1 << 63, 10000).astype(np.uint64)
    assert bitmap.holds(known).all() and bitmap.holds(others).mean() < 0.1
    assert not phrases.Bitmap(hashes.limit(0), 0).holds(known).any()


def test_empty(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("most", [50, 1 << 30])
def test_distinct_rows(most):
    rng = np.random.default_rng(3)
    columns = [rng.integers(0, 50, 2000).astype(np.int32) for _ in range(3)]
    rows, counts = phrases.distinct_rows(columns, most)
    got = dict(zip(zip(*(c.tolist() for c in rows)), counts.tolist()))
    assert got == Counter(zip(*(c.tolist() for c in columns)))
    assert len(phrases.distinct_rows([c[:0] for c in columns], most)[1]) == 0
