"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tablegate.llm import periodic, queries

SCHEMA = "doc_id long, text string, lang string, n_words int, runs string, row int, i int"


def brute_runs(words, min_length=24, min_repeats=3):
    """Every maximal stretch of each period; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i:
                if j + q - i >= 2 * q:
                    found.setdefault((i, j + q - i), q)
                i = j
            else:
                i += 1
    kept = [(s, n, q) for (s, n), q in found.items() if n >= max(min_length, min_repeats * q)]
    return sorted(kept, key=lambda run: (run[0], run[2]))


def odd_words(rng):
    n = rng.choice([0, 1, 2, 10, 30, 60, 150])
    words = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(n)]
    if n > 10 and rng.random() < 0.6:
        start, period = rng.randrange(n), rng.randint(1, 9)
        for i in range(start + period, n):
            words[i] = words[i - period]
    return words + words[: n // 2] + [99] + words if rng.random() < 0.3 else words


@pytest.mark.parametrize(("min_length", "min_repeats"), [(24, 3), (6, 3), (4, 2), (2, 2), (30, 5)])
def test_runs_of_random_words(min_length, min_repeats):
    rng = random.Random(min_length)
    for _ in range(150):
        texts = [odd_words(rng) for _ in range(rng.randint(1, 6))]
        found = periodic.runs_of([np.array(t, np.int64) for t in texts], min_length, min_repeats)
        expected = {i: brute_runs(t, min_length, min_repeats) for i, t in enumerate(texts)}
        assert found == {i: own for i, own in expected.items() if own}


def test_smaller_child_bound():
    """Only the suffixes of smaller children ask: n log n, also where all words are equal."""
    suffixes = periodic.Suffixes([np.zeros(4000, np.int64)])
    place, period = periodic.branching_squares(suffixes)
    assert len(place) <= 4000 * 13
    assert set(zip(place.tolist(), period.tolist())) == {(4000 - 2 * q, q) for q in range(1, 2001)}


def test_many_runs():
    a, b = [0], [0, 1]
    while len(b) < 700:
        a, b = b, b + a
    found = periodic.runs_of([np.array(b)], 4, 2)
    assert found[0] == brute_runs(b, 4, 2)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(50)] + ["ß", "A", "a"]
    texts = [None, "", " \n\t ", "x", "a " * 30, "A a " * 20, "\x0b".join(["p", "q", "r"] * 12), "n b " * 25]
    for _ in range(120):
        own = [rng.choice(words) for _ in range(rng.randint(1, 200))]
        if rng.random() < 0.3:
            own += own[-rng.randint(1, 9) :] * rng.randint(3, 12)
        texts.append(rng.choice([" ", "\n", "  "]).join(own))
    texts.append(" ".join(rng.choice(words) for _ in range(30000)) + " z y x" * 4000)
    made = list(enumerate(texts))
    return made + [made[12], (made[13][0], "another text of this id"), (None, "k l m " * 20)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "en", 1, "clash", 2, 3) for r in rows], SCHEMA).repartition(3)


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def test_operator(docs, rows):
    got = sorted(
        (str(r["row"]["doc_id"]), str(r["row"]["text"]), r["n_words"], [tuple(x) for x in r["runs"]], r["clean_text"])
        for r in periodic.periodic_runs(docs).collect()
    )
    expected = []
    for doc, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = brute_runs(words) if len(words) < 3000 else [(len(words) - 12000, 12000, 3)]
        clean = None if text is None else " ".join(kept(words, runs))
        expected.append((str(doc), str(text), len(words), runs, clean))
    assert got == sorted(expected)


def test_query(spark, rows, tmp_path):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    result = queries.op13_periodic_runs(spark, str(tmp_path))
    assert dict(result.dtypes) == dict.fromkeys(columns[:6], "bigint") | dict.fromkeys(columns[6:], "string")
    got = sorted(map(str, result.select(columns).collect()))
    expected, planted = [], 0
    for doc, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        n = len(words)
        code = None if doc is None else zlib.crc32(str(doc).encode())
        if code is not None and code % 10 == 0 and n > 0:
            g = code // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = brute_runs(words) if n < 3000 else [(n - 12000, 12000, 3)]
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        clean = " ".join(kept(words, runs))
        milli = 1000 * best[1] // best[2] if runs else None
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, clean)]
        values = dict(zip(columns, (doc, len(runs), *best, milli, *digests)))
        expected.append("Row(" + ", ".join(f"{k}={v!r}" for k, v in values.items()) + ")")
    assert planted > 5 and got == sorted(expected)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert periodic.periodic_runs(empty).count() == 0
