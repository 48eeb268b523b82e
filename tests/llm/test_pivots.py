"""The pivot index against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tablegate.llm import pivots

SCHEMA = "vec_id long, embedding array<float>, label int, digest string, n int, pivots string"


def brute(rows, threshold=pivots.THRESHOLD):
    """(vec_id, links, component, kept) of each row, by comparing all pairs."""
    good = [
        label is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for _, v, label in rows
    ]
    linked = [set() for _ in rows]
    for i, (_, x, a) in enumerate(rows):
        for j, (_, y, b) in enumerate(rows):
            if i != j and good[i] and good[j] and a == b and len(x) == len(y):
                p, q = np.float32(x).astype(float), np.float32(y).astype(float)
                if p @ q / (np.linalg.norm(p) * np.linalg.norm(q)) >= threshold:
                    linked[i].add(j)
    out = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = linked[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((row[0], len(linked[i]), least, row[0] == least))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    made = []
    centres = rng.normal(size=(12, 16))
    for i in range(260):
        centre = centres[i % 12] if i % 3 else rng.normal(size=16)
        vector = centre + rng.normal(size=16) * rng.choice([0.0, 0.05, 0.15])
        made.append((i, (vector * 10.0 ** rng.integers(-3, 4)).astype(np.float32).tolist(), i % 2))
    copy = made[4][1]
    made += [(1000 + i, copy, 0) for i in range(150)]
    made += [(2000, copy, 1), (2001, copy, None), (2002, None, 0), (2003, [], 0), (2004, [0.0] * 16, 0)]
    made += [(2005, [math.nan] + copy[1:], 0), (2006, [math.inf] + copy[1:], 0), (2007, [None] + copy[1:], 0)]
    made += [(2008, copy[:8], 0), (2009, copy[:8], 0), (2010, [3e38] * 16, 1), (2011, [1e-38] * 16, 1)]
    made += [made[5], (made[6][0], made[7][1], made[7][2]), (None, made[9][1], made[9][2]), (None, [1.0, -2.0], 0)]
    return made


@pytest.fixture(scope="module")
def vectors(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("block_rows", [pivots.BLOCK_ROWS, 16])
def test_against_brute_force(vectors, rows, block_rows):
    result = pivots.near_duplicates(vectors, block_rows=block_rows)
    assert dict(result.dtypes) == {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}
    assert sorted(map(tuple, result.collect()), key=str) == brute(rows)


def test_recall(spark):
    """Pairs of all cosines from 0.98 on, beside many vectors that only lie near."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(1200, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(axis=1)[:, None] * base
    side /= np.linalg.norm(side, axis=1)[:, None]
    cosine = rng.uniform(0.95, 1.0, size=(1200, 1))
    values = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * side]).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(values)], "vec_id long, embedding array<float>, label int")
    rays = values.astype(float) / np.linalg.norm(values.astype(float), axis=1)[:, None]
    expected = (rays @ rays.T >= pivots.THRESHOLD).sum(axis=1) - 1
    got = np.array([r["n_links"] for r in pivots.near_duplicates(table).orderBy("vec_id").collect()])
    assert expected.sum() > 500 and (got <= expected).all()
    assert got.sum() >= 0.95 * expected.sum()


def test_pivots_lie_apart(vectors):
    usable = pivots.marked(vectors).filter("digest IS NOT NULL")
    chosen = pivots.unit(pivots.chosen_pivots(usable, apart=0.5))
    cosines = chosen @ chosen.T - np.eye(len(chosen))
    assert 10 < len(chosen) <= pivots.MIN_PIVOTS and cosines.max() < 0.51


def test_descriptions():
    rng = np.random.default_rng(1)
    chosen = pivots.whole(pivots.unit(rng.normal(size=(40, 8))))
    vectors = list(rng.normal(size=(30, 8)))
    got = pivots.descriptions(vectors, chosen, 5)
    cosines = np.array([pivots.unit(v[None]) @ pivots.unit(chosen).T for v in vectors])[:, 0]
    assert (got == np.argsort(-cosines, axis=1, kind="stable")[:, :5]).all()
    # A description does not depend on the batch it is computed in.
    alone = np.concatenate([pivots.descriptions([v], chosen, 5) for v in vectors])
    assert (got == alone).all()


def test_pair_counts_once():
    """Whatever lists two vectors share, the lowest pivot's is the one that counts them."""
    rng = random.Random(2)
    for _ in range(50):
        near = np.array([rng.sample(range(12), 6) for _ in range(2)], np.uint16)
        shared = set(near[0].tolist()) & set(near[1].tolist())
        entries = set(near[0, :3].tolist()) & set(near[1, :3].tolist())
        hits = 0
        for pivot in entries:
            classes = object.__new__(pivots.Classes)
            classes.pivot, classes.prefixes = pivot, near
            hits += classes.candidates(slice(0, 1), slice(1, 2), 2, 3)[0, 0]
        assert hits == (len(entries) > 0 and len(shared) >= 2)


def test_empty_and_unusable(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pivots.near_duplicates(empty).count() == 0
    zeros = spark.createDataFrame([(1, [0.0], 1, "", 1, ""), (2, None, 1, "", 1, "")], SCHEMA)
    assert sorted(map(tuple, pivots.near_duplicates(zeros).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
