"""Line limits of the quality rules: a number of documents, whatever the size of the host."""

from __future__ import annotations

from collections import defaultdict

import pytest

from tablegate.llm import quality
from tablegate.session import BROADCAST_LIMIT_BYTES

BODY = " ".join(f"word{i}" for i in range(60))


@pytest.fixture(scope="module")
def rows():
    """A big host, of which few documents share a line; copies; null hosts and texts."""
    made = [(i, f"own line {i} {BODY}\n" + ("Seen  Often\n" if i % 16 == 0 else ""), "big") for i in range(400)]
    made += [(1000 + i, f"fetched again {BODY}\nsecond line of it", "big") for i in range(90)]
    made += [(2000 + i, f"small {i} {BODY}\nseen  often", "small") for i in range(20)]
    made += [(3000 + i, f"none {i} {BODY}\nseen  often", None) for i in range(25)]
    made += [(4000 + i, f"tiny {i}\n" + "thin page\n" * 60, "thin") for i in range(30)]
    return made + [(5000, None, "big"), (5001, "", None), (None, f"x {BODY}\nSEEN  OFTEN ", "big"), made[0]]


def brute(rows):
    texts = defaultdict(set)
    norm = lambda line: line.lower().strip(" \t\x0b\x0c\r")
    for _, text, host in rows:
        for line in (text or "").split("\n"):
            if norm(line):
                texts[host, norm(line)].add(text)
    return sorted(
        (str(doc), str(host), sum(len(texts[host, norm(x)]) > quality.MAX_DOCUMENTS for x in (text or "").split("\n") if norm(x)))
        for doc, text, host in rows
    )


@pytest.mark.parametrize("limit", [BROADCAST_LIMIT_BYTES, 0])
def test_removed_lines(spark, rows, monkeypatch, limit):
    monkeypatch.setattr("tablegate.llm.common.BROADCAST_LIMIT_BYTES", limit)
    table = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, host string")
    result = quality.quality(table).collect()
    got = sorted((str(r["row"]["doc_id"]), str(r["row"]["source"]), r["lines_removed"]) for r in result)
    assert got == brute(rows)
    kept = {r["row"]["doc_id"]: r["kept"] for r in result}
    assert kept[1] and kept[16] and kept[1000] and not kept[4000]
    passed = {r["doc_id"]: r["text"] for r in quality.passing(table).collect()}
    assert "Often" not in passed[16] and passed[1] == rows[1][1] and 4000 not in passed


def test_counts_are_computed_once(spark, rows):
    """The filter on the verdict does not multiply the splitting of texts."""
    table = spark.createDataFrame([(*r,) for r in rows], "doc_id long, text string, source string")
    count = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("split(")
    assert count(quality.passing(table)) <= count(quality.quality(table)) + 4
