"""Pairs of rows that meet under a key, without a task that grows with a hot key.

A key's rows are cut into blocks of bounded size, and each pair of blocks is a unit of work
of its own. The units are dealt out by hash, sorted, and compared as numpy columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.common import small_or_shuffled
from tablegate.session import materialize

BLOCK_ROWS = 2048
# Pairs that are held as arrays at a time.
PAIRS_AT_ONCE = 1 << 18

Test = Callable[[dict[str, np.ndarray], np.ndarray, np.ndarray], np.ndarray]


def in_units(rows: DataFrame, block_rows: int = BLOCK_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Rows with a ``key`` dealt out and sorted by ``unit``, where pairs are to be looked for.

    A key of at most ``block_rows`` rows is one unit. The rows of a hotter key are repeated
    for each pair of blocks that theirs is in. ``hot`` names (key, n) of the hotter keys if
    the caller has counted them.
    """
    if hot is None:
        counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        hot = counts.filter(F.col("n") > block_rows)
    hot = materialize(hot.select("key", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks")))
    payload = [c for c in rows.columns if c != "key"]
    units = rows.select(F.col("key").alias("unit"), "key", *payload)
    if hot.limit(1).count():
        small = small_or_shuffled(hot)
        cold = units.join(small.select("key"), "key", "left_anti").select(*units.columns)
        dealt = rows.join(small, "key").withColumn(
            "block", F.pmod(F.xxhash64(*payload), F.col("blocks")).cast("int")
        )
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        pairs = dealt.select("key", *payload, "block", other.alias("other"))
        unit = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
        units = cold.union(pairs.select(unit.alias("unit"), "key", *payload))
    return units.repartition("unit").sortWithinPartitions("unit", "key")


def index_pairs(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs x < y inside runs of these sizes, in chunks."""
    starts = np.cumsum(sizes) - sizes
    later = np.repeat(starts + sizes, sizes) - np.arange(sizes.sum()) - 1
    for at, end, n in spans(later, PAIRS_AT_ONCE):
        x = np.repeat(np.arange(at, end), n)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        yield x, y


def spans(counts: np.ndarray, most: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(begin, end, their counts) of stretches that add up to about ``most``."""
    total = np.concatenate([[0], np.cumsum(counts)])
    at = 0
    while at < len(counts):
        end = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        yield at, end, counts[at:end]
        at = end


def spanning(x: np.ndarray, y: np.ndarray, size: int) -> np.ndarray:
    """Which of the pairs join two parts that the pairs before them had not joined."""
    parent = list(range(size))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    keep = np.zeros(len(x), bool)
    for i, (a, b) in enumerate(zip(x.tolist(), y.tolist())):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            keep[i] = True
    return keep


def runs(
    batches: Iterator[pa.RecordBatch], names: Sequence[str]
) -> Iterator[dict[str, np.ndarray]]:
    """The sorted rows as columns, cut only between units."""
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        unit = columns["unit"]
        if not len(unit):
            continue
        last = int(np.searchsorted(unit, unit[-1], "left"))
        if last or (held and held[-1]["unit"][-1] != unit[0]):
            head = {n: c[:last] for n, c in columns.items()}
            parts = [*held, head]
            yield {n: np.concatenate([p[n] for p in parts]) for n in names}
            held = []
        held.append({n: c[last:] for n, c in columns.items()})
    if held:
        yield {n: np.concatenate([p[n] for p in held]) for n in names}


def key_sizes(columns: dict[str, np.ndarray]) -> np.ndarray:
    """Sizes of the stretches of equal (unit, key)."""
    unit, key = columns["unit"], columns["key"]
    edge = np.flatnonzero((unit[1:] != unit[:-1]) | (key[1:] != key[:-1])) + 1
    return np.diff(np.concatenate([[0], edge, [len(unit)]]))


def spanning_pairs(rows: DataFrame, identity: str, test: Test) -> DataFrame:
    """(a, b) with a < b: a spanning set of the pairs in each unit that pass ``test``.

    ``rows`` come from :func:`in_units`; ``identity`` is the long column that names a row.
    """
    names = rows.columns

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in runs(batches, names):
            size = len(columns["unit"])
            x, y = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for left, right in index_pairs(key_sizes(columns)):
                passed = test(columns, left, right)
                x = np.concatenate([x, left[passed]])
                y = np.concatenate([y, right[passed]])
                if len(x) > 2 * size:
                    keep = spanning(x, y, size)
                    x, y = x[keep], y[keep]
            ids = columns[identity]
            a, b = ids[x], ids[y]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
            )

    return rows.mapInArrow(compare, "a long, b long")
