"""Embedding near-dedup by a pivot-permutation index.

Pivots are vectors of the table that lie apart from each other. A vector is described by its
PREFIX nearest pivots in order, nearest first, and stands in the inverted lists of the first
LISTS of them. Two vectors of one list whose descriptions share SHARED pivots are candidates;
they are verified by their cosine in double precision. A pair that meets in several lists
counts in the one of the lowest pivot number, so links are counted where they are found and
no pair leaves its task. A list longer than BLOCK_ROWS is cut into blocks, and each pair of
blocks is a unit of work of its own.

Pivots are fitted on a sample of at most 4 vectors a pivot and 64 MB, chosen by hash, with
as many pivots as the square root of the vectors (64 to MAX_PIVOTS, or what the sample
gives); every vector is indexed. Pivots of cosine APART or more to an earlier one are left
out: many pivots inside one group of near copies would be its members' nearest ones in
random order. Only recall depends on the sample: links are verified, and none is below the
threshold.

Equal vectors of a label are one class and need no pairs; a batch sends one row of each, so
a hot class stays small.

Defined cases: a vector with a null label, and one that is null, empty, zero, or holds a null
or non-finite component, links with nothing; vectors of different length do not link; rows that
repeat a vec_id are vectors of their own; a null vec_id is never a component's smallest
unless all are null, and is then kept; an empty table gives an empty result. Columns other
than vec_id, embedding and label are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.llm.common import small_or_shuffled
from tablegate.llm.components import components
from tablegate.llm.runs import runs, spanning
from tablegate.session import materialize

THRESHOLD = 0.98
PREFIX = 8
LISTS = 3
SHARED = 3
MIN_PIVOTS = 64
MAX_PIVOTS = 1 << 14
APART = 0.8
SAMPLE_BYTES = 1 << 26
BLOCK_ROWS = 1024
# Descriptions are ordered by products of whole numbers, which are the same in every batch.
GRID = 1 << 18
# Columns of a block of pairs that is compared at a time.
TILE = 512


def _usable(vector: Column, label: Column) -> Column:
    sound = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return label.isNotNull() & vector.isNotNull() & sound & F.exists(vector, lambda x: x != 0)


def _digest(vector: Column, label: Column) -> Column:
    """16 bytes that name a class of equal vectors."""
    halves = [F.xxhash64(label, vector), F.xxhash64(F.lit(1), label, vector)]
    return F.to_binary(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves]), F.lit("hex"))


def marked(vectors: DataFrame) -> DataFrame:
    """(vec_id, digest, list_of, embedding): the digest is null where nothing can link."""
    vector, label = F.col("embedding"), F.col("label")
    use = F.coalesce(_usable(vector, label), F.lit(False))
    return vectors.select(
        "vec_id",
        F.when(use, _digest(vector, label)).alias("digest"),
        F.xxhash64(label, F.size(vector)).alias("list_of"),
        "embedding",
    )


def whole(vectors: np.ndarray) -> np.ndarray:
    """Each vector scaled so that its greatest component is GRID, in whole numbers."""
    values = vectors.astype(np.float64)
    top = np.abs(values).max(axis=1, keepdims=True)
    return np.rint(values / top * GRID)


def unit(vectors: np.ndarray) -> np.ndarray:
    values = vectors.astype(np.float64)
    values /= np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt(np.einsum("ij,ij->i", values, values))[:, None]


def padded(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """Vectors of any length as rows of one width, for their distances to the pivots."""
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors):
        part = vector[:width]
        row[: len(part)] = part
    empty = ~out.any(axis=1)
    out[empty, 0] = 1.0
    return out


def chosen_pivots(usable: DataFrame, apart: float = APART) -> np.ndarray:
    """The pivots, as rows of whole numbers."""
    total = usable.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    rows, width = total[0], total[1] or 1
    wanted = min(MAX_PIVOTS, max(MIN_PIVOTS, math.isqrt(rows)), max(1, SAMPLE_BYTES // (32 * width)))
    place = F.shiftrightunsigned(F.xxhash64("embedding"), 11)
    share = min(1.0, 16 * wanted / max(rows, 1))
    # Copies of a vector have one hash: they are one row of the sample.
    sample = (
        usable.select(place.alias("place"), "embedding")
        .filter(F.col("place") < int(share * (1 << 53)))
        .groupBy("place").agg(F.min("embedding").alias("embedding"))
        .orderBy("place").limit(4 * wanted).collect()
    )
    vectors = padded([np.array(r["embedding"], np.float64) for r in sample], width)
    if not len(vectors):
        return whole(np.ones((1, width)))
    rays = unit(vectors)
    taken = np.zeros((wanted, width))
    kept: list[int] = []
    for at, ray in enumerate(rays):
        if len(kept) < wanted and not (taken[: len(kept)] @ ray >= apart).any():
            taken[len(kept)] = ray
            kept.append(at)
    return whole(rays[kept])


def descriptions(vectors: list[np.ndarray], pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The numbers of each vector's nearest pivots, nearest first; ties by number."""
    lengths = np.sqrt(np.einsum("ij,ij->i", pivots, pivots))
    out = np.zeros((len(vectors), min(prefix, len(pivots))), np.int64)
    for at in range(0, len(vectors), 1024):
        near = whole(padded(vectors[at : at + 1024], pivots.shape[1])) @ pivots.T / lengths
        for column in range(out.shape[1]):
            best = near.argmax(axis=1)
            out[at : at + 1024, column] = best
            near[np.arange(len(near)), best] = -np.inf
    return out


def described(usable: DataFrame, pivots: np.ndarray, prefix: int = PREFIX) -> DataFrame:
    """(list_of, digest, vector, pivots, n): the classes of each batch, described."""
    shared = usable.sparkSession.sparkContext.broadcast(pivots)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            digests = np.array(batch.column("digest").to_pylist(), object)
            _, first, n = np.unique(digests, return_index=True, return_counts=True)
            column = batch.column("embedding")
            vectors = [column[i].values.to_numpy(zero_copy_only=False) for i in first.tolist()]
            near = descriptions(vectors, shared.value, prefix)
            yield pa.RecordBatch.from_pydict(
                {
                    "list_of": batch.column("list_of").take(pa.array(first)),
                    "digest": pa.array(digests[first], pa.binary()),
                    "vector": pa.array([v.tobytes() for v in vectors], pa.binary()),
                    "pivots": pa.array([p.tobytes() for p in near.astype(np.uint16)], pa.binary()),
                    "entries": pa.array(near[:, :LISTS].tolist(), pa.list_(pa.int32())),
                    "n": pa.array(n.astype(np.int64)),
                }
            )

    schema = "list_of long, digest binary, vector binary, pivots binary, entries array<int>, n long"
    return usable.select("list_of", "digest", "embedding").mapInArrow(describe, schema)


def in_lists(described_rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The inverted lists, dealt out by ``unit``: a list, or a pair of its blocks."""
    entries = described_rows.select(
        "list_of", F.explode("entries").alias("pivot"), "digest", "vector", "pivots", "n"
    )
    counts = entries.groupBy("list_of", "pivot").agg(F.approx_count_distinct("digest").alias("rows"))
    hot = counts.filter(F.col("rows") > block_rows).select(
        "list_of", "pivot", F.ceil(F.col("rows") / block_rows).cast("int").alias("blocks")
    )
    marked_rows = entries.join(small_or_shuffled(materialize(hot)), ["list_of", "pivot"], "left")
    blocks = F.coalesce("blocks", F.lit(1))
    placed = marked_rows.withColumn("block", F.pmod(F.xxhash64("digest"), blocks).cast("int"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("blocks")
    ends = [F.least("block", "other"), F.greatest("block", "other")]
    dealt = pairs.withColumn("unit", F.xxhash64("list_of", "pivot", *ends))
    order = ["unit", "list_of", "pivot", "digest"]
    return dealt.repartition("unit").sortWithinPartitions(*order)


def stretches(*columns: np.ndarray) -> np.ndarray:
    """Where stretches of equal values start, with the end of the last."""
    edge = np.zeros(len(columns[0]), bool)
    edge[:1] = True
    for column in columns:
        edge[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(edge), len(edge))


class Classes:
    """The classes of one unit's list."""

    def __init__(self, columns: dict[str, np.ndarray], start: int, end: int, kind: np.dtype):
        digests = columns["digest"][start:end]
        edges = stretches(digests)
        first = edges[:-1]
        self.pivot = int(columns["pivot"][start])
        self.digests = digests[first]
        self.n = np.add.reduceat(columns["n"][start:end], first).astype(np.float64)
        self.block = columns["block"][start:end][first]
        # A unit of two blocks compares across them, a unit of one within it.
        self.across = bool((columns["block"][start:end] != columns["other"][start:end]).any())
        join = lambda name, dtype: np.frombuffer(
            b"".join(columns[name][start:end][first]), dtype
        ).reshape(len(first), -1)
        self.rays = unit(join("vector", kind))
        self.prefixes = join("pivots", np.uint16)

    def candidates(self, x: slice, y: slice, shared: int, lists: int) -> np.ndarray:
        """Pairs that share enough pivots, and no list of a lower pivot number."""
        a, b = self.prefixes[x], self.prefixes[y]
        count = np.zeros((len(a), len(b)), np.int8)
        before = np.zeros(count.shape, bool)
        for i in range(a.shape[1]):
            for j in range(b.shape[1]):
                same = a[:, i, None] == b[None, :, j]
                count += same
                if i < lists and j < lists:
                    before |= same & (a[:, i, None] < self.pivot)
        return (count >= min(shared, a.shape[1])) & ~before

    def links(self, threshold: float, shared: int, lists: int) -> tuple[np.ndarray, ...]:
        """Linked rows of each class, and a spanning set of its pairs."""
        size = len(self.digests)
        found = np.zeros(size)
        left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i in range(0, size, TILE):
            x = slice(i, min(i + TILE, size))
            for j in range(i, size, TILE):
                y = slice(j, min(j + TILE, size))
                link = self.candidates(x, y, shared, lists)
                link &= self.rays[x] @ self.rays[y].T >= threshold
                if self.across:
                    link &= self.block[x, None] != self.block[None, y]
                if i == j:
                    link = np.triu(link, 1)
                if link.any():
                    weights = link.astype(np.float64)
                    found[x] += weights @ self.n[y]
                    found[y] += weights.T @ self.n[x]
                    a, b = np.nonzero(link)
                    left, right = np.concatenate([left, a + i]), np.concatenate([right, b + j])
                    keep = spanning(left, right, size)
                    left, right = left[keep], right[keep]
        return found.astype(np.int64), left, right


def found_links(
    lists_rows: DataFrame, kind: np.dtype, threshold: float, shared: int, lists: int = LISTS
) -> DataFrame:
    """(digest, other, n): n linked rows of a class in a unit, or, with other, a tree's edge."""
    names = lists_rows.columns

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in runs(batches, names):
            edges = stretches(columns["unit"], columns["list_of"], columns["pivot"])
            out: list[tuple] = []
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if end - start < 2:
                    continue
                classes = Classes(columns, start, end, kind)
                n, left, right = classes.links(threshold, shared, lists)
                at = np.flatnonzero(n)
                out += [(classes.digests[i], None, int(n[i])) for i in at]
                out += [(classes.digests[i], classes.digests[j], 0) for i, j in zip(left, right)]
            digests, others, numbers = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(others, pa.binary()), pa.array(numbers, pa.int64())],
                names=["digest", "other", "n"],
            )

    return lists_rows.mapInArrow(compare, "digest binary, other binary, n long")


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    prefix: int = PREFIX,
    shared: int = SHARED,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    rows = marked(vectors)
    usable = rows.filter(F.col("digest").isNotNull())
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    if element not in ("float", "double"):
        usable = usable.withColumn("embedding", F.col("embedding").cast("array<double>"))
    kind = np.dtype("f4" if element == "float" else "f8")
    lists = in_lists(described(usable, chosen_pivots(usable), prefix), block_rows)
    found = materialize(found_links(lists, kind, threshold, shared))
    links = found.filter(F.col("other").isNull()).groupBy("digest").agg(F.sum("n").alias("links"))
    joined = components(
        found.filter(F.col("other").isNotNull()).select(F.col("digest").alias("a"), F.col("other").alias("b"))
    )
    sizes = usable.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = materialize(
        sizes.join(links, "digest", "left")
        .join(joined.select(F.col("node").alias("digest"), "component"), "digest", "left")
        .filter((F.col("n") > 1) | F.col("links").isNotNull())
        .select(
            "digest",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "digest").alias("component"),
            "least",
        )
    )
    smallest = classes.groupBy("component").agg(F.min("least").alias("smallest"))
    known = materialize(classes.join(smallest, "component").select("digest", "n_links", "smallest"))
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("smallest"))
    return (
        rows.select("vec_id", "digest")
        .join(small_or_shuffled(known), "digest", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )
