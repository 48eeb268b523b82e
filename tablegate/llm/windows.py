"""Substring dedup by windows: passages that repeat, whatever word they begin with.

Words are lower-cased (A-Z) and single spaced. A unit is every run of MIN_WORDS words, at
each word of a text. Units of equal words are copies; the one of the lowest rank, (doc_id,
word number), is kept. The other ones that overlap or touch in a document are joined to one
span and reported with offsets into the original text, in code points.

No unit is left out, but few have to be moved:

* The seed of a unit is the leftmost lowest hash of the runs of half its words. It depends on
  the unit's words alone, so copies have equal seeds, and a unit whose seed occurs once has
  no copy. The seeds that occur again are put in sorted arrays beside the tables.
* Neighbouring units mostly have one seed in common. Such a block is one row. Blocks of equal
  words are a class, and only its first block matters to blocks of other words.
* Where a seed has blocks of several classes, copies may stand in different ones, so there
  the first block of each class is unfolded and its units are compared one by one.

Defined cases are those of ``passages``: a null text has no units, nor has one of fewer than
MIN_WORDS words; a null doc_id ranks first; rows that repeat doc_id and text are one document,
and rows that repeat a doc_id with another text have the same rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.common import content_hash, settled, short_lived_shuffles, small_or_shuffled
from tablegate.llm.passages import HOT, MIN_WORDS, with_firsts
from tablegate.llm.store import open_array, write_array
from tablegate.operators.once import computed_once
from tablegate.session import _remove, scratch_path

SHARDS = 64
_BASE = 0x9E3779B97F4A7C15
_TEXTS = 512


class _Powers:
    """Powers of the base and of its inverse, modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            each = [np.full(size, b, np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
            for powers in each:
                powers[0] = 1
            self.up, self.down = (np.cumprod(powers, dtype=np.uint64) for powers in each)
        return self.up, self.down


_POWERS = _Powers()


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _sums(h: np.ndarray) -> np.ndarray:
    up, _ = _POWERS.upto(len(h) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[: len(h)], dtype=np.uint64)])


def _digests(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words from ``begin`` to ``end``, whatever stands before them."""
    return _mixed((sums[end] - sums[begin]) * _POWERS.upto(len(sums))[1][begin])


def blocks(words: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first unit, end, seed) of every block of a text's units, and sums of its words' hashes."""
    n, half = len(words), (least + 1) // 2
    hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(n, 2)
    sums = _sums(hashes[:, 0])
    at = np.arange(n - half + 1)
    runs = _digests(sums, at, at + half)
    lowest = sliding_window_view(runs, least - half + 1).argmin(axis=1) + np.arange(n - least + 1)
    first = np.flatnonzero(np.diff(lowest, prepend=-1))
    return first, np.append(first[1:], len(lowest)), runs[lowest[first]].view(np.int64), _sums(hashes[:, 1])


def _places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word, in code points."""
    raw = np.frombuffer(data, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not data.isascii():
        before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        begin, end = before[begin], before[end]
    return begin, end


def _texts(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches, with (row, bytes, words) of the texts that have units."""
    for batch in batches:
        for at in range(0, batch.num_rows, _TEXTS):
            part, found = batch.slice(at, _TEXTS), []
            for row, text in enumerate(part.column("text").to_pylist()):
                data = b"" if text is None else text.encode("utf-8", "surrogatepass")
                words = data.lower().split()
                if len(words) >= least:
                    found.append((row, data, words))
            yield part, found


def _joined(arrays: list[np.ndarray], kind: str) -> np.ndarray:
    return np.concatenate(arrays).astype(kind) if arrays else np.zeros(0, kind)


def repeated_seeds(docs: DataFrame, folder: str, least: int) -> list[int]:
    """Writes the seeds of several blocks as sorted arrays, and names those that were written."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _texts(batches, least):
            every = _joined([blocks(words, least)[2] for _, _, words in found], "i8")
            yield pa.RecordBatch.from_arrays([pa.array(every)], names=["seed"])

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = _joined([batch.column("seed").to_numpy(zero_copy_only=False) for batch in batches], "i8")
        shards = np.unique(mine & (SHARDS - 1))
        for shard in shards.tolist():
            write_array(folder, f"seeds-{shard}", np.sort(mine[mine & (SHARDS - 1) == shard]).astype("<i8"))
        yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64())], names=["shard"])

    with short_lived_shuffles(docs.sparkSession):
        counted = docs.select("text").mapInArrow(seeds, "seed long").groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
        again = counted.filter("n > 1").select("seed")
        sharded = again.repartition(SHARDS, F.col("seed").bitwiseAND(F.lit(SHARDS - 1)))
        return [row[0] for row in sharded.mapInArrow(stored, "shard long").collect()]


def repeated_blocks(docs: DataFrame, folder: str, shards: list[int], least: int) -> DataFrame:
    """(doc_id, content, word, seed, whole, digests, begins, ends) of the blocks of repeated seeds.

    ``whole`` is the digest of the block's words; the arrays have an element for every unit.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {shard: open_array(folder, f"seeds-{shard}", "<i8") for shard in shards}

        def repeated(seeds: np.ndarray) -> np.ndarray:
            hit, of = np.zeros(len(seeds), bool), seeds & (SHARDS - 1)
            for shard in np.unique(of).tolist():
                if shard in known:
                    at = np.flatnonzero(of == shard)
                    place = np.searchsorted(known[shard], seeds[at])
                    place[place == len(known[shard])] = 0
                    hit[at] = known[shard][place] == seeds[at]
            return hit

        for part, found in _texts(batches, least):
            cut = [blocks(words, least) for _, _, words in found]
            sizes = [len(c[0]) for c in cut]
            hits = np.split(repeated(_joined([c[2] for c in cut], "i8")), np.cumsum(sizes)[:-1]) if cut else []
            index, columns, lengths = [], [[] for _ in range(6)], []
            for (row, data, _), (first, end, seed, sums), hit in zip(found, cut, hits):
                if not hit.any():
                    continue
                first, end, seed = first[hit], end[hit], seed[hit]
                count = end - first
                begin_at, end_at = _places(data)
                starts = np.cumsum(count) - count
                units = np.arange(count.sum()) - np.repeat(starts, count) + np.repeat(first, count)
                whole = _mixed(_digests(sums, first, end + least - 1) + count.astype(np.uint64))
                index.append(np.full(len(first), row))
                lengths.append(count)
                made = (first, seed, whole.view(np.int64), _digests(sums, units, units + least).view(np.int64),
                        begin_at[units], end_at[units + least - 1])
                for column, values in zip(columns, made):
                    column.append(values)
            index = pa.array(_joined(index, "i8"))
            offsets = pa.array(np.concatenate([[0], np.cumsum(_joined(lengths, "i8"))]).astype("i4"))
            word, seed, whole = (pa.array(_joined(c, "i8")) for c in columns[:3])
            digests, begins, ends = (
                pa.ListArray.from_arrays(offsets, pa.array(_joined(c, kind))) for c, kind in zip(columns[3:], ("i8", "i4", "i4"))
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(index), part.column("content").take(index), word, seed, whole, digests, begins, ends],
                names=["doc_id", "content", "word", "seed", "whole", "digests", "begins", "ends"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, content long, word long, seed long, whole long, "
        "digests array<long>, begins array<int>, ends array<int>"
    )
    return docs.select("doc_id", content_hash(F.col("text")).alias("content"), "text").mapInArrow(rows, schema)


_CLASS = ["seed", "whole"]


def _shifted(first, by) -> Column:
    return F.struct(first["doc_id"].alias("doc_id"), (first["word"] + by).alias("word"))


def _class_firsts(found: DataFrame, hot: int) -> DataFrame:
    """(seed, whole, n, first) of the classes that hold a copy.

    ``first.low`` is the place of the class's first block, and ``first.better`` has the units
    of that block which stand earlier in a block of another class, with their first places.
    """
    rank = F.struct("doc_id", "word")
    classes = settled(
        found.groupBy(*_CLASS).agg(
            F.min(rank).alias("low"),
            F.max(rank).alias("high"),
            F.count(F.lit(1)).alias("n"),
            F.any_value("digests").alias("digests"),
        )
    )
    several = settled(classes.groupBy("seed").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("seed"))
    mixed = classes.join(small_or_shuffled(several), "seed", "left_semi")
    units = mixed.select(*_CLASS, "low", F.posexplode("digests").alias("at", "digest"))
    units = units.select(*_CLASS, "at", "digest", _shifted(F.col("low"), F.col("at")).alias("rank"))
    key = ["seed", "digest"]
    firsts = settled(
        units.groupBy(*key).agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    earlier = with_firsts(units, firsts, key, hot).filter(F.col("rank") > F.col("first"))
    better = earlier.groupBy(*_CLASS).agg(F.map_from_entries(F.collect_list(F.struct("at", "first"))).alias("better"))
    holding = classes.drop("digests").join(better, _CLASS, "left").filter("low < high or better is not null")
    return settled(holding.select(*_CLASS, "n", F.struct("low", "better").alias("first")))


def _copies(found: DataFrame, firsts: DataFrame, hot: int) -> DataFrame:
    """(doc_id, content, word, last, begin, end, first_doc_id) of the copies in each block.

    Units of one block overlap, so its copies are one piece from the first to the last.
    """

    def unit(begin, at):
        known = F.try_element_at(F.col("first.better"), at)
        return F.struct(
            (F.col("word") + at).alias("word"),
            begin.alias("begin"),
            F.get(F.col("ends"), at).alias("end"),
            F.coalesce(known, _shifted(F.col("first.low"), at)).alias("first"),
        )

    def is_later(one):
        return F.struct(F.col("doc_id"), one["word"].alias("word")) > one["first"]

    placed = with_firsts(found.drop("digests"), firsts, _CLASS, hot)
    later = computed_once(placed, {"later": F.filter(F.transform("begins", unit), is_later)}).filter("size(later) > 0")
    first, last = F.get("later", F.lit(0)), F.element_at("later", -1)
    return later.select(
        "doc_id",
        "content",
        first["word"].alias("word"),
        last["word"].alias("last"),
        first["begin"].cast("long").alias("begin"),
        last["end"].cast("long").alias("end"),
        first["first"]["doc_id"].alias("first_doc_id"),
    )


def repeated_windows(docs: DataFrame, min_words: int = MIN_WORDS, hot: int = HOT) -> DataFrame:
    """(doc_id, begin, end, n_words, first_doc_id): the spans to remove.

    ``first_doc_id`` holds the earliest occurrence of the span's first unit.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "seeds")
    try:
        shards = repeated_seeds(docs, folder, min_words)
        found = repeated_blocks(docs, folder, shards, min_words)
        copies = _copies(found, _class_firsts(found, hot), hot)
        pieces = settled(copies.dropDuplicates(["doc_id", "content", "word"]))
    finally:
        _remove(spark, folder)
    in_order = Window.partitionBy("doc_id", "content").orderBy("word")
    reached = F.max(F.col("last") + min_words).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce((F.col("word") > reached).cast("int"), F.lit(1))
    spans = pieces.withColumn("begins", begins).withColumn("span", F.sum("begins").over(in_order))
    return spans.groupBy("doc_id", "content", "span").agg(
        F.min("begin").alias("begin"),
        F.max("end").alias("end"),
        (F.max("last") + min_words - F.min("word")).alias("n_words"),
        F.min_by("first_doc_id", "word").alias("first_doc_id"),
    ).select("doc_id", "begin", "end", "n_words", "first_doc_id")
