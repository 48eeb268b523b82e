"""Line dedup: an exact set-similarity join of lines by prefix filtering.

A line is the set of its words (A-Z lower-cased). Sets are ordered by the rarity of their
words; two sets with Jaccard of at least t share a word among the first
n - ceil(t n) + 1 of each. Lines that share such a word meet as one unit of work, where the
length filter, a sketch of the symmetric difference and the positional filter leave pairs
that are then verified on their words. A line is removed when any earlier line, by
(doc_id, line number), is similar enough; lines with equal sets are decided by their digest
and need no pairs.

Rarity comes from the number of words in each of BUCKETS buckets, and for the FREQUENT most
common words from their own: it only orders the words, so the tables' sizes change the speed
and never the result.

Texts are split, hashed and sorted as numpy columns. The postings (word, line) of a map task
go out as packed columns, one row for each of some groups of words, so that the JVM moves few
rows whatever their number; a group is compared as a whole, sorted by unit and size, and only
pairs whose sizes fit are looked at.

Defined cases: a null text stays null and has no lines; lines without a word always stay;
a null doc_id comes before all others; rows that repeat a doc_id have the same rank, so
equal lines at the same place in them are no copies of each other; an empty table gives an
empty result; the input's columns travel in one struct, so no name can clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.common import (
    packed,
    pieces,
    short_lived_shuffles,
    small_batches,
    small_or_shuffled,
    split_texts,
    with_text,
    words_of,
)
from tablegate.llm.runs import BLOCK_ROWS, spans
from tablegate.session import materialize, staged

THRESHOLD = Fraction(4, 5)
FREQUENT = 1 << 16
# Words that are counted at a time.
WORDS_AT_ONCE = 1 << 22
# Buckets in which words are counted, and how many of them travel as one row.
BUCKETS = 1 << 22
SLICE = 1 << 16
# Codes from here on are places among the frequent words, lower ones the logs of counts.
PLACES = 256
# Longer words are hashed one by one.
LONG_WORD = 512
# A sketch has 64 bits for every so many words, in powers of two up to the widest.
WORDS_PER_SKETCH = 64
WIDEST_SKETCH = 16
# Postings that a task packs at a time, and those of a group, of which a word in four makes one.
PACKED = 1 << 19
GROUP_ROWS = 1 << 17
GROUPS = 256
# Pairs that are looked at a time, and held before those beyond a line's first partners go.
PAIRS_AT_ONCE = 1 << 16
HELD_PAIRS = 1 << 21
# Words of open lines that are broadcast.
OPEN_KEYS = 1 << 20
# Partners of a line in a unit that are verified first; others only if all of these fail.
PARTNERS = 8
NULL_DOC = -(1 << 63)

ID = ["doc", "line_no", "digest"]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
# The bytes of a little-endian word of eight that a piece of so many bytes has.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def lines_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split(b"\n")


def mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """Other 64-bit hashes of 64-bit keys."""
    x = keys ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def digests(keys: np.ndarray, starts: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each set, whatever the order of its keys."""
    sums = np.add.reduceat(mixed(keys, salt), starts)
    return mixed(sums, salt + 1).view(np.int64)


def flat(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of all texts or binaries as one array, and the offsets of each); no nulls."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, kind), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset :][: len(column) + 1]
    at = at.astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind), at - at[0]


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, eight bytes at a time; ``data`` has eight bytes more at its end.

    Words of at most eight bytes never share a hash with another of their length.
    """
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    hashes = mixed(lengths.astype(np.uint64), 7)
    at, left = starts, lengths
    rows = None
    while len(at):
        now = mixed((hashes if rows is None else hashes[rows]) ^ (eight[at] & MASKS[np.minimum(left, 8)]), 11)
        if rows is None:
            hashes = now
            rows = np.flatnonzero((left > 8) & (left <= LONG_WORD))
            at, left = at[rows] + 8, left[rows] - 8
        else:
            hashes[rows] = now
            more = left > 8
            rows, at, left = rows[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(lengths > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]].tobytes())
    return hashes


def hashes_of(words: pa.Array) -> np.ndarray:
    """The hashes of some words."""
    data, offsets = flat(words, np.uint8)
    return word_hashes(np.append(data, np.zeros(8, np.uint8)), offsets[:-1], np.diff(offsets))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the words, and of each line with a word its text, number and words)."""
    raw, offsets = flat(pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else ""), np.uint8)
    data = np.zeros(len(raw) + 8, np.uint8)
    np.take(LOWER, raw, out=data[: len(raw)])
    blank = BLANK[raw]
    real = np.flatnonzero(np.diff(offsets))
    start, end = ~blank, ~blank
    start[1:] &= blank[:-1]
    start[offsets[real]] = ~blank[offsets[real]]
    end[:-1] &= blank[1:]
    end[offsets[real + 1] - 1] = ~blank[offsets[real + 1] - 1]
    starts = np.flatnonzero(start)
    hashes = word_hashes(data, starts, np.flatnonzero(end) + 1 - starts)

    breaks = np.flatnonzero(raw == 10)
    lines = np.diff(np.searchsorted(breaks, offsets)) + 1
    first = np.cumsum(lines) - lines
    line_starts = np.zeros(lines.sum(), np.int64)
    later = np.ones(len(line_starts), bool)
    later[first] = False
    line_starts[first], line_starts[later] = offsets[:-1], breaks + 1
    counts = np.diff(np.append(np.searchsorted(starts, line_starts), len(starts)))
    has = counts > 0
    number = np.arange(len(line_starts)) - np.repeat(first, lines)
    return hashes, np.repeat(np.arange(len(lines)), lines)[has], number[has], counts[has]


def word_sets(
    hashes: np.ndarray, counts: np.ndarray, codes: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(the different words of each line, in the order of their codes, and how many it has)."""
    line = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    code = np.zeros(len(hashes), np.uint16) if codes is None else codes[hashes & np.uint64(BUCKETS - 1)]
    order = code.astype(np.uint64) << np.uint64(32) | hashes >> np.uint64(32)
    exact = len(counts) > 1 << 16
    if not exact:
        order |= line << np.uint64(48)
        at = np.argsort(order)
        tied = order[at[1:]] == order[at[:-1]]
        exact = bool((tied & (hashes[at[1:]] != hashes[at[:-1]])).any())
    if exact:
        at = np.lexsort((hashes, code, line))
    line, hashes = line[at], hashes[at]
    new = np.ones(len(at), bool)
    new[1:] = (line[1:] != line[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.bincount(line[new].astype(np.int64), minlength=len(counts))


def line_digests(texts: list[bytes], salt: int = 1) -> np.ndarray:
    """The digest of each line, 0 for one without a word."""
    hashes, text, _, counts = tokens(pa.array([x.replace(b"\n", b" ") for x in texts], pa.binary()))
    out = np.zeros(len(texts), np.int64)
    if len(text):
        keys, sizes = word_sets(hashes, counts)
        out[text] = digests(keys, np.cumsum(sizes) - sizes, salt)
    return out


def sketch_words(sizes: np.ndarray) -> np.ndarray:
    words = np.ones(len(sizes), np.int64)
    while (few := (words * WORDS_PER_SKETCH < sizes) & (words < WIDEST_SKETCH)).any():
        words[few] *= 2
    return words


def sketches(keys: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sketches, words of each): the parity of the hashes of a set that fall on each bit.

    The XOR of two sketches is that of the sets' symmetric difference.
    """
    widths = sketch_words(sizes)
    hashes = mixed(keys, 5)
    bit = np.left_shift(np.uint64(1), hashes & np.uint64(63))
    place = (hashes >> np.uint64(6)).astype(np.int64) & np.repeat(widths - 1, sizes)
    out = np.zeros(widths.sum(), np.uint64)
    np.bitwise_xor.at(out, place + np.repeat(np.cumsum(widths) - widths, sizes), bit)
    return out, widths


def prefix_lengths(sizes: np.ndarray, threshold: Fraction) -> np.ndarray:
    sizes = sizes.astype(np.int64)
    return sizes + (-threshold.numerator * sizes) // threshold.denominator + 1


def binaries(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The array cut into binaries of so many of its elements."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]) * data.itemsize
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(
        pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    )


def word_counts(docs: DataFrame, limit: int) -> DataFrame:
    """Counts of words: (word, n) of the most common of some words at a time, and the sum of
    all for a null word; (slice, places, times) of the buckets that a task's words fall in.

    Of some words at a time those with a share of over 1 / (4 limit) are named, so no word
    with a share of 1.25 / limit in the whole is missed.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        size = 0
        seen = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for words, _ in split_texts(batch.column("text")):
                held.append(words)
                size += len(words)
                if size >= WORDS_AT_ONCE:
                    yield counted(held, seen)
                    held, size = [], 0
        yield counted(held, seen)
        for at in range(0, BUCKETS, SLICE):
            places = np.flatnonzero(seen[at : at + SLICE])
            if len(places):
                times = np.minimum(seen[at + places], (1 << 16) - 1)
                yield rows(
                    slice=pa.array([at // SLICE], pa.int32()),
                    places=pa.array([places.astype("<u2").tobytes()], pa.binary()),
                    times=pa.array([times.astype("<u2").tobytes()], pa.binary()),
                )

    def counted(held: list[pa.Array], seen: np.ndarray) -> pa.RecordBatch:
        found = pa.chunked_array(held, pa.binary()).value_counts()
        words, times = found.field("values"), found.field("counts").to_numpy()
        np.add.at(seen, (hashes_of(words) & np.uint64(BUCKETS - 1)).astype(np.int64), times)
        kept = times * 4 * limit > times.sum()
        return rows(
            word=pa.concat_arrays([words.filter(pa.array(kept)), pa.array([None], pa.binary())]),
            n=pa.array(np.append(times[kept], times.sum()), pa.int64()),
        )

    def rows(**columns: pa.Array) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [columns.get(c, pa.nulls(size, kind)) for c, kind in kinds.items()], names=list(kinds)
        )

    kinds = {"word": pa.binary(), "n": pa.int64(), "slice": pa.int32(), "places": pa.binary(), "times": pa.binary()}
    schema = "word binary, n long, slice int, places binary, times binary"
    return materialize(docs.select("text").mapInArrow(count, schema))


def _ranked(counts: DataFrame, limit: int) -> tuple[dict[bytes, int], int]:
    counts = materialize(counts.filter("slice IS NULL").groupBy("word").agg(F.sum("n").alias("n")))
    total = counts.filter("word IS NULL").first()
    if total is None:
        return {}, 0
    # At most `limit` words can have so large a share: a bounded table.
    rows = counts.filter(F.col("word").isNotNull() & (F.col("n") * limit > total["n"])).collect()
    ranked = sorted((r["n"], bytes(r["word"])) for r in rows)
    return {word: (1 << 63) + i for i, (_, word) in enumerate(ranked)}, total["n"]


def frequent_words(docs: DataFrame, limit: int = FREQUENT) -> tuple[dict[bytes, int], int]:
    """Order keys of the most common words, at most ``limit``, and the number of all words."""
    return _ranked(word_counts(docs, limit), limit)


def word_order(docs: DataFrame, limit: int) -> tuple[np.ndarray, int]:
    """(a code of each bucket, the number of all words): rarer words have lower codes.

    A bucket that holds one word of the texts has code 0: no two lines share it.
    """
    counts = word_counts(docs, limit)
    frequent, total = _ranked(counts, limit)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, sums = None, np.zeros(SLICE, np.int64)
        for batch in batches:
            for n, places, times in zip(*(batch.column(c).to_pylist() for c in ("slice", "places", "times"))):
                if n != number and number is not None:
                    yield logs(number, sums)
                    sums = np.zeros(SLICE, np.int64)
                number = n
                sums[np.frombuffer(places, "<u2")] += np.frombuffer(times, "<u2")
        if number is not None:
            yield logs(number, sums)

    def logs(number: int, sums: np.ndarray) -> pa.RecordBatch:
        logs = np.floor(4 * np.log2(np.maximum(sums, 1))).astype(np.uint8)
        return pa.RecordBatch.from_pydict(
            {"slice": pa.array([number], pa.int32()), "codes": pa.array([logs.tobytes()], pa.binary())}
        )

    slices = counts.filter("slice IS NOT NULL").select("slice", "places", "times")
    slices = slices.repartition("slice").sortWithinPartitions("slice").mapInArrow(added, "slice int, codes binary")
    codes = np.zeros(BUCKETS, np.uint16)
    for row in slices.collect():
        at = row["slice"] * SLICE
        codes[at : at + SLICE] = np.frombuffer(row["codes"], np.uint8)
    words = sorted(frequent, key=frequent.__getitem__)
    places = (hashes_of(pa.array(words, pa.binary())) & np.uint64(BUCKETS - 1)).astype(np.int64)
    codes[places] = np.minimum(PLACES + np.arange(len(words)), (1 << 16) - 1)
    return codes, total


def line_sets(docs: DataFrame, codes, threshold: Fraction) -> DataFrame:
    """(doc, line_no, digest, digest2, size, sketch, prefix) of each line with a word."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc").to_numpy(zero_copy_only=False)
            for at, texts in pieces(batch.column("text")):
                hashes, text, number, counts = tokens(texts)
                if len(text):
                    yield table(docs[at + text], number, *word_sets(hashes, counts, codes.value))

    def table(docs: np.ndarray, numbers: np.ndarray, keys: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        starts = np.cumsum(sizes) - sizes
        lengths = prefix_lengths(sizes, threshold)
        offsets = np.cumsum(lengths) - lengths
        taken = np.repeat(starts - offsets, lengths) + np.arange(lengths.sum())
        return pa.RecordBatch.from_pydict(
            {
                "doc": pa.array(docs, pa.int64()),
                "line_no": pa.array(numbers, pa.int32()),
                "digest": pa.array(digests(keys, starts, 1)),
                "digest2": pa.array(digests(keys, starts, 3)),
                "size": pa.array(sizes, pa.int32()),
                "sketch": binaries(*sketches(keys, sizes)),
                "prefix": binaries(keys[taken], lengths),
            }
        )

    schema = "doc long, line_no int, digest long, digest2 long, size int, sketch binary, prefix binary"
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_DOC)).alias("doc"), "text")
    return source.mapInArrow(rows, schema)


def near(
    sketch: np.ndarray, at: np.ndarray, width: np.ndarray, x: np.ndarray, y: np.ndarray, limit: np.ndarray
) -> np.ndarray:
    """Where the sketches of two rows, ``width`` words ``at`` a place, allow that difference.

    What is left of them in 64 bits has been looked at before.
    """
    out = np.ones(len(x), bool)
    wide = np.flatnonzero((width[x] > 1) & (width[y] > 1))
    for a, b in {*zip(width[x[wide]].tolist(), width[y[wide]].tolist())}:
        rows = np.flatnonzero((width[x] == a) & (width[y] == b))
        to, step = min(a, b), max(1, (1 << 20) // max(a, b))
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            # The wider sketch's words fold onto each other.
            bits = np.zeros((len(part), to), np.uint64)
            for side, w in ((x, a), (y, b)):
                taken = sketch[at[side[part]][:, None] + np.arange(w)]
                bits ^= np.bitwise_xor.reduce(taken.reshape(len(part), w // to, to), axis=1)
            out[part] = np.bitwise_count(bits).sum(axis=1, dtype=np.int64) <= limit[part]
    return out


# A posting's packed columns.
POSTING = {
    "unit": np.uint64, "doc": np.int64, "line_no": np.int32, "digest": np.int64,
    "size": np.int32, "pos": np.int32, "open": np.bool_, "sketch": np.uint64,
}


def postings(sets: DataFrame, codes, threshold: Fraction, groups: int, hot=None, only=None) -> DataFrame:
    """(part, POSTING): packed postings of words that other lines may have, sorted by part.

    A word is one unit; for one of ``hot`` (words, blocks of lines) each pair of blocks is a
    unit. With ``only`` the postings of these words alone.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for columns in dealt(batch) if batch.num_rows else ():
                held.append(columns)
                size += len(columns["unit"])
                if size >= PACKED:
                    yield from out(held)
                    held, size = [], 0
        yield from out(held)

    def dealt(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
        taken = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*ID, "size", "open")}
        key, _ = flat(batch.column("prefix"), np.uint64)
        lengths = prefix_lengths(taken["size"], threshold)
        row = np.repeat(np.arange(batch.num_rows), lengths)
        pos = np.arange(len(key)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        kept = np.flatnonzero(codes.value[key & np.uint64(BUCKETS - 1)] > 0)
        if only is not None:
            kept = kept[found(only.value, key[kept])[1]]
        place, is_hot = found(hot.value[0] if hot is not None else key[:0], key[kept])
        blocks = np.where(is_hot, hot.value[1][place], 1) if hot is not None else np.ones(len(kept), np.int64)
        bits, offsets = flat(batch.column("sketch"), np.uint64)
        for at, end, n in spans(blocks, PACKED):
            again = np.repeat(np.arange(at, end), n)
            unit, own_row = key[kept[again]], row[kept[again]]
            if n.max() > 1:
                other = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
                own = mixed(taken["digest"][own_row].view(np.uint64), 13) % blocks[again].astype(np.uint64)
                own = own.astype(np.int64)
                pair = np.minimum(own, other) << 32 | np.maximum(own, other)
                unit = np.where(is_hot[again], mixed(unit ^ mixed(pair.view(np.uint64), 17), 19), unit)
            yield {
                "unit": unit, "pos": pos[kept[again]], **{c: v[own_row] for c, v in taken.items()},
                "at": offsets[:-1][own_row] // 8, "bits": bits,
            }

    def out(held: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        before = np.cumsum([0, *(len(h["bits"]) for h in held)])
        at = np.concatenate([h["at"] + b for h, b in zip(held, before)])
        bits = np.concatenate([h["bits"] for h in held])
        every = {c: np.concatenate([h[c] for h in held]).astype(kind) for c, kind in POSTING.items() if c != "sketch"}
        part = (mixed(every["unit"], 23) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part = part[order]
        edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else part
        edges = np.append(edges, len(part))
        for i in range(0, len(edges) - 1, 64):
            cut = edges[i : i + 65]
            rows = order[cut[0] : cut[-1]]
            packed = {c: binaries(v[rows], np.diff(cut)) for c, v in every.items()}
            width = sketch_words(every["size"][rows])
            ends = np.cumsum(width)
            taken = np.repeat(at[rows] - (ends - width), width) + np.arange(ends[-1])
            lengths = np.diff(np.append(0, ends)[cut - cut[0]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cut[:-1]], pa.int32()), *packed.values(), binaries(bits[taken], lengths)],
                names=["part", *packed, "sketch"],
            )

    schema = "part int, " + ", ".join(f"{c} binary" for c in POSTING)
    source = sets.select(*ID, "size", "open", "prefix", "sketch")
    return source.mapInArrow(deal, schema).repartition("part").sortWithinPartitions("part")


def found(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place among the known sorted keys, whether the key is there) of each key."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return place, known[place] == keys


def hot_words(sets: DataFrame, codes, threshold: Fraction, block_rows: int) -> DataFrame:
    """(key, n) of the words in more prefixes than a block has rows.

    A word has at most as many lines as its bucket has words, so few have to be counted.
    """
    least = math.floor(4 * math.log2(block_rows))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, _ = flat(batch.column("prefix"), np.uint64)
            often = key[codes.value[key & np.uint64(BUCKETS - 1)] >= least]
            keys, n = np.unique(often.view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys), "n": pa.array(n, pa.int64())})

    counts = sets.select("prefix").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") > block_rows)


def groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The packed postings of each part, as columns."""
    part, held = None, {c: [] for c in POSTING}
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part and part is not None:
                yield {c: np.frombuffer(b"".join(v), POSTING[c]) for c, v in held.items()}
                held = {c: [] for c in POSTING}
            part = row["part"]
            for c in POSTING:
                held[c].append(row[c])
    if part is not None:
        yield {c: np.frombuffer(b"".join(v), POSTING[c]) for c, v in held.items()}


def candidates(packed: DataFrame, threshold: Fraction, every: bool) -> DataFrame:
    """(x's ID, y's ID, more): pairs of lines that pass the filters, y before x.

    With ``every`` all pairs whose x is open; else the first PARTNERS y for each x and unit,
    and ``more`` if there are others.
    """
    up, down = threshold.numerator, threshold.denominator
    out = [f"{side}_{c}" for side in "xy" for c in ID]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in groups_of(batches):
            yield from pairs_in(columns)

    def pairs_in(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        bits, width = columns["sketch"], sketch_words(columns["size"])
        order = np.lexsort((columns["size"], columns["unit"]))
        at = np.cumsum(width) - width
        narrow = np.bitwise_xor.reduceat(bits, at)[order]
        at, width = at[order], width[order]
        columns = {c: v[order] for c, v in columns.items() if c != "sketch"}
        unit, size, pos = columns["unit"], columns["size"].astype(np.int64), columns["pos"].astype(np.int64)
        # Length filter: of the rows after one in its unit those that are not too long.
        number = np.cumsum(np.concatenate([[0], unit[1:] != unit[:-1]])) << 32
        ends = np.searchsorted(number | size, number | size * down // up, "right")
        more = np.zeros(len(unit), bool)
        x = y = np.zeros(0, np.int64)
        # Differences of over 64 bits pass: larger sizes need not be told apart.
        small = (np.minimum(size, 64 * (down + up)) * (down - up)).astype(np.int32)
        for first, last, n in spans(ends - np.arange(len(unit)) - 1, PAIRS_AT_ONCE):
            b = np.arange(n.sum()) + np.repeat(np.arange(first + 1, last + 1) - (np.cumsum(n) - n), n)
            differ = np.bitwise_count(np.repeat(narrow[first:last], n) ^ narrow[b]).astype(np.int32)
            close = np.flatnonzero(differ * np.int32(down + up) <= np.repeat(small[first:last], n) + small[b])
            a, b = first + np.searchsorted(np.cumsum(n), close, "right"), b[close]
            limit = (size[a] + size[b]) * (down - up) // (down + up)
            # Words before the shared one and the most after it.
            overlap = np.minimum(size[a] - pos[a], size[b] - pos[b]) + np.minimum(pos[a], pos[b])
            fits = overlap * (up + down) >= up * (size[a] + size[b])
            a, b = swapped(columns, a[fits], b[fits])
            limit = limit[fits]
            if every:
                fits = columns["open"][a]
                a, b, limit = a[fits], b[fits], limit[fits]
            passed = near(bits, at, width, a, b, limit)
            x, y = np.concatenate([x, a[passed]]), np.concatenate([y, b[passed]])
            if len(x) > HELD_PAIRS:
                if every:
                    yield table(columns, x, y, more)
                    x = y = np.zeros(0, np.int64)
                else:
                    x, y = first_partners(columns, x, y, more)
        if not every:
            x, y = first_partners(columns, x, y, more)
        yield table(columns, x, y, more)

    def swapped(columns: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the later, the earlier) of each pair."""
        later = columns["digest"][a] > columns["digest"][b]
        for c in ("line_no", "doc"):
            later = np.where(columns[c][a] == columns[c][b], later, columns[c][a] > columns[c][b])
        return np.where(later, a, b), np.where(later, b, a)

    def first_partners(columns, x: np.ndarray, y: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort(tuple(columns[c][y] for c in reversed(ID)) + (x,))
        x, y = x[order], y[order]
        starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else x
        sizes = np.diff(np.append(starts, len(x)))
        first = np.arange(len(x)) - np.repeat(starts, sizes) < PARTNERS
        more[x[starts][sizes > PARTNERS]] = True
        return x[first], y[first]

    def table(columns, x: np.ndarray, y: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c][side]) for side in (x, y) for c in ID] + [pa.array(more[x])],
            names=[*out, "more"],
        )

    kinds = ["long", "int", "long"] * 2
    schema = ", ".join(f"{n} {k}" for n, k in zip(out, kinds)) + ", more boolean"
    return packed.mapInArrow(compare, schema)


def _words_of_lines(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(ID, words) of the given lines, found again in the documents."""
    wanted = materialize(ids.groupBy("doc").agg(F.collect_set(F.struct("line_no", "digest")).alias("lines")))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_DOC)).alias("doc"), "text")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, lines in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "lines"))):
                split = lines_of(text)
                for line in lines:
                    if line["line_no"] < len(split):
                        rows.append((doc, line["line_no"], line["digest"], split[line["line_no"]]))
            real = line_digests([row[3] for row in rows]).tolist()
            rows = [row for row, digest in zip(rows, real) if row[2] == digest]
            columns = zip(*rows) if rows else [[]] * 4
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=[*ID, "words"]
            )

    schema = "doc long, line_no int, digest long, words binary"
    found = texts.join(small_or_shuffled(wanted), "doc").select("doc", "text", "lines").mapInArrow(find, schema)
    return found.dropDuplicates(ID).withColumn("words", F.col("words").cast("string"))


def verified(docs: DataFrame, pairs: DataFrame, threshold: Fraction) -> DataFrame:
    """The ID of each x with a y whose Jaccard with it is at least the threshold."""
    pairs = materialize(pairs.drop("more").distinct())
    ids = pairs.select(*[F.col(f"x_{c}").alias(c) for c in ID]).union(
        pairs.select(*[F.col(f"y_{c}").alias(c) for c in ID])
    )
    words = materialize(_words_of_lines(docs, ids.distinct()))

    def side(name: str) -> DataFrame:
        return words.select(*[F.col(c).alias(f"{name}_{c}") for c in ID], F.col("words").alias(f"{name}_words"))

    for name in "xy":
        pairs = pairs.join(side(name), [f"{name}_{c}" for c in ID])
    up, down = threshold.numerator, threshold.denominator

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b, shared = shared_words(batch.column("x_words"), batch.column("y_words"))
                similar = pa.array(shared * down >= (a + b - shared) * up)
                yield batch.select(ID).filter(similar)

    pairs = pairs.select(*[F.col(f"x_{c}").alias(c) for c in ID], "x_words", "y_words")
    return pairs.mapInArrow(compare, "doc long, line_no int, digest long").distinct()


def shared_words(xs: pa.Array, ys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different words of each x, those of its y, those of both)."""
    words, counts = [], []
    for texts in (xs, ys):
        parts = [*split_texts(texts)]
        words += [part for part, _ in parts]
        counts.append(np.concatenate([n for _, n in parts]))
    codes = pa.concat_arrays(words).dictionary_encode().indices.to_numpy().astype(np.int64)
    rows = np.concatenate([np.repeat(np.arange(len(n)), n) for n in counts])
    at = counts[0].sum()
    x, y = (np.unique(rows[side] << 32 | codes[side]) for side in (slice(0, at), slice(at, None)))
    both = np.sort(np.concatenate([x, y]))
    both = both[1:][both[1:] == both[:-1]]
    return tuple(np.bincount(side >> 32, minlength=len(xs)) for side in (x, y, both))


def similar_lines(docs: DataFrame, sets: DataFrame, codes, threshold: Fraction, total_words: int) -> DataFrame:
    """The ID of each distinct line that has an earlier similar line with another set."""
    context = docs.sparkSession.sparkContext
    block_rows, hot, rows = BLOCK_ROWS, None, total_words // 4
    # At most one hot word for each block's rows of postings.
    counts = hot_words(sets, codes, threshold, block_rows).toArrow()
    if counts.num_rows:
        keys, n = counts.column("key").to_numpy().view(np.uint64), counts.column("n").to_numpy()
        order, blocks = np.argsort(keys), -(-n // block_rows)
        hot = context.broadcast((keys[order], blocks[order]))
        rows += int((n * blocks).sum())
    groups = max(GROUPS, rows // GROUP_ROWS)
    closed = sets.withColumn("open", F.lit(False))
    units = postings(closed, codes, threshold, groups, hot)
    pairs = materialize(candidates(units, threshold, every=False))
    similar = materialize(verified(docs, pairs, threshold))
    # Lines whose first partners all failed and who have others: look at all of those.
    rest = (
        pairs.filter("more")
        .select(*[F.col(f"x_{c}").alias(c) for c in ID])
        .distinct()
        .join(similar, ID, "left_anti")
    )
    rest = materialize(rest.withColumn("is_open", F.lit(True)))
    if not rest.limit(1).count():
        return similar
    marked = sets.join(small_or_shuffled(rest), ID, "left").withColumn(
        "open", F.coalesce("is_open", F.lit(False))
    )
    only = words_in(marked.filter("open"))
    units = postings(marked, codes, threshold, groups, hot, only and context.broadcast(only[0]))
    return materialize(
        similar.union(verified(docs, candidates(units, threshold, every=True), threshold))
    )


def words_in(sets: DataFrame) -> tuple[np.ndarray] | None:
    """The sorted words of the prefixes, or none of them if they are too many to broadcast."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, _ = flat(batch.column("prefix"), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(key.view(np.int64)))], names=["key"])

    keys = materialize(sets.select("prefix").mapInArrow(split, "key long").distinct())
    if keys.count() > OPEN_KEYS:
        return None
    return (np.sort(keys.toArrow().column("key").to_numpy().view(np.uint64)),)


def removed_lines(docs: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """(doc, numbers, digests): for each doc_id the lines to remove."""
    small_batches(docs.sparkSession)
    with short_lived_shuffles(docs.sparkSession):
        return _removed_lines(docs, threshold)


def _removed_lines(docs: DataFrame, threshold: Fraction) -> DataFrame:
    order, total = word_order(docs, FREQUENT)
    codes = docs.sparkSession.sparkContext.broadcast(order)
    with staged(line_sets(docs, codes, threshold), "lines") as lines:
        same, place = ["digest", "digest2"], F.struct("doc", "line_no")
        first = lines.groupBy(*same).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        repeated = small_or_shuffled(materialize(first.filter("n > 1").drop("n")))
        # One row of each set: those that have but one, and a first one of the others.
        firsts = lines.join(repeated, same).filter(place == F.col("first")).select(*lines.columns)
        firsts = materialize(firsts.dropDuplicates(same))
        sets = lines.join(repeated, same, "left_anti").select(*lines.columns).union(firsts)
        similar = similar_lines(docs, sets, codes, threshold, total)
        copies = lines.select(*ID, "digest2").join(repeated, same).filter(place > F.col("first"))
        gone = copies.select(*ID).union(similar.select(*ID))
        removed = gone.groupBy("doc").agg(F.collect_set(F.struct("line_no", "digest")).alias("lines"))
        return materialize(
            removed.select("doc", F.col("lines.line_no").alias("numbers"), F.col("lines.digest").alias("digests"))
        )


def dedup_lines(docs: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """(row, clean_text, removed): the texts without later copies, and the removed numbers."""
    removed = small_or_shuffled(removed_lines(docs, threshold))
    doc = F.coalesce(F.col("row.doc_id").cast("long"), F.lit(NULL_DOC))
    joined = packed(docs).join(removed, doc == F.col("doc"), "left")
    strip = F.pandas_udf(strip_lines, "text string, removed array<int>")
    clean = strip(F.col("row.text"), F.col("numbers"), F.col("digests"))
    return joined.select("row", clean.alias("clean")).select(
        "row",
        F.col("clean.text").alias("clean_text"),
        F.col("clean.removed").alias("removed"),
    )


def strip_lines(texts: pd.Series, numbers: pd.Series, digest_lists: pd.Series) -> pd.DataFrame:
    """Each text without the lines whose number and digest are given, and their numbers."""
    splits: dict[int, list[str]] = {}
    asked, found = [], []
    for at, (text, places) in enumerate(zip(texts, numbers)):
        if text is not None and places is not None:
            splits[at] = text.split("\n")
            for number in sorted(set(places)):
                if number < len(splits[at]):
                    asked.append((at, number))
                    found.append(splits[at][number].encode("utf-8", "surrogatepass").lower())
    listed = {at: set(zip(numbers.iloc[at], digest_lists.iloc[at])) for at in splits}
    out, gone = list(texts), [[] for _ in range(len(texts))]
    for (at, number), digest in zip(asked, line_digests(found).tolist()):
        if (number, digest) in listed[at]:
            gone[at].append(number)
    for at, split in splits.items():
        dropped = set(gone[at])
        out[at] = "\n".join(line for number, line in enumerate(split) if number not in dropped)
    return pd.DataFrame({"text": out, "removed": gone})


def without_copies(docs: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """The documents with later copies of lines removed, without those left wordless by it."""
    rows = dedup_lines(docs, threshold)
    same = F.size("removed") == 0
    left = F.size(words_of(F.coalesce("clean_text", F.lit("")))) > 0
    changed = with_text(docs, F.col("row"), F.col("clean_text"))
    stay = rows.filter(same | left)
    return stay.select(F.when(same, F.col("row")).otherwise(changed).alias("row")).select("row.*")
