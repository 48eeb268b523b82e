"""An interpolated modified Kneser-Ney model of order 2 or 3, counted in Spark.

The model is a folder of sorted arrays in the shared folder: the words' hashes with their
counts and continuation statistics, and for each shard the sorted codes of the bigrams with
their counts. Workers memory-map them. Bigrams below ``min_count`` are counted in every
statistic and their mass goes to the lower order, but they are not stored; by default all
are stored.

A model of order 3 also holds the trigrams, coded by the place of their first two words in
the bigrams' shard and the third word. Its bigrams score by the number of different words
before them; those at the beginning of a text, which nothing precedes, by their count.

Counting: tasks send each shard one compressed block of sorted bigram codes; a shard holds
a bounded number of bigrams, so the number of shards grows with the input. Contexts with
more than their share of tokens are spread over SALTS shards.

Defined cases: a null text is the empty text, its only token is the end; a null doc_id is
the empty text for the fold, and so held out; without training texts every probability is
that of one unseen word; repeated rows count as often as they occur; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.common import short_lived_shuffles, split_texts
from tablegate.llm.language import fold_of
from tablegate.llm.store import Counts, open_array, write_array, write_counts
from tablegate.session import _remove, materialize, scratch_path

FOLDS = 10
ORDER = 3
MIN_COUNT = 1
TOKENS_PER_SHARD = 4_000_000
WORDS_PER_PART = 8_000_000
SALTS = 64
# A context with more than this share of the tokens is salted.
HOT_SHARE = 1 / 500
# Tokens handled as arrays at a time.
TOKENS_AT_ONCE = 1 << 20

# No word holds a line end, so these name the end token and the context before a text.
END, BEGIN = b"\n", b"\n\n"


# Word ids that two of fit a code of 63 bits, and maps that a worker keeps open.
MOST_WORDS = (1 << 31) - 1
MOST_MAPS = 512


def hash_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


@dataclass(frozen=True)
class Model:
    """Sizes and sums of a model; the arrays are in ``folder``."""

    folder: str
    parts: int
    shards: int
    words: int = 0
    tokens: int = 0
    hot: int = 0
    min_count: int = MIN_COUNT
    # Numbers of bigram and trigram types with count 1 to 4, and of words with continuation 1 to 4.
    bigram_counts: tuple[int, ...] = (0, 0, 0, 0)
    trigram_counts: tuple[int, ...] = (0, 0, 0, 0)
    # All trigram types, also those seen more often.
    trigram_types: int = 0
    word_counts: tuple[int, ...] = (0, 0, 0, 0)
    types: int = 0
    many: int = 0
    order: int = 2


def discounts(counts: tuple[int, ...]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from the numbers of types seen 1-4 times."""
    n1, n2, n3, n4 = counts
    if not (n1 and n2):
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return np.clip(d, 0.0, [0, 1, 2, 3])


@dataclass(frozen=True)
class Tokens:
    """The tokens of some texts, an END after each, as places in the list of their words."""

    words: list[bytes]
    index: np.ndarray
    lengths: np.ndarray


class Vocabulary:
    """Ids of words: their places in the sorted hashes, -1 for unknown words."""

    def __init__(self, model: Model):
        self.model = model
        self.hashes = [open_array(model.folder, f"hash-{i}", "<i8") for i in range(model.parts)]
        self.starts = np.cumsum([0, *map(len, self.hashes)])
        self.lasts = np.array([h[-1] if len(h) else -(1 << 63) for h in self.hashes], np.int64)
        self.lasts = np.maximum.accumulate(self.lasts) if len(self.lasts) else self.lasts

    def search(self, hashes: np.ndarray) -> np.ndarray:
        part = np.searchsorted(self.lasts, hashes)
        out = np.full(len(hashes), -1, np.int64)
        for i in np.unique(part):
            if i < len(self.hashes) and len(self.hashes[i]):
                at = np.flatnonzero(part == i)
                place = np.searchsorted(self.hashes[i], hashes[at])
                found = self.hashes[i][np.minimum(place, len(self.hashes[i]) - 1)] == hashes[at]
                out[at[found]] = self.starts[i] + place[found]
        return out

    def ids(self, words: list[bytes]) -> np.ndarray:
        hashes = np.fromiter(map(hash_of, words), np.int64, len(words))
        # In order, a search stays near the one before it.
        order = np.argsort(hashes)
        out = np.empty(len(words), np.int64)
        out[order] = self.search(hashes[order])
        return out

    def placed(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, int]:
        """The sorted ids of the words and BEGIN; in them the tokens' places, and BEGIN's."""
        ids = self.ids([*tokens.words, BEGIN])
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        return ids[order], rank[tokens.index], int(rank[-1])

    def column(self, name: str, kind: str) -> list[np.ndarray]:
        return [open_array(self.model.folder, f"{name}-{i}", kind) for i in range(self.model.parts)]

    def take(self, column: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
        """The column's values at the ids; 0 for -1."""
        out = np.zeros(len(ids), np.int64)
        part = np.searchsorted(self.starts, ids, "right") - 1
        for i, values in enumerate(column):
            at = np.flatnonzero((part == i) & (ids >= 0))
            out[at] = values[ids[at] - self.starts[i]]
        return out


def shard_of(model: Model, left: np.ndarray, right: np.ndarray, left_count: np.ndarray) -> np.ndarray:
    """A bigram's shard: that of its context, salted by the word for hot contexts."""
    salt = np.where(left_count > model.hot, right % SALTS, 0)
    code = (left * SALTS + salt).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((code >> np.uint64(33)) % np.uint64(model.shards)).astype(np.int64)


def batches_of_tokens(columns: Iterator[pa.Array]) -> Iterator[Tokens]:
    """The tokens of the texts, some TOKENS_AT_ONCE at a time."""
    held: list[tuple[pa.Array, np.ndarray]] = []
    size = 0
    for texts in columns:
        for words, counts in split_texts(texts):
            held.append((words, counts))
            size += len(words) + len(counts)
            if size >= TOKENS_AT_ONCE:
                yield tokens_of(held)
                held, size = [], 0
    if size:
        yield tokens_of(held)


def tokens_of(held: list[tuple[pa.Array, np.ndarray]]) -> Tokens:
    coded = pa.concat_arrays([words for words, _ in held]).dictionary_encode()
    words = coded.dictionary.to_pylist()
    lengths = np.concatenate([counts for _, counts in held]) + 1
    ends = np.cumsum(lengths) - 1
    own = np.ones(lengths.sum(), bool)
    own[ends] = False
    index = np.full(len(own), len(words), np.int64)
    index[own] = coded.indices.to_numpy()
    return Tokens([*words, END], index, lengths)


def contexts(ids: np.ndarray, lengths: np.ndarray, begin: int) -> np.ndarray:
    """For each token the id of the one before it, or of the text's beginning."""
    left = np.empty_like(ids)
    left[1:] = ids[:-1]
    left[np.cumsum(lengths) - lengths] = begin
    return left


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
    for batch in batches:
        yield batch.column("text")


def count_words(training: DataFrame, folder: str) -> Model:
    """Writes the sorted hashes and counts of all words of the training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens in batches_of_tokens(_texts(batches)):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*map(hash_of, tokens.words), hash_of(BEGIN)], pa.int64()),
                    pa.array(np.append(np.bincount(tokens.index, minlength=len(tokens.words)), 0), pa.int64()),
                ],
                names=["hash", "n"],
            )

    counted = training.mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    # Hashes are uniform: their first bits deal out parts of about equal size.
    sums = materialize(counted)
    total = sums.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens"), F.count(F.when(F.col("n") > 0, 1)).alias("words")
    ).first()
    if total["rows"] > MOST_WORDS:
        raise ValueError(f"{total['rows']} different words: two ids fit one code up to {MOST_WORDS}")
    bits = (total["rows"] // WORDS_PER_PART).bit_length()
    parts = 1 << bits

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, columns in _groups(batches, "part", ["hash", "n"]):
            write_array(folder, f"hash-{part}", columns["hash"])
            write_array(folder, f"count-{part}", columns["n"])
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64())], names=["part"])

    place = F.shiftright("hash", 64 - bits) + (parts >> 1) if bits else F.lit(0).cast("long")
    dealt = sums.select(place.alias("part"), "hash", "n")
    written = dealt.repartition(min(parts, 200_000), "part").sortWithinPartitions("part", "hash")
    done = {r["part"] for r in written.mapInArrow(write, "part long").collect()}
    for part in range(parts):
        if part not in done:
            write_array(folder, f"hash-{part}", np.zeros(0, "<i8"))
            write_array(folder, f"count-{part}", np.zeros(0, "<i8"))
    tokens = total["tokens"] or 0
    return Model(
        folder, parts, tokens // TOKENS_PER_SHARD + 1, total["words"], tokens, int(tokens * HOT_SHARE)
    )


def _groups(batches: Iterator[pa.RecordBatch], key: str, names: list[str]):
    """(key, columns) of sorted rows, one group at a time."""
    held: list[pa.RecordBatch] = []
    now = None

    def columns() -> dict:
        table = pa.Table.from_batches(held)
        return {n: table.column(n).to_numpy() for n in names}

    for batch in batches:
        keys = batch.column(key).to_numpy()
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(edges, edges[1:]):
            if a < b:
                if held and keys[a] != now:
                    yield now, columns()
                    held = []
                now = int(keys[a])
                held.append(batch.slice(a, b - a))
    if held:
        yield now, columns()


def pack(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted codes and their counts, byte by byte and compressed."""
    columns = np.diff(codes >> 32, prepend=0), codes & 0xFFFFFFFF, counts
    planes = [c.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]
    data = pa.Codec("zstd", compression_level=1).compress(b"".join(planes), asbytes=True)
    return len(codes).to_bytes(8, "little") + data


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(block[:8], "little")
    data = pa.Codec("zstd").decompress(block[8:], 12 * n, asbytes=True)
    planes = np.frombuffer(data, np.uint8).reshape(3, 4, n).transpose(0, 2, 1)
    steps, low, counts = planes.copy().view("<u4").reshape(3, n).astype(np.int64)
    return np.cumsum(steps) << 32 | low, counts


def stable_order(keys: np.ndarray) -> np.ndarray:
    """Their order; small keys are sorted by their digits."""
    small = len(keys) and keys.min() >= 0 and keys.max() < 1 << 16
    return np.argsort(keys.astype(np.uint16) if small else keys, kind="stable")


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


FIELDS = ["before", "total", "ones", "twos", "more"]
STATS = "id long, " + ", ".join(f"{f} long" for f in FIELDS)


def kinds_of(counts: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Numbers of types with count 1, 2 and 3 or more in the groups from the starts."""
    return [np.add.reduceat(kind * 1, starts) for kind in (counts == 1, counts == 2, counts > 2)]


def numbers_of(counts: np.ndarray) -> np.ndarray:
    return np.array([(counts == i).sum() for i in range(1, 5)], np.int64)


def statistics(codes: np.ndarray, counts: np.ndarray, *numbers: np.ndarray) -> pa.RecordBatch:
    """The words' statistics in a shard of bigrams; numbers of types have negative ids."""
    left, right = codes >> 32, codes & 0xFFFFFFFF
    seen, starts = np.unique(left, return_index=True)
    after, before = np.unique(right, return_counts=True)
    extra = np.concatenate([numbers_of(counts), *numbers])
    ids = np.concatenate([seen, after, -1 - np.arange(len(extra))])
    zero = np.zeros(len(after) + len(extra), np.int64)
    first = np.concatenate([np.zeros(len(seen), np.int64), before, extra])
    rest = [np.add.reduceat(counts, starts), *kinds_of(counts, starts)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(first)] + [pa.array(np.concatenate([x, zero])) for x in rest],
        names=["id", *FIELDS],
    )


def blocks_of(key: np.ndarray, codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Keys and their packed blocks, of codes that are sorted."""
    order = stable_order(key)
    key, codes, times = key[order], codes[order], times[order]
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, int)
    return key[edges[:-1]], [pack(codes[a:b], times[a:b]) for a, b in zip(edges, edges[1:])]


def dealt_blocks(blocks: DataFrame, model: Model, start: bytes = b"") -> DataFrame:
    """The blocks by shard, with an empty one for each so that none is missing."""
    none = F.lit(bytearray(start + pack(np.zeros(0, np.int64), np.zeros(0, np.int64))))
    every = blocks.sparkSession.range(model.shards).select(F.col("id").alias("shard"), none.alias("block"))
    return blocks.union(every).repartition(min(model.shards, 200_000), "shard").sortWithinPartitions("shard")


def count_bigrams(training: DataFrame, model: Model) -> Model:
    """Writes the shards of bigrams and the statistics of all words."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        counts = vocabulary.column("count", "<i8")
        for tokens in batches_of_tokens(_texts(batches)):
            ids, index, begin = vocabulary.placed(tokens)
            pairs, times = np.unique(contexts(index, tokens.lengths, begin) << 32 | index, return_counts=True)
            first, last = pairs >> 32, pairs & 0xFFFFFFFF
            left, right = ids[first], ids[last]
            shard = shard_of(model, left, right, vocabulary.take(counts, ids)[first])
            keys, blocks = blocks_of(shard, left << 32 | right, times)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(blocks, pa.binary())], names=["shard", "block"]
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, columns in _groups(batches, "shard", ["block"]):
            unpacked = [unpack(b) for b in columns["block"]]
            codes, counts = summed(*(np.concatenate(x) for x in zip(*unpacked)))
            stored = counts >= model.min_count
            write_array(model.folder, f"bigram-{shard}", codes[stored])
            write_counts(model.folder, f"bigram-count-{shard}", counts[stored])
            if model.order == 2:
                yield statistics(codes, counts)

    blocks = training.mapInArrow(send, "shard long, block binary")
    found = dealt_blocks(blocks, model).mapInArrow(merge, STATS)
    if model.order > 2:
        found.count()
        found = count_trigrams(training, model)
    stats = materialize(found.groupBy("id").agg(*[F.sum(f).alias(f) for f in FIELDS]))
    numbers = {r["id"]: r["before"] for r in stats.filter("id < 0").collect()}
    return write_stats(stats.filter("id >= 0"), replace(
        model,
        bigram_counts=tuple(numbers.get(-i, 0) for i in range(1, 5)),
        trigram_counts=tuple(numbers.get(-i, 0) for i in range(5, 9)),
        trigram_types=numbers.get(-9, 0),
    ), FIELDS)


@dataclass(frozen=True)
class Places:
    """Where bigrams are: shard and place, -1 for none; and each shard's rows that are stored."""

    shards: np.ndarray
    place: np.ndarray
    stored: list[tuple[int, np.ndarray]]


class Bigrams:
    """The memory-mapped shards of bigrams."""

    def __init__(self, model: Model, vocabulary: Vocabulary):
        self.model, self.vocabulary = model, vocabulary
        self.counts = vocabulary.column("count", "<i8")
        self.opened: dict[tuple[str, int], np.ndarray | Counts] = {}

    def array(self, name: str, shard: int, kind: str = "<i8") -> np.ndarray:
        if (name, shard) not in self.opened:
            if len(self.opened) >= MOST_MAPS:
                self.opened.clear()
            self.opened[name, shard] = open_array(self.model.folder, f"{name}-{shard}", kind)
        return self.opened[name, shard]

    def places(self, left: np.ndarray, right: np.ndarray) -> Places:
        """Each bigram's shard and its place there."""
        shards, out = np.zeros(len(left), np.int64), np.full(len(left), -1, np.int64)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        codes = left[at] << 32 | right[at]
        shards[at] = shard_of(self.model, left[at], right[at], self.vocabulary.take(self.counts, left[at]))
        stored = []
        for shard, rows in grouped(shards[at]):
            place = found_in(self.array("bigram", shard), codes[rows])
            out[at[rows]] = place
            stored.append((shard, at[rows[place >= 0]]))
        return Places(shards, out, stored)

    def counted(self, name: str, shard: int) -> Counts:
        if (name, shard) not in self.opened:
            if len(self.opened) >= MOST_MAPS:
                self.opened.clear()
            self.opened[name, shard] = Counts(self.model.folder, f"{name}-{shard}")
        return self.opened[name, shard]

    def take(self, name: str, places: Places) -> np.ndarray:
        """The counts at the places; 0 for those not stored."""
        out = np.zeros(len(places.place), np.int64)
        for shard, rows in places.stored:
            out[rows] = self.counted(name, shard)[places.place[rows]]
        return out


def grouped(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key with its rows."""
    order = stable_order(keys)
    edges = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0, [True]])) if len(keys) else []
    for a, b in zip(edges, edges[1:]):
        yield int(keys[order[a]]), order[a:b]


def found_in(known: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Places of the codes among the sorted known ones, or -1."""
    if not len(known):
        return np.full(len(codes), -1, np.int64)
    place = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    return np.where(known[place] == codes, place, -1)


def trigram_shard(model: Model, shard: np.ndarray, count: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A trigram's shard: that of its first two words, salted by the third for hot ones."""
    return shard * SALTS + np.where(count > model.hot, word % SALTS, 0)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def after_first(lengths: np.ndarray) -> np.ndarray:
    """The tokens that are not the first of their text."""
    inner = np.ones(lengths.sum(), bool)
    inner[starts_of(lengths)] = False
    return np.flatnonzero(inner)


def count_trigrams(training: DataFrame, model: Model) -> DataFrame:
    """Writes the shards of trigrams and the bigrams' statistics; gives those of the words."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        bigrams = Bigrams(model, vocabulary)
        for tokens in batches_of_tokens(_texts(batches)):
            ids, index, begin = vocabulary.placed(tokens)
            pairs, which = np.unique(contexts(index, tokens.lengths, begin) << 32 | index, return_inverse=True)
            # The pair before each word but a text's first is the one that ends there.
            at = after_first(tokens.lengths)
            codes, times = np.unique(which[at - 1] << 32 | index[at], return_counts=True)
            pair, word = codes >> 32, ids[codes & 0xFFFFFFFF]
            places = bigrams.places(ids[pairs >> 32], ids[pairs & 0xFFFFFFFF])
            counts = bigrams.take("bigram-count", places)
            key = trigram_shard(model, places.shards[pair], counts[pair], word)
            keys, blocks = blocks_of(key, places.place[pair] << 32 | word, times)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(blocks, pa.binary())], names=["shard", "block"]
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, columns in _groups(batches, "shard", ["block"]):
            unpacked = [unpack(b) for b in columns["block"]]
            codes, counts = summed(*(np.concatenate(x) for x in zip(*unpacked)))
            write_array(model.folder, f"trigram-{key}", codes)
            write_counts(model.folder, f"trigram-count-{key}", counts)
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64())], names=["shard"])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        bigrams = Bigrams(model, vocabulary)
        for key in (k for batch in batches for k in batch.column("shard").to_pylist()):
            codes = open_array(model.folder, f"trigram-{key}", "<i8")
            counts = Counts(model.folder, f"trigram-count-{key}").all()
            place, word = codes >> 32, codes & 0xFFFFFFFF
            shard = key // SALTS
            left = bigrams.array("bigram", shard)[place] & 0xFFFFFFFF
            # One more word stands before each of these bigrams.
            later, before = np.unique(left << 32 | word, return_counts=True)
            left, word = later >> 32, later & 0xFFFFFFFF
            to = shard_of(model, left, word, vocabulary.take(bigrams.counts, left))
            keys, blocks = blocks_of(to, later, before)
            # The first byte tells these from the statistics of what follows a bigram.
            first, starts = np.unique(place, return_index=True)
            follow = [pack(first[x > 0] << 32, x[x > 0]) for x in kinds_of(counts, starts)]
            summary = np.array([key, *numbers_of(counts), len(counts)], "<i8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*keys.tolist(), shard, shard, shard, -1], pa.int64()),
                    pa.array(
                        [b"\0" + b for b in blocks] + [bytes([i]) + b for i, b in enumerate(follow, 1)] + [summary],
                        pa.binary(),
                    ),
                ],
                names=["shard", "block"],
            )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = int(Vocabulary(model).ids([BEGIN])[0])
        nothing = np.zeros(0, np.int64)
        for shard, columns in _groups(batches, "shard", ["block"]):
            if shard < 0:
                rows = np.array([np.frombuffer(b, "<i8") for b in columns["block"]])
                rows = rows[np.argsort(rows[:, 0])]
                write_array(model.folder, "trigram-shards", rows[:, 0].astype("<i8"))
                yield statistics(nothing, nothing, rows[:, 1:].sum(axis=0))
                continue
            codes = open_array(model.folder, f"bigram-{shard}", "<i8")
            counts = Counts(model.folder, f"bigram-count-{shard}").all()
            sums = [np.zeros(len(codes), np.int64) for _ in range(4)]
            for block in columns["block"]:
                number, (own, times) = block[0], unpack(block[1:])
                sums[number][found_in(codes, own) if number == 0 else own >> 32] += times
            adjusted = np.where(codes >> 32 == begin, counts, sums[0])
            write_counts(model.folder, f"bigram-before-{shard}", adjusted)
            for name, values in zip(("ones", "twos", "more"), sums[1:]):
                write_counts(model.folder, f"bigram-{name}-{shard}", values)
            yield statistics(np.asarray(codes), adjusted)

    blocks = training.mapInArrow(send, "shard long, block binary")
    dealt = blocks.repartition(min(model.shards, 200_000), "shard").sortWithinPartitions("shard")
    # Two jobs: the trigrams' blocks are dropped before those of their statistics are dealt.
    merged = materialize(dealt.mapInArrow(merge, "shard long"))
    later = dealt_blocks(merged.mapInArrow(describe, "shard long, block binary"), model, b"\0")
    return later.mapInArrow(finish, STATS)


def write_stats(stats: DataFrame, model: Model, fields: list[str]) -> Model:
    """Writes the words' statistics beside their hashes, part by part."""
    sizes = [0] * model.parts
    if model.words:
        sizes = [len(h) for h in Vocabulary(model).hashes]
    starts = np.cumsum([0, *sizes])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, columns in _groups(batches, "part", ["id", *fields]):
            for field in fields:
                values = np.zeros(sizes[part], "<i4" if field != "total" else "<i8")
                values[columns["id"] - starts[part]] = columns[field]
                write_array(model.folder, f"{field}-{part}", values)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64())], names=["part"])

    bounds = F.lit(0).cast("long")
    for start in starts[1:-1].tolist():
        bounds = bounds + (F.col("id") >= start).cast("long")
    dealt = stats.select(bounds.alias("part"), "id", *fields)
    written = dealt.repartition(min(model.parts, 200_000), "part").sortWithinPartitions("part")
    done = {r["part"] for r in written.mapInArrow(write, "part long").collect()}
    for part in set(range(model.parts)) - done:
        for field in fields:
            write_array(model.folder, f"{field}-{part}", np.zeros(sizes[part], "<i4" if field != "total" else "<i8"))
    before = F.col("before")
    sums = stats.agg(
        F.sum("before").alias("types"),
        F.count(F.when(before > 2, 1)).alias("many"),
        *[F.count(F.when(before == i, 1)).alias(f"n{i}") for i in range(1, 5)],
    ).first()
    return replace(
        model,
        word_counts=tuple(sums[f"n{i}"] for i in range(1, 5)),
        types=sums["types"] or 0,
        many=sums["many"],
    )


def train(training: DataFrame, folder: str, min_count: int = MIN_COUNT, order: int = 2) -> Model:
    """A model of the ``text`` of the training rows, in ``folder``."""
    if order not in (2, 3) or (order == 3 and min_count > 1):
        raise ValueError("the order is 2, or 3 with all bigrams stored")
    texts = training.select("text")
    model = replace(count_words(texts, folder), min_count=min_count, order=order)
    return count_bigrams(texts, model)


class Scorer:
    """Log10 probabilities under a memory-mapped model."""

    def __init__(self, model: Model):
        self.model = model
        self.vocabulary = Vocabulary(model)
        v = self.vocabulary
        self.counts = v.column("count", "<i8")
        self.totals = v.column("total", "<i8")
        self.small = {f: v.column(f, "<i4") for f in ("before", "ones", "twos", "more")}
        self.bigrams = Bigrams(model, v)
        self.d1 = discounts(model.word_counts)
        self.d2 = discounts(model.bigram_counts)
        self.d3 = discounts(model.trigram_counts)
        self.trigrams: dict[int, tuple[np.ndarray, Counts]] = {}
        self.shards: set[int] = set()
        if model.trigram_types:
            self.shards = set(open_array(model.folder, "trigram-shards", "<i8").tolist())

    def trigram_counts(self, key: np.ndarray, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes), np.int64)
        for shard, rows in grouped(key):
            if shard not in self.shards:
                continue
            if shard not in self.trigrams:
                if len(self.trigrams) >= MOST_MAPS:
                    self.trigrams.clear()
                self.trigrams[shard] = (
                    open_array(self.model.folder, f"trigram-{shard}", "<i8"),
                    Counts(self.model.folder, f"trigram-count-{shard}"),
                )
            known, counts = self.trigrams[shard]
            place = found_in(known, codes[rows])
            out[rows] = np.where(place >= 0, counts[place], 0)
        return out

    def unigram(self, right: np.ndarray) -> np.ndarray:
        """Kneser-Ney probability by the number of different words before a word."""
        m = self.model
        if not m.types:
            return np.full(len(right), 1 / (m.words + 1))
        before = self.vocabulary.take(self.small["before"], right)
        n1, n2, _, _ = m.word_counts
        spare = (self.d1[1] * n1 + self.d1[2] * n2 + self.d1[3] * m.many) / m.types
        own = np.maximum(before - self.d1[np.minimum(before, 3)], 0) / m.types
        return own + spare / (m.words + 1)

    def score(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text its known tokens, base score and log10 probability.

        What a word or a bigram has is looked up once for all its tokens.
        """
        m, v = self.model, self.vocabulary
        ids, index, begin = v.placed(tokens)
        c = v.take(self.counts, ids)
        base = np.log10((c + 0.1) / (m.tokens + 0.1 * (m.words + 1)))
        pairs, which = np.unique(contexts(index, tokens.lengths, begin) << 32 | index, return_inverse=True)
        first, last = pairs >> 32, pairs & 0xFFFFFFFF
        total = v.take(self.totals, ids)[first]
        ones, twos, more = (v.take(self.small[f], ids)[first] for f in ("ones", "twos", "more"))
        places = self.bigrams.places(ids[first], ids[last])
        pair = self.bigrams.take("bigram-before" if m.order > 2 else "bigram-count", places)
        held = np.maximum(pair - self.d2[np.minimum(pair, 3)], 0)
        # The whole mass of bigrams that are not stored goes to the lower order.
        spare = (1.0 if m.min_count > 1 else self.d2[1]) * ones
        spare = spare + (2.0 if m.min_count > 2 else self.d2[2]) * twos + self.d2[3] * more
        some = np.maximum(total, 1)
        lower = self.unigram(ids)[last]
        p = np.where(total > 0, held / some + spare / some * lower, lower)
        own = np.log10(p)[which]
        if m.order > 2:
            at = after_first(tokens.lengths)
            triples, place = np.unique(which[at - 1] << 32 | which[at], return_inverse=True)
            own[at] = np.log10(self.after_two(triples, p, ids[last], places))[place]
        starts = starts_of(tokens.lengths)
        return (
            np.add.reduceat((c > 0)[index] * 1, starts),
            np.add.reduceat(base[index], starts),
            np.add.reduceat(own, starts),
        )

    def after_two(self, triples: np.ndarray, lower: np.ndarray, word: np.ndarray, places: Places) -> np.ndarray:
        """Probabilities after two words, where those were seen together, else after one.

        A triple names its first two words and its last two among the bigrams, which have the
        probabilities ``lower`` and end with the ids ``word``.
        """
        b = self.bigrams
        before, own = triples >> 32, triples & 0xFFFFFFFF
        p = lower[own]
        at = np.flatnonzero(places.place[before] >= 0)
        before, own = before[at], own[at]
        d = self.d3
        totals = b.take("bigram-count", places)
        spares = sum(d[i] * b.take(f"bigram-{name}", places) for i, name in enumerate(("ones", "twos", "more"), 1))
        total, spare, word = totals[before], spares[before], word[own]
        count = np.zeros(len(at), np.int64)
        known = np.flatnonzero(word >= 0)
        key = trigram_shard(self.model, places.shards[before[known]], total[known], word[known])
        count[known] = self.trigram_counts(key, places.place[before[known]] << 32 | word[known])
        p[at] = np.maximum(count - d[np.minimum(count, 3)], 0) / total + spare / total * lower[own]
        return p


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            at = 0
            for tokens in batches_of_tokens([batch.column("text")]):
                lengths = tokens.lengths
                known, base, own = scorer.score(tokens)
                part = batch.slice(at, len(lengths))
                at += len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out")] + [pa.array(x) for x in (lengths, known, base, own)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    scored = docs.select("doc_id", "held_out", "text").mapInArrow(score, schema)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def trained_and_scored(
    docs: DataFrame, folds: int = FOLDS, min_count: int = MIN_COUNT, order: int = 2
) -> DataFrame:
    """Scores of all texts under the model of those whose fold is not 0.

    The model is dropped once the scores are kept, or when a step fails.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", (fold_of(F.col("doc_id"), folds) == 0).alias("held_out"), "text")
    folder = scratch_path(spark, "ngram-model")
    try:
        with short_lived_shuffles(spark):
            model = train(rows.filter("NOT held_out"), folder, min_count, order)
            return materialize(scores(rows, model))
    finally:
        _remove(spark, folder)
