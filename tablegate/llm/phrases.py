"""Phrase collocation mining by SON partitioning.

Texts are lower-cased (A-Z) and cut at punctuation into pieces and those into words; all is
counted for each language. A phrase of 2 to MAX_WORDS words within a piece is a candidate when
it occurs at least SUPPORT times. Candidates are found level by level:

1. every worker cuts its rows into shards of about SHARD_WORDS words and mines each one
   completely for phrases of the level's length, all of whose words and shorter phrases can
   be frequent, at a local support lowered to the shard's share of its language. A phrase
   that is below it in every shard is below SUPPORT in all;
2. the phrases that some shard found are united. Where a language is so large that every
   local support is 1 (SUPPORT shards or more), shards give complete counts, and the union
   keeps those that add up to SUPPORT;
3. after the last level the words of all united phrases are counted again in all texts, and
   only these exact counts decide.

Shards know phrases by 64-bit hashes, and unions travel as a bitmap of bounded size; both
can only let a phrase too many into the last count.

Defined cases: a null text is empty; a null language is ``und``; rows that repeat are texts of
their own; a very long text is a shard of its own; ties are broken by the phrase in the order
of its UTF-8 bytes; an empty table gives an empty result. Columns other than text and lang are
not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.common import settled, short_lived_shuffles, small_or_shuffled

SUPPORT = 10
MAX_WORDS = 3
INSIDE_PERCENT = 50
TOP = 2000
NO_LANG = "und"
# Words that a worker mines at a time.
SHARD_WORDS = 1 << 21
# Languages, the largest ones, whose totals are broadcast; others are mined at support 1.
LANGUAGES = 1024
# A phrase that occurs SUPPORT times takes as many words, so there is a bound on their number.
BITS_PER_ENTRY = 16
MAX_BITS = 1 << 28

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_BREAK, _SPACE = b"\n", b" "


def _folded(byte: int) -> int:
    if byte in SEPARATORS:
        return _BREAK[0]
    if byte == 9:
        return _SPACE[0]
    return byte + 32 if 65 <= byte <= 90 else byte


_FOLDED = bytes(map(_folded, range(256)))


class Numbers(dict):
    """Numbers words in the order they are first seen; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Shard:
    """The texts of some rows as word numbers, for each language."""

    def __init__(self):
        self.words = 0
        self.tables: dict[str, Numbers] = {}
        self.parts: dict[str, list[np.ndarray]] = {}

    def add(self, lang: str, text: bytes) -> None:
        table = self.tables.get(lang)
        if table is None:
            table = self.tables[lang] = Numbers()
            self.parts[lang] = []
        # Each break is a word of its own, so one split finds both.
        marked = text.translate(_FOLDED).replace(_BREAK, b" \n ") + b" \n"
        words = list(filter(None, marked.split(_SPACE)))
        self.words += len(words)
        self.parts[lang].append(np.fromiter(map(table.__getitem__, words), np.int32, len(words)))

    def languages(self) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        """(lang, words by number, word numbers in order) of each language."""
        for lang, table in self.tables.items():
            yield lang, list(table), np.concatenate(self.parts[lang])


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """As Spark's xxhash64(lang, word)."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its words but the last, and of the last."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Bitmap:
    """A set of hashes that may hold a few more."""

    def __init__(self, hashes: DataFrame, most: int):
        """``most`` bounds the number of hashes."""
        self.bits = 64
        while self.bits < min(most * BITS_PER_ENTRY, MAX_BITS):
            self.bits *= 2
        at = F.col("hash").bitwiseAND(F.lit(self.bits - 1))
        words = hashes.select(
            F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast(hash & 63 as int))").alias("bit")
        )
        # At most MAX_BITS / 64 rows.
        with short_lived_shuffles(hashes.sparkSession):
            table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        bits = np.zeros(self.bits >> 6, np.uint64)
        bits[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
        self._words = hashes.sparkSession.sparkContext.broadcast(bits)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(self.bits - 1)
        words = self._words.value[(at >> np.uint64(6)).astype(np.int64)]
        return (words >> (at & np.uint64(63))) & np.uint64(1) == 1


def phrase_hashes(
    hashes: np.ndarray, numbers: np.ndarray, sets: list[Bitmap], length: int
) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the phrases of a length whose words and shorter phrases are in ``sets``.

    ``sets`` hold the words, the phrases of two words, and so on.
    """
    usable = sets[0].holds(hashes)
    usable[0] = False
    places = np.flatnonzero(usable[numbers])
    values = hashes[numbers[places]]
    word_at = np.zeros(len(numbers) + 1, bool)
    word_at[places] = True
    for size in range(2, length + 1):
        # A phrase begins where one of a word less does, and where another follows a word on.
        follows = word_at[places + 1]
        places, values = places[follows], values[follows]
        values = joined(values, hashes[numbers[places + size - 1]])
        if size < length or len(sets) >= length:
            held = sets[size - 1].holds(values)
            places, values = places[held], values[held]
        word_at[:] = False
        word_at[places] = True
    return places, values


def distinct_rows(columns: list[np.ndarray], most: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of numbers below ``most``, and how often each occurs."""
    bits = max(1, most.bit_length())
    if bits * len(columns) < 64:
        packed = columns[0].astype(np.int64)
        for column in columns[1:]:
            packed = packed << bits | column
        found, counts = np.unique(packed, return_counts=True)
        low = (1 << bits) - 1
        return [(found >> bits * i) & low for i in range(len(columns) - 1, -1, -1)], counts
    order = np.lexsort(columns[::-1])
    first = np.ones(len(order), bool)
    for i, column in enumerate(columns):
        step = column[order][1:] != column[order][:-1]
        first[1:] = step if i == 0 else first[1:] | step
    starts = np.flatnonzero(first)
    return [c[order[starts]] for c in columns], np.diff(np.append(starts, len(order)))


def in_shards(
    docs: DataFrame,
    judge: Callable[[str, list[bytes], np.ndarray], pa.RecordBatch | None],
    schema: str,
    shard_words: int,
) -> DataFrame:
    """What ``judge`` makes of each shard's languages."""

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").cast(pa.binary()).to_pylist()
                for lang, text in zip(part.column("lang").to_pylist(), texts):
                    shard.add(lang, text)
                    if shard.words >= shard_words:
                        yield from filter(None, (judge(*own) for own in shard.languages()))
                        shard = Shard()
        yield from filter(None, (judge(*own) for own in shard.languages()))

    rows = docs.select(
        F.coalesce(F.col("lang"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(mine, schema)


def _strings(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def word_counts(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, phrase, a): how often each word occurs, and with a null phrase all words."""

    def judge(lang: str, words: list[bytes], numbers: np.ndarray) -> pa.RecordBatch | None:
        counts = np.bincount(numbers, minlength=len(words))
        counts[0] = len(numbers) - counts[0]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(counts)), _strings([None, *words[1:]]), pa.array(counts)],
            names=["lang", "phrase", "a"],
        )

    counted = in_shards(docs, judge, "lang string, phrase string, a long", shard_words)
    # Shards have counted already: nothing is left to add up before the shuffle.
    return counted.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def mined(
    docs: DataFrame, totals: dict[str, int], sets: list[Bitmap], length: int, support: int, shard_words: int
) -> DataFrame:
    """(hash): the united phrases of a length, and perhaps a few more."""

    def judge(lang: str, words: list[bytes], numbers: np.ndarray) -> pa.RecordBatch | None:
        _, values = phrase_hashes(word_hashes(lang, words), numbers, sets, length)
        found, counts = np.unique(values, return_counts=True)
        total = totals.get(lang)
        # A language of `support` shards or more has a local support of 1 in each.
        if total and total < support * shard_words:
            share = int(np.count_nonzero(numbers))
            frequent = counts >= -(-support * share // total)
            found, counts = found[frequent], np.full(int(frequent.sum()), support)
        return pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], names=["hash", "n"]
        )

    rows = in_shards(docs, judge, "hash long, n long", shard_words)
    return rows.repartition("hash").groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= support).select("hash")


def phrase_counts(
    docs: DataFrame, sets: list[Bitmap], support: int, shard_words: int
) -> DataFrame:
    """(lang, phrase, words, a): the exact counts of all phrases in ``sets``."""

    def judge(lang: str, words: list[bytes], numbers: np.ndarray) -> pa.RecordBatch | None:
        hashes, spelled = word_hashes(lang, words), pa.array(words, pa.binary())
        keys, counts = [], []
        for length in range(2, len(sets) + 1):
            places, _ = phrase_hashes(hashes, numbers, sets, length)
            # Phrases of equal words are counted by their numbers, not by their hash.
            rows, n = distinct_rows([numbers[places + i] for i in range(length)], len(words))
            phrase = pc.binary_join_element_wise(*[spelled.take(pa.array(c)) for c in rows], _SPACE)
            keys.append(pc.binary_join_element_wise(pa.scalar(lang.encode()), phrase, _BREAK))
            counts.append(n)
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(keys), pa.array(np.concatenate(counts).astype(np.int64))], names=["key", "a"]
        )

    rows = in_shards(docs, judge, "key binary, a long", shard_words)
    counted = rows.repartition("key").groupBy("key").agg(F.sum("a").alias("a")).filter(F.col("a") >= support)
    # The phrase comes after the last break: it has none, whatever the language is called.
    parts = counted.select(F.col("key").cast("string").alias("key"), "a").withColumn(
        "phrase", F.substring_index("key", "\n", -1)
    )
    lang = F.expr("left(key, length(key) - length(phrase) - 1)")
    return parts.select(lang.alias("lang"), "phrase", F.size(F.split("phrase", " ")).alias("words"), "a")


def candidates(
    docs: DataFrame, support: int = SUPPORT, max_words: int = MAX_WORDS, shard_words: int = SHARD_WORDS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, phrase, words, a) of all candidates, (lang, phrase, a) of frequent words, (lang, n)."""
    counted = word_counts(docs, shard_words)
    frequent = settled(counted.filter(F.col("phrase").isNull() | (F.col("a") >= support)))
    sizes = frequent.filter(F.col("phrase").isNull()).select("lang", F.col("a").alias("n"))
    largest = sizes.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    totals = {row["lang"]: row["n"] for row in largest}
    words = frequent.filter(F.col("phrase").isNotNull())
    most = (sizes.agg(F.sum("n")).first()[0] or 0) // support + 1
    sets = [Bitmap(words.select(F.xxhash64("lang", "phrase").alias("hash")), most)]
    for length in range(2, max_words + 1):
        sets.append(Bitmap(mined(docs, totals, sets, length, support, shard_words), most))
    return settled(phrase_counts(docs, sets, support, shard_words)), words, sizes


def _part(start: int | str, length: int | str) -> str:
    return f"array_join(slice(parts, {start}, {length}), ' ')"


def scored(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with l, r and the score of their lowest-scoring cut."""
    # A part of a candidate occurs as often at least: it is a frequent word or a candidate.
    parts = settled(found.select("lang", "phrase", "a").union(words.select("lang", "phrase", "a")))
    known = small_or_shuffled(parts)
    cuts = (
        found.withColumn("parts", F.split("phrase", " "))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        .select(
            "lang", "phrase", "words", "a", "k",
            F.expr(_part(1, "k")).alias("left"), F.expr(_part("k + 1", "words - k")).alias("right"),
        )
    )
    left = known.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    exact = {c: f"cast({c} as decimal(19, 0))" for c in "alr"}
    score = F.expr(
        f"cast(1000000 as decimal(7, 0)) * ({exact['a']} * {exact['a']}) div ({exact['l']} * {exact['r']})"
    )
    cut = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    lowest = cut.groupBy("lang", "phrase", "words", "a").agg(best)
    return lowest.select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def outlying(rows: DataFrame, found: DataFrame, inside_percent: int) -> DataFrame:
    """The rows but those that occur mostly inside a longer candidate."""
    longest = found.filter(F.col("words") > 2).withColumn("parts", F.split("phrase", " "))
    sizes = F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")
    spans = longest.select("lang", "parts", "words", "a", sizes).select(
        "lang", "parts", "a", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at")
    )
    inside = spans.select("lang", F.expr(_part("at", "size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(
        F.max("a").alias("longer")
    )
    beside = rows.join(inside, ["lang", "phrase"], "left")
    return beside.filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_percent)
    ).drop("longer")


def collocations(
    docs: DataFrame,
    support: int = SUPPORT,
    max_words: int = MAX_WORDS,
    inside_percent: int = INSIDE_PERCENT,
    top: int = TOP,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases."""
    found, words, sizes = candidates(docs, support, max_words, shard_words)
    rows = outlying(scored(found, words), found, inside_percent)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(small_or_shuffled(sizes), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
