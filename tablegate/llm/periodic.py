"""Periodic runs of words, found with an enhanced suffix array.

A run is a stretch of words with a smallest period q (words q apart are identical) that no
neighbouring word extends, of at least max(MIN_LENGTH, MIN_REPEATS * q) words. Texts are
read in slices; a slice's suffixes are sorted by doubling, text by text, and a table of
longest common prefixes (LCP) stands beside them. For each LCP interval of depth d the
suffixes i of all children but the largest ask the inverse suffix array whether i + d or
i - d is in the interval too, in another child: then the words at that place are a square of
period d that the next word breaks. Each square is rotated to the left as far as the words
repeat; squares of one stretch are one run, with the smallest period. No tree is built, and a
text of n words asks at most n log n times.

The longest of two suffixes q apart in a run share max(MIN_LENGTH - q, (MIN_REPEATS - 1) q)
words, so texts whose suffixes all differ within the least of that have no run: they
are done after a few doublings.

Defined cases: a null or empty text has no word and no run, its clean text stays null or
empty; a very long text is a slice of its own; rows are judged one by one, so repeated rows
get equal results; an empty table gives an empty result; the input's columns travel in one
struct, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.common import packed

MIN_LENGTH = 24
MIN_REPEATS = 3
# Bytes of text whose suffixes are sorted at a time.
SLICE_BYTES = 1 << 20
# Suffixes that ask at a time.
ASKED_AT_ONCE = 1 << 20


class Numbers(dict):
    """Numbers words in the order they are first seen."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def least_shared(min_length: int, min_repeats: int) -> int:
    """The words that two suffixes of any run share at least."""
    return min(max(min_length - q, (min_repeats - 1) * q) for q in range(1, min_length + 2))


class Suffixes:
    """The suffixes of several texts, sorted text by text.

    ``words`` holds each text's word numbers and then a number of its own, ``text`` the
    number of the text at each place.
    """

    def __init__(self, texts: list[np.ndarray]):
        sizes = np.array([len(t) + 1 for t in texts])
        self.ends = np.cumsum(sizes) - 1
        self.text = np.repeat(np.arange(len(texts)), sizes)
        self.words = np.concatenate([np.append(t, -1 - i) for i, t in enumerate(texts)])
        most = int(self.words.max(initial=0)) + 2
        key = self.text * most + np.maximum(self.words, -1) + 1
        self.order = np.argsort(key, kind="stable")
        self.levels: list[np.ndarray] = []
        self.rank = np.empty(len(key), np.int64)
        self._regroup(np.arange(len(key)), self.order, key[self.order])

    def _regroup(self, places: np.ndarray, suffixes: np.ndarray, keys: np.ndarray) -> None:
        """Sorted suffixes of equal keys get the first of their places as rank."""
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        starts = np.flatnonzero(first)
        self.rank[suffixes] = places[np.repeat(starts, np.diff(np.append(starts, len(keys))))]
        single = first & np.append(first[1:], True)
        self.open = places[~single]

    def double(self) -> None:
        """Sort by twice as many words; only suffixes not yet told apart are moved."""
        shared = 1 << len(self.levels)
        self.levels.append(self.rank.astype(np.int32))
        suffixes = self.order[self.open]
        key = self.rank[suffixes] * len(self.words) + self.rank[suffixes + shared]
        by = np.argsort(key, kind="stable")
        places = self.open
        self.order[places] = suffixes[by]
        self._regroup(places, suffixes[by], key[by])

    def repeating(self, shared: int) -> np.ndarray:
        """The texts with two suffixes that share this many words, or a few less."""
        while len(self.open) and 2 << len(self.levels) <= shared:
            self.double()
        return np.unique(self.text[self.order[self.open]])

    def lcp(self) -> np.ndarray:
        """Words that each sorted suffix shares with the one before it."""
        while len(self.open):
            self.double()
        out = np.zeros(len(self.order) + 1, np.int64)
        same = np.flatnonzero(self.words[self.order[1:]] == self.words[self.order[:-1]]) + 1
        same = same[self.text[self.order[same]] == self.text[self.order[same - 1]]]
        a, b = self.order[same - 1].copy(), self.order[same].copy()
        for level in range(len(self.levels) - 1, -1, -1):
            ranks = self.levels[level]
            step = (ranks[a] == ranks[b]).astype(np.int64) << level
            a += step
            b += step
        out[same] = b - self.order[same]
        return out


def smaller_beside(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the nearest place before and after it with a smaller one."""
    values = lcp.tolist()
    before, after = [0] * len(values), [len(values)] * len(values)
    stack = [0]
    for j in range(1, len(values)):
        value = values[j]
        while stack and values[stack[-1]] > value:
            after[stack.pop()] = j
        if stack:
            top = stack[-1]
            before[j] = before[top] if values[top] == value else top
        stack.append(j)
    # Equal neighbours on the stack end together.
    out = np.array(after)
    return np.array(before), out


def branching_squares(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the squares that the word after them breaks."""
    lcp = suffixes.lcp()
    order, inverse = suffixes.order, suffixes.rank
    before, after = smaller_beside(lcp)
    inner = np.flatnonzero(lcp)
    if not len(inner):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # The entries of an interval share its depth and its left end, and cut it into children.
    inner = inner[np.lexsort((inner, lcp[inner], before[inner]))]
    depth, low = lcp[inner], before[inner]
    first = np.ones(len(inner), bool)
    first[1:] = (depth[1:] != depth[:-1]) | (low[1:] != low[:-1])
    last = np.append(first[1:], True)
    interval = np.cumsum(first) - 1
    high = after[inner][last]
    starts = np.concatenate([low[first], inner])
    of = np.concatenate([interval[first], interval])
    by = np.lexsort((starts, of))
    starts, of = starts[by], of[by]
    ends = np.append(starts[1:], 0)
    closing = np.append(of[1:] != of[:-1], True)
    ends[closing] = high
    sizes = ends - starts
    # The largest child, the first of several, does not ask.
    ranked = np.lexsort((-sizes, of))
    largest = ranked[np.append(True, of[ranked][1:] != of[ranked][:-1])]
    asking = np.ones(len(starts), bool)
    asking[largest] = False
    depth, low = depth[first], low[first]
    starts, ends, sizes, of = starts[asking], ends[asking], sizes[asking], of[asking]
    places, periods = [], []
    total = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(total, total[at] + ASKED_AT_ONCE, "right")) - 1)
        n = sizes[at:end]
        child = np.repeat(np.arange(at, end), n)
        rows = starts[child] + np.arange(len(child)) - np.repeat(total[at:end] - total[at], n)
        place, d = order[rows], depth[of[child]]
        for sign in (1, -1):
            other = place + sign * d
            inside = other >= 0
            found = np.full(len(other), -1)
            found[inside] = inverse[other[inside]]
            hit = (found >= low[of[child]]) & (found < high[of[child]])
            hit &= (found < starts[child]) | (found >= ends[child])
            places.append(np.minimum(place, other)[hit])
            periods.append(d[hit])
        at = end
    return np.concatenate(places), np.concatenate(periods)


def repeated_before(words: np.ndarray, place: int, period: int, least: int) -> int:
    """How far to the left of ``place``, down to ``least``, words still repeat after a period."""
    low, step = place, 32
    while low > least:
        start = max(least, low - step)
        differ = np.flatnonzero(words[start:low] != words[start + period : low + period])
        if len(differ):
            return start + int(differ[-1]) + 1
        low, step = start, 2 * step
    return low


def runs_of(texts: list[np.ndarray], min_length: int, min_repeats: int) -> dict[int, list[tuple[int, int, int]]]:
    """{text: [(start, length, period)]} of the texts that have runs, by start, then period."""
    shared = least_shared(min_length, min_repeats)
    every = Suffixes(texts)
    wanted = every.repeating(shared).tolist()
    if not wanted:
        return {}
    suffixes = every if len(wanted) == len(texts) else Suffixes([texts[i] for i in wanted])
    words = suffixes.words
    begin = np.concatenate([[0], suffixes.ends[:-1] + 1])
    place, period = branching_squares(suffixes)
    # Most squares are not in a run: the word that must repeat before them does not.
    back = np.maximum(min_length, min_repeats * period) - 2 * period
    some = place - back >= begin[suffixes.text[place]]
    place, period, back = place[some], period[some], back[some]
    for part in (0, 1, 2):
        before = (np.minimum(back, 1), back, (back + 1) // 2)[part]
        some = words[place - before] == words[place - before + period]
        place, period, back = place[some], period[some], back[some]
    end = place + 2 * period
    found: dict[int, list[tuple[int, int, int]]] = {}
    # Squares that end together, by period: the multiples of a run's period are its own.
    by = np.lexsort((period, end))
    known: list[tuple[int, int]] = []
    last = -1
    for p, q, e in zip(place[by].tolist(), period[by].tolist(), end[by].tolist()):
        if e != last:
            known, last = [], e
        if any(q % period == 0 and p >= start for start, period in known):
            continue
        text = int(suffixes.text[p])
        least = int(begin[text])
        start = repeated_before(words, p, q, least)
        known.append((start, q))
        if e - start >= max(min_length, min_repeats * q):
            found.setdefault(wanted[text], []).append((start - least, e - start, q))
    return {text: sorted(own, key=lambda run: (run[0], run[2])) for text, own in found.items()}


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: a run keeps its first period only."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth)[:n] == 0


def periodic_runs(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS
) -> DataFrame:
    """(row, n_words, runs, clean_text): every text's runs, and its words without their repeats.

    ``runs`` are (start, length, period) in words from 0, by start, then period;
    ``clean_text`` holds the words that stay, one space between them.
    """

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(t.as_buffer() or b"") if t.is_valid else 0 for t in batch.column("text")])
        piece = np.cumsum(sizes) // SLICE_BYTES
        edges = [0, *(np.flatnonzero(piece[1:] != piece[:-1]) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            if end > start:
                yield batch.slice(start, end - start)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [t.as_buffer().to_pybytes() if t.is_valid else None for t in part.column("text").cast(pa.binary())]
                words = [(t or b"").split() for t in texts]
                number = Numbers().__getitem__
                found = runs_of(
                    [np.fromiter(map(number, w), np.int64, len(w)) for w in words], min_length, min_repeats
                )
                clean = []
                for i, (text, own) in enumerate(zip(texts, words)):
                    if i in found:
                        stay = kept_words(len(own), found[i]).tolist()
                        own = [w for w, keep in zip(own, stay) if keep]
                    clean.append(None if text is None else b" ".join(own))
                own_runs = [
                    [{"start": s, "length": n, "period": q} for s, n, q in found.get(i, [])]
                    for i in range(len(texts))
                ]
                run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array(own_runs, pa.list_(run)),
                        pa.array(clean, pa.binary()).cast(pa.string()),
                    ],
                    names=["row", "n_words", "runs", "clean_text"],
                )

    rows = packed(docs)
    kind = rows.schema["row"].dataType.simpleString()
    schema = (
        f"row {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, "
        "clean_text string"
    )
    return rows.select("row", F.col("row.text").alias("text")).mapInArrow(find, schema)
