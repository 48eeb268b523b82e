"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a window of tokens whose zeros are ignored, so a substituted
token at such a place does not hide a passage. Seeds of items and documents are joined on
their hash; each hit gives a shift between the two, along which the passage is verified.
The masks are chosen so that whatever verification accepts has a hit.

Defined cases: null texts have no tokens; items with fewer than MIN_TOKENS tokens are too
short to be evidence and match nothing; ones shorter than a window are a window of their
own length; rows that repeat a (doc_id, text) or (item_id, text) give one result; without
items or documents the result is empty.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.llm.common import content_hash, packed, small_or_shuffled, text_of
from tablegate.operators.once import computed_once
from tablegate.session import materialize

# Seven tokens each. Together they hit every window of WINDOW tokens that is verified.
MASKS = ("1101011011", "1011101101", "1110010111", "111110011")
# Masks of items shorter than WINDOW, by the least number of tokens they serve; each set
# hits every item of such a length that is verified. They are used where items need them.
SHORT_MASKS = {
    5: ("1111", "11101", "11011", "10111"),
    6: ("11111", "111101", "111011", "110111", "101111"),
    7: ("11111", "111011", "110111"),
    8: ("111111", "1111011", "1101111"),
    10: ("1110111", "11011011", "111111", "111000111", "1101001011"),
}
MIN_TOKENS = 5
# A passage is verified if this many percent of some window of this many tokens agree.
WINDOW = 13
MIN_PERCENT = 80


def tokens_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _seeds(rows: DataFrame, masks: Mapping[int, str]) -> DataFrame:
    """The rows with (at, seed): a row for each mask and place of the ``tokens``.

    Tokens are hashed once; then places are exploded, and the seeds are plain expressions
    over one row, few enough for one compiled method.
    """
    others = [c for c in rows.columns if c != "tokens"]
    span = min(map(len, masks.values()))
    hashed = rows.select(*others, F.transform("tokens", lambda t: F.xxhash64(t)).alias("hashes"))
    n = F.size("hashes")
    at = F.when(n >= span, F.sequence(F.lit(0), n - span))
    placed = hashed.select(*others, "hashes", F.explode(at).alias("at"))
    seeds = []
    for number, mask in masks.items():
        taken = [F.get("hashes", F.col("at") + i) for i, bit in enumerate(mask) if bit == "1"]
        seed = F.xxhash64(F.lit(number), *taken)
        seeds.append(seed if len(mask) == span else F.when(F.col("at") + len(mask) <= n, seed))
    return placed.select(*others, "at", F.explode(F.array(*seeds)).alias("seed"))


def _items(benchmark: DataFrame) -> DataFrame:
    return (
        benchmark.select("item_id", tokens_of(text_of()).alias("item_tokens"))
        .filter(F.size("item_tokens") >= MIN_TOKENS)
        .distinct()
        .withColumn("item_key", F.xxhash64("item_id", "item_tokens"))
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, masks: Sequence[str] = MASKS) -> DataFrame:
    """(doc_id, content, item_id, best_window, matched_tokens, item_length).

    One row for each (doc_id, text) and item whose passage is verified; ``content`` is the
    hash of the text. best_window counts the equal tokens of the best window.
    """
    sets = {**SHORT_MASKS, WINDOW: masks}
    items = materialize(_items(benchmark))
    size = F.size("item_tokens")
    # The set that serves an item: a handful of values.
    least = F.lit(min(sets))
    for length in sorted(sets):
        least = F.when(size >= length, length).otherwise(least)
    item_rows = items.select("item_key", F.col("item_tokens").alias("tokens"), least.alias("least"))
    used = [r[0] for r in item_rows.select("least").distinct().collect()] or [WINDOW]
    numbers = {mask: i for i, mask in enumerate(dict.fromkeys(m for length in sorted(used) for m in sets[length]))}
    all_masks = {i: mask for mask, i in numbers.items()}
    seeds = None
    for length in used:
        own = item_rows.filter(F.col("least") == length).drop("least")
        found = _seeds(own, {numbers[mask]: mask for mask in sets[length]})
        seeds = found if seeds is None else seeds.union(found)
    seeds = small_or_shuffled(
        materialize(seeds.select("item_key", F.col("at").alias("item_at"), "seed"))
    )

    text = text_of()
    rows = docs.select("doc_id", content_hash(text).alias("content"), tokens_of(text).alias("tokens"))
    hits = _seeds(rows, all_masks).join(seeds, "seed")
    shifts = materialize(
        hits.select(
            "doc_id", "content", "item_key", (F.col("at") - F.col("item_at")).alias("shift")
        ).distinct()
    )

    # Only texts with a hit are read on; they are shuffled only beyond the measured limit.
    found = small_or_shuffled(shifts.withColumnRenamed("doc_id", "hit_id"))
    texts = docs.select("doc_id", content_hash(text).alias("text_hash"), text.alias("doc_text"))
    candidates = texts.join(
        found,
        (F.col("text_hash") == F.col("content")) & F.col("doc_id").eqNullSafe(F.col("hit_id")),
    ).dropDuplicates(["doc_id", "content", "item_key", "shift"])
    pairs = candidates.join(small_or_shuffled(items), "item_key").select(
        "doc_id", "content", "item_id", "item_key", "shift", "item_tokens", "doc_text"
    )
    # Arrays that a lambda refers to are computed once per row, not once per element.
    pairs = computed_once(pairs, {"tokens": tokens_of(F.col("doc_text"))}).drop("doc_text")
    equal = F.transform(
        "item_tokens",
        lambda token, i: F.when(
            token == F.get("tokens", F.col("shift") + i), F.lit(1)
        ).otherwise(F.lit(0)),
    )
    length = F.size("item_tokens")
    window = F.least(F.lit(WINDOW), length)
    best = F.array_max(
        F.transform(
            F.sequence(F.lit(1), length - window + 1),
            lambda at: F.aggregate(F.slice("equal", at, window), F.lit(0), lambda a, b: a + b),
        )
    )
    return (
        computed_once(pairs, {"equal": equal})
        .withColumn("best_window", best)
        .filter(F.col("best_window") * 100 >= window * MIN_PERCENT)
        .groupBy("doc_id", "content", "item_id", "item_key")
        .agg(
            F.max("best_window").alias("best_window"),
            F.max(F.aggregate("equal", F.lit(0), lambda a, b: a + b)).alias("matched_tokens"),
            F.max(length).alias("item_length"),
        )
        .drop("item_key")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that hold a passage of the benchmark."""
    bad = materialize(contaminated(docs, benchmark).select("doc_id", "content").distinct())
    bad = small_or_shuffled(bad)
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (
        content_hash(text_of("row.text")) == F.col("content")
    )
    return packed(docs).join(bad, same, "left_anti").select("row.*")
