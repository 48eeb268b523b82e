"""Substring dedup by paragraph hashing: long passages that repeat, wherever they stand.

Words are lower-cased (A-Z) and single spaced. A unit is a paragraph of MIN_WORDS words that
begins where a line or a sentence does; it may run on over line breaks, so it does not matter
how a passage is broken into lines or what follows it in its line. Digests of all units are
grouped over all documents, and a digest's occurrence of the lowest rank, (doc_id, word
number), is kept. The other ones that overlap or touch in a document are joined to one span
and reported with offsets into the original text, in code points.

So every passage of MIN_WORDS words or more is found that begins with a sentence or a line
and stands word by word in another document; shorter repeats are left alone.

Defined cases: a null text has no units, nor has one of fewer than MIN_WORDS words; a null
doc_id ranks first; rows that repeat doc_id and text are one document, and rows that repeat a
doc_id with another text have the same rank, so units at the same place in them are no copies
of each other; a very long text has as many units as sentences; an empty table gives an empty
result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.common import content_hash, settled, small_or_shuffled
from tablegate.session import materialize

MIN_WORDS = 50
# Digests with more occurrences are joined by broadcast: at most one in so many rows.
HOT = 10_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ENDS = (".", "!", "?")


def paragraphs(text: str, min_words: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(word number, begin, end, words single spaced) of every unit of a text."""
    found = list(_WORD.finditer(text))
    if len(found) < min_words:
        return
    words = [match.group().encode("utf-8", "surrogatepass").lower() for match in found]
    joined, offsets, at = b" ".join(words), [], 0
    for word in words:
        offsets.append(at)
        at += len(word) + 1
    offsets.append(at)
    for number in range(len(found) - min_words + 1):
        match = found[number]
        before = found[number - 1] if number else None
        if before is None or before.group().endswith(_ENDS) or "\n" in text[before.end() : match.start()]:
            last = number + min_words
            yield number, match.start(), found[last - 1].end(), joined[offsets[number] : offsets[last] - 1]


def units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, content, word, begin, end, high, low) of every unit."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                places, found = [], []
                for row, text in enumerate(part.column("text").to_pylist()):
                    if text is None:
                        continue
                    for number, begin, end, words in paragraphs(text, min_words):
                        digest = xxhash.xxh3_128_intdigest(words)
                        places.append(row)
                        found.append((number, begin, end, (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)))
                columns = list(zip(*found)) or [[]] * 5
                index = pa.array(places, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(index), part.column("content").take(index)]
                    + [pa.array(c, pa.int64()) for c in columns],
                    names=["doc_id", "content", "word", "begin", "end", "high", "low"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, content long, word long, begin long, end long, high long, low long"
    return docs.select("doc_id", content_hash(F.col("text")).alias("content"), "text").mapInArrow(rows, schema)


def with_firsts(every: DataFrame, firsts: DataFrame, key: list[str], hot: int = HOT) -> DataFrame:
    """The units whose digest is in ``firsts``, with its first occurrence.

    The digests of more than ``hot`` occurrences are joined apart; they are few by their
    number and broadcast while their measured size allows it. No other digest can make a
    task of the join large.
    """
    often = materialize(firsts.filter(F.col("n") > hot).select(*key, "first"))
    marked = every.join(small_or_shuffled(often), key, "left")
    named = firsts.filter(F.col("n") <= hot).select(*key, F.col("first").alias("found"))
    cold = marked.filter(F.col("first").isNull()).join(named, key)
    cold = cold.withColumn("first", F.col("found")).drop("found")
    return marked.filter(F.col("first").isNotNull()).unionByName(cold)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, begin, end, n_words, first_doc_id): the spans to remove.

    ``first_doc_id`` holds the earliest occurrence of the span's first unit. A digest with
    very many copies is reduced by partial aggregation; its row of the first occurrence is
    broadcast to the copies, and the others meet theirs in a join (:func:`with_firsts`).
    """
    every = units(docs, min_words)
    rank = F.struct("doc_id", "word")
    firsts = settled(
        every.groupBy("high", "low")
        .agg(F.min(rank).alias("first"), F.max(rank).alias("last"), F.count(F.lit(1)).alias("n"))
        .filter("first < last")
        .select("high", "low", "first", "n")
    )
    key = ["high", "low"]
    copies = with_firsts(every, firsts, key)
    later = copies.filter(rank > F.col("first")).dropDuplicates(["doc_id", "content", "word"])
    in_order = Window.partitionBy("doc_id", "content").orderBy("word")
    reached = F.max(F.col("word") + min_words).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce((F.col("word") > reached).cast("int"), F.lit(1))
    spans = later.withColumn("begins", begins).withColumn("span", F.sum("begins").over(in_order))
    return spans.groupBy("doc_id", "content", "span").agg(
        F.min("begin").alias("begin"),
        F.max("end").alias("end"),
        (F.max("word") + min_words - F.min("word")).alias("n_words"),
        F.min_by("first.doc_id", "word").alias("first_doc_id"),
    ).select("doc_id", "begin", "end", "n_words", "first_doc_id")
