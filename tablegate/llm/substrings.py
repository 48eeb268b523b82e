"""Substring dedup by line or paragraph hashing.

Units are lines, or paragraphs between blank lines. Their words are lower-cased and single
spaced, digests are grouped over all documents, and each digest's occurrence of the lowest
rank, (doc_id, unit number), is kept. The rest is reported with offsets into the original
text, in code points.

Defined cases: a null text has no units; units of fewer than MIN_WORDS words are left alone;
a null doc_id ranks first; rows that repeat a doc_id have the same rank, so equal units at
the same place in them are no copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 5
SEPARATORS = {"line": re.compile("\n"), "paragraph": re.compile(r"\n[ \t\r]*\n\s*")}


def units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, unit_no, begin, end, n_words, high, low) of every unit with enough words."""
    separator = SEPARATORS[unit]

    def cut(text: str) -> Iterator[tuple]:
        begin, number = 0, 0
        for match in [*separator.finditer(text), None]:
            end = match.start() if match else len(text)
            words = text[begin:end].encode("utf-8", "surrogatepass").lower().split()
            if len(words) >= min_words:
                digest = xxhash.xxh3_128_intdigest(b" ".join(words))
                yield (number, begin, end, len(words), (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63))
            begin, number = match.end() if match else end, number + 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["unit_no", "begin", "end", "n_words", "high", "low"]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, found = [], []
                for doc, text in zip(part.column("doc_id"), part.column("text")):
                    value = text.as_py()
                    if value is not None:
                        cuts = list(cut(value))
                        found += cuts
                        ids += [doc.as_py()] * len(cuts)
                columns = list(zip(*found)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, part.column("doc_id").type)] + [pa.array(c, pa.int64()) for c in columns],
                    names=["doc_id", *names],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, unit_no long, begin long, end long, n_words long, high long, low long"
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def repeated_spans(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, unit_no, begin, end, n_words, first_doc_id, first_unit_no) to remove.

    A digest with very many copies is reduced by partial aggregation; only its row of the
    first occurrence meets the copies again, in a join that splits hot keys.
    """
    every = units(docs, unit, min_words)
    rank = F.struct("doc_id", "unit_no")
    firsts = (
        every.groupBy("high", "low")
        .agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
        .filter("first < last")
    )
    return (
        every.join(firsts.select("high", "low", "first"), ["high", "low"])
        .filter(rank > F.col("first"))
        .select(
            "doc_id", "unit_no", "begin", "end", "n_words",
            F.col("first.doc_id").alias("first_doc_id"),
            F.col("first.unit_no").alias("first_unit_no"),
        )
    )
