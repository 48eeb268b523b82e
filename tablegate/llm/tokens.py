"""Token counts by a map-side lookup in two tiers.

Pre-tokens are the pieces that the tokenizer's merges never cross: a run of spaces with the
word after it, cut at line ends. A broadcast table holds the lengths of the frequent ones;
the others are encoded in batches and kept in a bounded cache of the task. No pre-token is
shuffled: the count of a text is the sum over its pieces.

The frequent table is learned from a bounded sample of SAMPLE_DOCS documents; it changes
the speed, never a count. Defined cases: a null or empty text has no tokens; repeated rows
are counted each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
SAMPLE_DOCS = 2000
FREQUENT = 1 << 16
CACHED = 1 << 19
LONGEST_CACHED = 64
# Characters encoded between two look-ups of what is missing.
CHARS_AT_ONCE = 1 << 20

SPACES = re.compile(r" +[^ ]*|[^ ]+")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(text: str) -> list[str]:
    """The pre-tokens of a text: words after one space bare, others with their spaces.

    A piece at the start of a later line carries the line end, which is a token of its own;
    the tokenizer puts one space before the text, and reads U+2581 as a space.
    """
    found: list[str] = []
    for number, line in enumerate(text.replace("▁", " ").split("\n")):
        words = (" " + line if not number else line).split(" ")
        if "" in words[1:]:
            parts = SPACES.findall(" " + line if not number else line)
            if number and (not parts or parts[0][0] == " "):
                found.append("\n")
            elif number:
                parts[0] = "\n" + parts[0]
            found.extend(p[1:] if p[0] == " " else p for p in parts)
        else:
            if number:
                found.append("\n" + words[0])
            found.extend(words[1:])
    return found


class Lengths:
    """Numbers of tokens of pre-tokens: the frequent table, a bounded cache, the encoder."""

    def __init__(self, encoder, frequent: dict[str, int]):
        self.encoder = encoder
        self.known = dict(frequent)
        self.room = CACHED

    def learn(self, missing: set[str]) -> dict[str, int]:
        """Lengths of pieces that are in no table; short ones are kept while there is room.

        The encoder puts a space before each piece. One that starts with a line end gets
        that space as a token of its own.
        """
        listed = list(missing)
        encoded = self.encoder.encode(listed, num_threads=1)
        lengths = {p: len(ids) - (p[:1] == "\n") for p, ids in zip(listed, encoded)}
        if "" in lengths:
            lengths[""] = 1
        for piece, n in lengths.items():
            if self.room and len(piece) <= LONGEST_CACHED:
                self.known[piece] = n
                self.room -= 1
        return lengths

    def of(self, texts: list[str]) -> list[int]:
        split = [pieces(t) if t else [] for t in texts]
        known = self.known
        missing = {p for found in split for p in found if p not in known}
        extra = self.learn(missing) if missing else {}
        table = known if missing <= known.keys() else known | extra
        return [sum(map(table.__getitem__, found)) for found in split]


def encoder(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def frequent_lengths(docs: DataFrame, path: str, sample_docs: int = SAMPLE_DOCS) -> dict[str, int]:
    """The most common pre-tokens of a bounded sample, with their lengths."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update(p for p in pieces(text.as_py() or "") if len(p) <= LONGEST_CACHED)
        top = seen.most_common(FREQUENT)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            names=["piece", "n"],
        )

    sample = docs.select("text").filter(F.col("text").isNotNull()).limit(sample_docs)
    counts = sample.mapInArrow(count, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.desc("n"), "piece").limit(FREQUENT).collect()
    lengths = Lengths(encoder(path), {})
    return lengths.learn({r["piece"] for r in rows}) if rows else {}


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    path = path or model_path()
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(encoder(path), frequent.value)
        for batch in batches:
            counts: list[int] = []
            held: list[str] = []
            chars = 0
            for text in batch.column("text"):
                value = text.as_py() or ""
                held.append(value)
                chars += len(value)
                if chars > CHARS_AT_ONCE:
                    counts += lengths.of(held)
                    held, chars = [], 0
            counts += lengths.of(held)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
