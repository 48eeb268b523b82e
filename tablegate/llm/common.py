"""Pieces that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.session import BROADCAST_LIMIT_BYTES, materialize, measured

# White space that separates words: space and the ASCII controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
# Bytes of texts that a Python worker gets in one batch, and splits at a time.
BATCH_BYTES = 1 << 22
BYTES_AT_ONCE = 1 << 20


def text_of(column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text that is not null."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def pieces(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Some texts at a time, and the place of the first of them."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    edges = np.flatnonzero(np.diff(ends // BYTES_AT_ONCE)) + 1 if len(ends) else []
    for a, b in zip([0, *edges], [*edges, len(texts)]):
        yield a, texts.slice(a, b - a)


def split_texts(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(the words, A-Z lower-cased, and how many each text has) of some texts at a time."""
    for _, some in pieces(texts):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(some, "")))
        words, offsets = lists.flatten().cast(pa.binary()), lists.offsets.to_numpy()
        # White space at the ends of a text leaves empty words.
        real = pc.binary_length(words).to_numpy() > 0
        before = np.concatenate([[0], np.cumsum(real)])
        yield words.filter(pa.array(real)), np.diff(before[offsets - offsets[0]])


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers some megabytes at a time, however long their texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def compiled_pieces(spark: SparkSession) -> None:
    """Many array expressions in one stage make a method that the JVM never compiles.

    Beyond 8,000 bytes of code Spark is told to make a method of each expression instead.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, every job drops its shuffle files when it ends.

    For passes whose results are checkpointed or collected. Otherwise the files stay until
    the driver collects its garbage, and those of several passes lie on the disks together.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def settled(df: DataFrame) -> DataFrame:
    """The frame materialised, and the shuffle files behind it dropped."""
    with short_lived_shuffles(df.sparkSession):
        return materialize(df)


def small_or_shuffled(small: DataFrame) -> DataFrame:
    """Marks a materialised frame for broadcast when its measured size allows it.

    Beyond the limit the join is left to the optimizer, which shuffles both sides
    and splits hot keys.
    """
    _, size = measured(small)
    return F.broadcast(small) if size <= BROADCAST_LIMIT_BYTES else small


def packed(docs: DataFrame) -> DataFrame:
    """One struct column ``row`` of all columns: no later name can clash with them."""
    return docs.select(F.struct("*").alias("row"))


def with_text(docs: DataFrame, row: Column, text: Column) -> Column:
    """The row with another text, and with its length where the frame has n_chars."""
    changed = row.withField("text", text)
    if "n_chars" in docs.columns:
        length = F.char_length(text).cast(docs.schema["n_chars"].dataType)
        changed = changed.withField("n_chars", length)
    return changed


def content_hash(text: Column) -> Column:
    """Tells rows that repeat a doc_id with another text apart."""
    return F.xxhash64(text)
