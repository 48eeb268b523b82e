"""Quality rules: per-document counts, and lines that too many documents of a host share.

Defined cases: a null text is the empty text; a null host is a host of its own;
rows that repeat a text count as one document of their host and get equal results; an
empty table gives an empty result. The input's columns travel inside one struct
column ``row``, so that further columns are kept and no name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.llm.common import (
    compiled_pieces,
    packed,
    small_or_shuffled,
    text_of,
    with_text,
    words_of,
)
from tablegate.operators.once import computed_once
from tablegate.session import materialize

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A line is removed when more documents of its host have it.
MAX_DOCUMENTS = 20
# A document is depleted when less than this share of its words is left.
MIN_WORDS_LEFT_PERCENT = 50


def _line_hashes(text: Column) -> Column:
    """Hash of each line, lower-cased and without the white space around it."""
    return F.transform(
        F.split(F.lower(text), "\n"), lambda line: F.xxhash64(F.btrim(line, F.lit(" \t\x0b\x0c\r")))
    )


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _with_word(lines: Column) -> Column:
    return F.filter(lines, lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def _contents(text: Column) -> list[Column]:
    """Two hashes that name a text."""
    return [F.xxhash64(text).alias("content"), F.xxhash64(F.lit(1), text).alias("content2")]


def _document_lines(docs: DataFrame, host: str) -> DataFrame:
    """(host, content, content2, line): the distinct lines of each document, by hash."""
    text = text_of()
    lines = F.explode(F.array_distinct(_line_hashes(text))).alias("line")
    rows = docs.select(F.col(host).alias("host"), *_contents(text), lines)
    return rows.filter(F.col("line") != F.xxhash64(F.lit("")))


def line_limits(docs: DataFrame, host: str = "source", max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """(host, line): the lines that more documents of their host have than the limit.

    The limit is a number, so a host of any size loses its boilerplate. Exact copies of a
    text are one document: a page that was fetched often is no boilerplate.
    """
    lines = _document_lines(docs, host).distinct()
    counted = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("documents"))
    return counted.filter(F.col("documents") > max_documents).select("host", "line")


def without_frequent_lines(
    docs: DataFrame, host: str = "source", max_documents: int = MAX_DOCUMENTS
) -> DataFrame:
    """(row, clean_text, lines_removed): the texts without the lines over the limit.

    The frequent (host, line) rows meet the documents' lines, and what a text loses meets its
    documents. Both are broadcast while their measured size allows it, so that texts are
    shuffled only beyond that, in a join that splits hot texts.
    """
    frequent = materialize(line_limits(docs, host, max_documents)).select(
        F.col("host").alias("frequent_host"), F.col("line").alias("frequent_line")
    )
    lines = _document_lines(docs, host)
    hit = F.col("host").eqNullSafe(F.col("frequent_host")) & (F.col("line") == F.col("frequent_line"))
    hits = lines.join(small_or_shuffled(frequent), hit).groupBy(
        F.col("host").alias("lost_host"), F.col("content").alias("lost"), F.col("content2").alias("lost2")
    )
    # At most the distinct lines of one text; copies of it add none.
    lost = materialize(hits.agg(F.collect_set("line").alias("frequent_lines")))
    text = text_of("row.text")
    names = packed(docs).select("row", *_contents(text))
    own = (
        F.col(f"row.{host}").eqNullSafe(F.col("lost_host"))
        & (F.col("content") == F.col("lost"))
        & (F.col("content2") == F.col("lost2"))
    )
    joined = names.join(small_or_shuffled(lost), own, "left").select("row", "frequent_lines")
    lines = _lines(text)
    stay = F.filter(
        F.arrays_zip(lines.alias("line"), _line_hashes(text).alias("hash")),
        lambda x: ~F.array_contains(F.col("frequent_lines"), x["hash"]),
    )
    kept = F.when(F.col("frequent_lines").isNull(), lines).otherwise(
        F.transform(stay, lambda x: x["line"])
    )
    return joined.withColumn("kept_lines", kept).select(
        "row",
        F.array_join("kept_lines", "\n").alias("clean_text"),
        (F.size(lines) - F.size("kept_lines")).cast("long").alias("lines_removed"),
    )


def base_counts(rows: DataFrame) -> DataFrame:
    """Adds to rows with a ``row`` n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Repeated 3-word windows meet by sorting a document's windows, so a very long text
    costs n log n.
    """
    text = text_of("row.text")
    lines = F.col("word_lines")
    n = F.size("words")
    shifted = F.arrays_zip(
        F.col("words").alias("a"),
        F.slice("words", 2, n).alias("b"),
        F.slice("words", 3, n).alias("c"),
        F.sequence(F.lit(0), n - 1).alias("at"),
    )
    windows = F.sort_array(F.slice(shifted, 1, n - 2))
    pairs = F.zip_with(
        "windows",
        F.slice("windows", 2, n),
        lambda x, y: F.when(
            x["a"] == y["a"],
            F.when((x["b"] == y["b"]) & (x["c"] == y["c"]), F.array(x["at"], y["at"])),
        ),
    )
    starts = F.array_distinct(F.flatten(F.filter(pairs, lambda pair: pair.isNotNull())))
    covered = F.array_distinct(
        F.flatten(F.transform(starts, lambda at: F.array(at, at + 1, at + 2)))
    )
    return (
        rows.withColumn("words", words_of(text))
        .withColumn("word_lines", _with_word(_lines(text)))
        .withColumn("n_words", n.cast("long"))
        .withColumn("word_chars", F.char_length(F.array_join("words", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long"))
        .withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
        .withColumn("windows", F.when(n >= 3, windows))
        .withColumn(
            "n_repeat_words", F.when(n >= 3, F.size(covered)).otherwise(F.lit(0)).cast("long")
        )
        .drop("words", "word_lines", "windows")
    )


def quality(docs: DataFrame, host: str = "source") -> DataFrame:
    """(row, clean_text, ...): base counts, ``base_failed`` and the verdict ``kept``."""
    compiled_pieces(docs.sparkSession)
    n, left = F.col("n_words"), F.col("words_left")
    return (
        base_counts(without_frequent_lines(docs, host))
        .withColumn(
            "words_left",
            F.when(F.col("lines_removed") == 0, n).otherwise(F.size(words_of(F.col("clean_text")))),
        )
        .withColumn(
            "base_failed",
            (n < MIN_WORDS) | (F.col("n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT),
        )
        .withColumn(
            "kept", ~F.col("base_failed") & (left * 100 >= n * MIN_WORDS_LEFT_PERCENT)
        )
    )


def passing(docs: DataFrame, host: str = "source") -> DataFrame:
    """The kept documents, without the lines over the limits."""
    # The filter must not pass the counts, or they would be computed for each mention of them.
    judged = computed_once(quality(docs, host), {"stays": F.col("kept")}).filter("stays")
    changed = with_text(docs, F.col("row"), F.col("clean_text"))
    row = F.when(F.col("lines_removed") == 0, F.col("row")).otherwise(changed)
    return judged.select(row.alias("row")).select("row.*")
