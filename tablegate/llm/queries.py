"""The registered queries of the corpus operators, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.llm import (
    decontaminate,
    language,
    lines,
    links,
    mixing,
    ngram,
    passages,
    periodic,
    phrases,
    pivots,
    quality,
    simhash,
    tokens,
    windows,
)
from tablegate.llm.common import text_of, words_of
from tablegate.operators.once import computed_once


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the benchmark items whose passages they hold."""
    docs, items = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    return decontaminate.contaminated(docs, items).select(
        "doc_id", "item_id", "best_window", "matched_tokens", "item_length"
    )


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its text after line dedup."""
    rows = lines.dedup_lines(_table(spark, folder, "documents"))
    return rows.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"),
        F.col("clean_text").alias("text"),
    )


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts of every document and whether the quality rules keep it."""
    return quality.quality(_table(spark, folder, "documents")).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "lines_removed",
    )


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every span of 50 words or more that repeats an earlier passage, with its offsets."""
    return passages.repeated_passages(_table(spark, folder, "documents"))


def op4_repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The same for passages that begin with any word, not with a line or a sentence only."""
    return windows.repeated_windows(_table(spark, folder, "documents"))


def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's probability under the trigram model."""
    return ngram.trained_and_scored(_table(spark, folder, "documents"), order=ngram.ORDER)


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return links.judged(_table(spark, folder, "pages"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's predicted language."""
    return language.predict(_table(spark, folder, "documents"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's sampling probability and whether it is drawn."""
    return mixing.calibrated(_table(spark, folder, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "n_tokens", "topic", "rate", "probability", "sampled"
    )


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint and component."""
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's number of tokens."""
    return tokens.token_counts(_table(spark, folder, "documents"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """Each language's first phrases by the score of their weakest cut."""
    return phrases.collocations(_table(spark, folder, "documents"))


def op12_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's number of links, its component, and whether it stays."""
    return pivots.near_duplicates(_table(spark, folder, "embeddings"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents, the words of every tenth (by its id's CRC-32) repeated from a place on."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = computed_once(
        docs.withColumn("code", code),
        {"words": F.when(F.col("code") % 10 == 0, words_of(text_of()))},
    )
    n, g = F.size("words"), F.floor(F.col("code") / 10)
    start = (g % n).cast("int")
    period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
    rows = computed_once(rows, {"n": n, "start": start, "period": period})
    place = F.expr(
        "transform(sequence(0, n - 1), "
        "i -> words[if(i < start, i, start + (i - start) % period)])"
    )
    text = F.when(F.col("n") > 0, F.array_join(place, " ")).otherwise(F.col("text"))
    return rows.withColumn("text", text).select("doc_id", "text")


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's runs of repeated words, as digests, and the one of greatest exponent."""
    rows = periodic.periodic_runs(with_planted_runs(_table(spark, folder, "documents")))
    best = F.expr(
        "array_sort(runs, (a, b) -> CASE "
        "WHEN a.length * b.period <> b.length * a.period "
        "THEN IF(a.length * b.period > b.length * a.period, -1, 1) "
        "WHEN a.start <> b.start THEN IF(a.start < b.start, -1, 1) "
        "WHEN a.period <> b.period THEN IF(a.period < b.period, -1, 1) ELSE 0 END)"
    )
    listed = F.array_join(
        F.transform(
            "runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n")))
        ),
        "",
    )
    first = F.get(best, F.lit(0))
    rows = computed_once(rows, {"best": F.when(F.size("runs") > 0, first)})
    return rows.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.coalesce("clean_text", F.lit("")), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality": op3_quality,
    "op4_substring_dedup": op4_substring_dedup,
    "op4_repeated_windows": op4_repeated_windows,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_url_filters": op6_url_filters,
    "op7_language": op7_language,
    "op8_mixing": op8_mixing,
    "op9_simhash": op9_simhash,
    "op10_token_counts": op10_token_counts,
    "op11_collocations": op11_collocations,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"'[^\x20\x09-\x0D]+'"

SQL: dict[str, str] = {
    "op2_line_dedup": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
        lines AS (
            SELECT r, doc_id, i - 1 AS n, split_text[i] AS line,
                   list_distinct(regexp_extract_all(
                       translate(split_text[i], {_UPPER}, {_LOWER}), {_WORD})) AS w
            FROM (SELECT r, doc_id, string_split(text, chr(10)) AS split_text FROM docs),
                 LATERAL (SELECT unnest(range(1, len(split_text) + 1)) AS i)),
        sets AS (SELECT list_sort(w) AS w, min((coalesce(doc_id, -9223372036854775808), n)) AS first
                 FROM lines WHERE len(w) > 0 GROUP BY ALL),
        named AS (SELECT row_number() OVER () AS s, * FROM sets),
        words AS (SELECT s, unnest(w) AS word FROM named),
        rare AS (SELECT word, count(*) AS f FROM words GROUP BY word),
        ranked AS (SELECT s, word, row_number() OVER (PARTITION BY s ORDER BY f, word) AS p
                   FROM words JOIN rare USING (word)),
        prefix AS (SELECT s, word FROM ranked JOIN named USING (s)
                   WHERE p <= len(w) - (4 * len(w) + 4) // 5 + 1),
        pairs AS (SELECT DISTINCT a.s AS x, b.s AS y FROM prefix a JOIN prefix b USING (word) WHERE a.s <> b.s),
        close_sets AS (
            SELECT DISTINCT x FROM pairs JOIN named a ON a.s = x JOIN named b ON b.s = y
            WHERE b.first < a.first AND 5 * len(list_intersect(a.w, b.w))
                  >= 4 * (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w)))),
        judged AS (
            SELECT r, n, line, coalesce(x IS NOT NULL
                   OR (coalesce(doc_id, -9223372036854775808), n) > first, false) AS gone
            FROM lines l LEFT JOIN named d ON len(l.w) > 0 AND list_sort(l.w) = d.w
            LEFT JOIN close_sets ON x = d.s)
        SELECT any_value(doc_id) AS doc_id, count(*) FILTER (WHERE gone) AS n_removed,
               coalesce(string_agg(CAST(n AS VARCHAR), ',' ORDER BY n) FILTER (WHERE gone), '') AS removed_lines,
               coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone),
                        CASE WHEN count(n) > 0 THEN '' END) AS text
        FROM docs LEFT JOIN judged USING (r) GROUP BY r
    """,
    "op3_quality": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
        parts AS (SELECT *, regexp_extract_all(text, {_WORD}) AS w, string_split(text, chr(10)) AS lines FROM docs),
        windows AS (SELECT r, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, i
                    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM parts WHERE len(w) >= 3)),
        again AS (SELECT r, unnest(list(i)) AS i FROM windows GROUP BY r, a, b, c HAVING count(*) > 1),
        covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY r),
        every AS (SELECT r, doc_id, source, text, unnest(lines) AS line FROM parts),
        normal AS (SELECT r, doc_id, source, text, line,
                          trim(lower(line), ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS norm FROM every),
        frequent AS (SELECT source, norm FROM normal WHERE norm <> '' GROUP BY source, norm
                     HAVING count(DISTINCT text) > 20),
        removed AS (SELECT r, count(*) AS n, sum(len(regexp_extract_all(line, {_WORD}))) AS words
                    FROM normal n JOIN frequent f ON n.source IS NOT DISTINCT FROM f.source AND n.norm = f.norm
                    GROUP BY r),
        counted AS (
            SELECT p.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
                   len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
                   len(list_filter(lines, lambda x: regexp_matches(x, {_WORD})))
                   - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, {_WORD})))) AS n_dup_lines,
                   coalesce(c.n, 0) AS n_repeat_words, coalesce(d.n, 0) AS lines_removed,
                   len(w) - coalesce(d.words, 0) AS words_left
            FROM parts p LEFT JOIN covered c USING (r) LEFT JOIN removed d USING (r))
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
               CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
               CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
               AND words_left * 100 >= n_words * 50 AS kept,
               CAST(lines_removed AS BIGINT) AS lines_removed
        FROM counted
    """,
    "op4_substring_dedup": f"""
        WITH docs AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
        named AS (SELECT row_number() OVER () AS r, * FROM docs),
        cut AS (SELECT r, doc_id, regexp_extract_all(text, {_WORD}) AS words,
                       regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+') AS parts FROM named),
        every AS (SELECT r, doc_id, words, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word, unnest(parts) AS part
                  FROM cut WHERE len(words) >= 50),
        placed AS (
            SELECT *, sum(length(part)) OVER o AS end_at, lag(word) OVER o AS before
            FROM every WINDOW o AS (PARTITION BY r ORDER BY i)),
        units AS (
            SELECT u.r, u.doc_id, u.i - 1 AS word, u.end_at - length(u.word) AS begin_at, e.end_at,
                   list_transform(u.words[u.i:u.i + 49], lambda x: translate(x, {_UPPER}, {_LOWER})) AS w
            FROM placed u JOIN placed e ON e.r = u.r AND e.i = u.i + 49
            WHERE u.before IS NULL OR regexp_matches(u.before, '[.!?]$')
               OR contains(u.part[:length(u.part) - length(u.word)], chr(10))),
        ranked AS (
            SELECT *, first_value(doc_id) OVER o AS first_doc_id, first_value(word) OVER o AS first_word
            FROM units WINDOW o AS (PARTITION BY w ORDER BY doc_id NULLS FIRST, word)),
        later AS (SELECT * FROM ranked WHERE doc_id IS DISTINCT FROM first_doc_id OR word <> first_word),
        marked AS (
            SELECT *, CASE WHEN word <= max(word + 50) OVER (PARTITION BY r ORDER BY word
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM later),
        spans AS (SELECT *, sum(opens) OVER (PARTITION BY r ORDER BY word) AS span FROM marked)
        SELECT any_value(doc_id) AS doc_id, CAST(min(begin_at) AS BIGINT) AS "begin", CAST(max(end_at) AS BIGINT) AS "end",
               CAST(max(word) + 50 - min(word) AS BIGINT) AS n_words, arg_min(first_doc_id, word) AS first_doc_id
        FROM spans GROUP BY r, span
    """,
    "op4_repeated_windows": f"""
        WITH docs AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
        named AS (SELECT row_number() OVER () AS r, * FROM docs),
        cut AS (SELECT r, doc_id, regexp_extract_all(text, {_WORD}) AS words,
                       regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+') AS parts FROM named),
        every AS (SELECT r, doc_id, words, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word, unnest(parts) AS part
                  FROM cut WHERE len(words) >= 50),
        placed AS (SELECT *, sum(length(part)) OVER (PARTITION BY r ORDER BY i) AS end_at FROM every),
        units AS (
            SELECT u.r, u.doc_id, u.i - 1 AS word, u.end_at - length(u.word) AS begin_at, e.end_at,
                   list_transform(u.words[u.i:u.i + 49], lambda x: translate(x, {_UPPER}, {_LOWER})) AS w
            FROM placed u JOIN placed e ON e.r = u.r AND e.i = u.i + 49),
        ranked AS (
            SELECT *, first_value(doc_id) OVER o AS first_doc_id, first_value(word) OVER o AS first_word
            FROM units WINDOW o AS (PARTITION BY w ORDER BY doc_id NULLS FIRST, word)),
        later AS (SELECT * FROM ranked WHERE doc_id IS DISTINCT FROM first_doc_id OR word <> first_word),
        marked AS (
            SELECT *, CASE WHEN word <= max(word + 50) OVER (PARTITION BY r ORDER BY word
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM later),
        spans AS (SELECT *, sum(opens) OVER (PARTITION BY r ORDER BY word) AS span FROM marked)
        SELECT any_value(doc_id) AS doc_id, CAST(min(begin_at) AS BIGINT) AS "begin", CAST(max(end_at) AS BIGINT) AS "end",
               CAST(max(word) + 50 - min(word) AS BIGINT) AS n_words, arg_min(first_doc_id, word) AS first_doc_id
        FROM spans GROUP BY r, span
    """,
    "op11_collocations": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
        places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                   FROM words, (VALUES (1), (2), (3)) sizes(k) WHERE len(w) >= k),
        counted AS (SELECT lang, k, w[i:i + k - 1] AS p, CAST(count(*) AS HUGEINT) AS a FROM places GROUP BY ALL),
        totals AS (SELECT lang, sum(a) AS n FROM counted WHERE k = 1 GROUP BY lang),
        found AS (SELECT * FROM counted WHERE k > 1 AND a >= 10),
        cuts AS (SELECT f.lang, f.k, f.p, f.a, c, x.a AS l, y.a AS r, 1000000 * f.a * f.a // (x.a * y.a) AS score
                 FROM (SELECT *, unnest(range(1, k)) AS c FROM found) f
                 JOIN counted x ON x.lang = f.lang AND x.p = f.p[1:c]
                 JOIN counted y ON y.lang = f.lang AND y.p = f.p[c + 1:f.k]),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
        inside AS (SELECT lang, q, max(a) AS longer
                   FROM (SELECT lang, a, unnest([p[1:2], p[2:3]]) AS q FROM found WHERE k = 3) GROUP BY ALL),
        ranked AS (
            SELECT w.*, array_to_string(w.p, ' ') AS phrase, row_number() OVER (
                       PARTITION BY w.lang ORDER BY score DESC, a DESC, array_to_string(w.p, ' ')) AS place
            FROM lowest w LEFT JOIN inside i ON i.lang = w.lang AND i.q = w.p
            WHERE longer IS NULL OR 100 * longer < 50 * a)
        SELECT lang, place AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
               CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN totals USING (lang) WHERE place <= 2000
    """,
    "op12_embedding_dedup": """
        WITH RECURSIVE every AS (
            SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        good AS (SELECT * FROM every WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
                 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                 AND len(list_filter(v, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.r AS x, b.r AS y FROM good a JOIN good b ON a.label = b.label AND a.r <> b.r
            WHERE len(a.v) = len(b.v)
              AND list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98),
        reached AS (SELECT r AS x, r AS y FROM every UNION
                    SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x),
        parts AS (SELECT x, min(vec_id) AS component_id FROM reached JOIN every ON y = r GROUP BY x),
        counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
        FROM every JOIN parts ON parts.x = r LEFT JOIN counted ON counted.x = r
    """,
}
