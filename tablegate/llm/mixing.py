"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells of (source, language, topic). The cells' token weights are
raked to the target share of each class in turn until all marginals fit; a document is then
drawn with the probability of its cell.

Defined cases: a null class is a class of its own; a null text has no tokens; a document
without tokens is drawn like the others of its cell, with probability 0 if the whole cell
has none; rows that repeat a (doc_id, text) share their draw; an empty table gives an empty
result; the input's columns travel in one struct, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.llm.common import content_hash, packed, small_or_shuffled, text_of, words_of
from tablegate.session import BROADCAST_LIMIT_BYTES, materialize, measured

TOLERANCE = 1e-5
MAX_SWEEPS = 50
SEED = 8
# Targets flatten the natural shares: a class gets a share in proportion to share ** POWER.
POWER = 0.8


def form_topic(text: Column, n_words: Column) -> Column:
    """A stand-in topic by the form of a text, for tables that have no topic column."""
    symbols = F.regexp_count(text, F.lit("[#*$%&|<>0-9]"))
    lines = F.size(F.split(text, "\n"))
    return (
        F.when(symbols * 20 > F.char_length(text), "tables")
        .when(n_words < lines * 12, "lists")
        .when(n_words < 200, "notes")
        .otherwise("prose")
    )


def class_key(value: Column) -> Column:
    """A class as text that is never null: the null class differs from every other."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def natural_targets(cells: DataFrame, dims: Sequence[str], power: float = POWER) -> dict[str, DataFrame]:
    """For each dimension (class, share), shares proportional to natural share ** power."""
    targets = {}
    for dim in dims:
        parts = materialize(
            cells.groupBy(dim).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("part"))
        )
        total = parts.agg(F.sum("part")).first()[0] or 1.0
        targets[dim] = parts.select(dim, (F.col("part") / F.lit(total)).alias("share"))
    return targets


def rake(
    cells: DataFrame,
    targets: Mapping[str, DataFrame],
    tolerance: float = TOLERANCE,
    max_sweeps: int = MAX_SWEEPS,
) -> DataFrame:
    """The cells with ``weight``: shares of the whole whose marginals are the targets.

    Classes are keys as :func:`class_key` gives them. A class without a target keeps its
    weight in that step; a class without tokens cannot reach its target. Each step is a
    partial aggregation by class and a join with the class factors; a sweep over all
    dimensions is one job. A cell table of a measured small size is kept in one partition,
    so that the steps need no exchange.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return cells.withColumn("weight", F.lit(0.0))
    state = cells.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    if measured(cells)[1] <= BROADCAST_LIMIT_BYTES:
        state = state.coalesce(1)
        targets = {dim: target.coalesce(1) for dim, target in targets.items()}
    state = materialize(state.withColumn("off", F.lit(0.0)))
    for _ in range(max_sweeps):
        state = state.withColumn("off", F.lit(0.0))
        for dim, target in targets.items():
            sums = state.groupBy(dim).agg(F.sum("weight").alias("now"))
            factors = sums.join(target, dim).select(dim, F.try_divide("share", "now").alias("factor"))
            factor = F.coalesce("factor", F.lit(1.0))
            state = state.join(factors, dim, "left").select(
                *cells.columns,
                (F.col("weight") * factor).alias("weight"),
                F.greatest("off", F.abs(factor - 1)).alias("off"),
            )
        state = materialize(state)
        if (state.agg(F.max("off")).first()[0] or 0.0) < tolerance:
            break
    return state.drop("off")


def calibrated(
    docs: DataFrame,
    dims: Mapping[str, Column] | None = None,
    power: float = POWER,
    seed: int = SEED,
) -> DataFrame:
    """(row, n_tokens, the dimensions, rate, probability, sampled) for every row.

    ``dims`` maps dimension names to expressions over ``row`` and ``n_tokens``; by default
    source, language and the form of the text. ``rate`` is a cell's target share over its
    natural share, ``probability`` the rate over the greatest one: so the expected sample has
    the target marginals exactly.
    """
    text = text_of("row.text")
    dims = dims or {
        "source": F.col("row.source"),
        "lang": F.col("row.lang"),
        "topic": form_topic(text, F.col("n_tokens")),
    }
    names = list(dims)
    rows = packed(docs).withColumn("n_tokens", F.size(words_of(text)).cast("long"))
    rows = rows.select("row", "n_tokens", *[value.alias(name) for name, value in dims.items()])
    keys = [class_key(F.col(n)).alias(f"cell_{n}") for n in names]
    cells = materialize(rows.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")))
    cell_names = [f"cell_{n}" for n in names]
    raked = rake(cells, natural_targets(cells, cell_names, power))
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    rate = F.try_divide(F.col("weight") * F.lit(total), F.col("tokens"))
    rates = materialize(raked.select(*cell_names, F.coalesce(rate, F.lit(0.0)).alias("rate")))
    greatest = F.lit(float(rates.agg(F.max("rate")).first()[0] or 0.0) or 1.0)
    same = F.lit(True)
    for name in names:
        same = same & (class_key(F.col(name)) == F.col(f"cell_{name}"))
    draw = F.shiftrightunsigned(
        F.xxhash64(F.lit(seed), F.col("row.doc_id"), content_hash(text)), 11
    ) / F.lit(float(1 << 53))
    return (
        rows.join(small_or_shuffled(rates), same)
        .withColumn("probability", F.col("rate") / greatest)
        .withColumn("sampled", draw < F.col("probability"))
        .drop(*cell_names)
    )


def sampled(docs: DataFrame) -> DataFrame:
    """The drawn documents."""
    return calibrated(docs).filter("sampled").select("row.*")
