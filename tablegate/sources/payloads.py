"""Raw JSON payloads: reading, triage of responses, and flattening.

A payload is one JSON document per unit. Its ``hourly`` object holds parallel
arrays, which become one row per index. Values stay variants until the contract
has looked at them, so a wrong type is seen and not silently turned to null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators.joins import anti_join, semi_join
from tablegate.operators.once import computed_once
from tablegate.session import materialize


def read_payloads(
    spark: SparkSession,
    path: str,
    unit_schema: T.StructType | None = None,
    text: str = "payload",
    delivered: str | None = None,
) -> DataFrame:
    """One row per JSON file below ``path``; unit keys come from ``key=value`` folders.

    ``delivered`` names a column for the time at which the file was written.
    """
    reader = spark.read
    if unit_schema is not None:
        reader = reader.schema(T.StructType([T.StructField("value", T.StringType()), *unit_schema]))
    files = reader.text(path, wholetext=True)
    if delivered is not None:
        files = files.select("*", F.col("_metadata.file_modification_time").alias(delivered))
    return files.withColumnRenamed("value", text)


def latest_documents(
    payloads: DataFrame, unit: Sequence[str], order_by: Sequence[str] = (), text: str = "payload"
) -> DataFrame:
    """One whole document of each unit: the last by ``order_by``, of equal ones the greatest.

    Units are counted by their keys alone. Only documents of units with several are
    shuffled, and each map task sends at most one of a unit; with none there is no shuffle.
    """
    counts = payloads.groupBy(*unit).agg(F.count(F.lit(1)).alias("_documents"))
    repeated = materialize(counts.filter(F.col("_documents") > 1).select(*unit))
    if repeated.isEmpty():
        return payloads
    several = semi_join(payloads, repeated, unit)
    order = F.struct(*order_by, F.coalesce(text, F.lit("")))
    last = several.groupBy(*[F.col(c).alias(f"_unit_{i}") for i, c in enumerate(unit)]).agg(
        F.max_by(F.struct("*"), order).alias("_last")
    )
    return anti_join(payloads, repeated, unit).unionByName(last.select("_last.*"))


def classify_responses(df: DataFrame, status: str = "status", body: str = "body") -> DataFrame:
    """Add ``outcome`` (ok, transient, permanent) and ``problem`` per response.

    A null status is a call that got no answer. A success without JSON may succeed
    when asked again, so it is transient like rate limits and server errors.
    """
    code = F.col(status)
    problem = (
        F.when(code.isNull(), "transport failure")
        .when(code == 429, "rate limited")
        .when(code >= 400, F.concat(F.lit("returned "), code.cast("string")))
        .when(F.try_parse_json(F.col(body)).isNull(), "non-JSON body")
    )
    rejected = code.between(400, 499) & (code != 429)
    outcome = (
        F.when(F.col("problem").isNull(), "ok").when(rejected, "permanent").otherwise("transient")
    )
    return computed_once(df, {"problem": problem}).withColumn("outcome", outcome)


def _series(document: Column, name: str) -> Column:
    """Array of variants; null when absent, null or not an array."""
    return F.try_variant_get(document, f"$['hourly']['{name}']", "array<variant>")


def with_series(
    payloads: DataFrame,
    series: Mapping[str, str],
    entity: str,
    text: str = "payload",
    time: str = "time",
) -> DataFrame:
    """Parse payloads once: ``_document``, the arrays, and ``_problem``.

    ``series`` maps a target column to its source array. ``_problem`` tells why
    a unit cannot be flattened: malformed JSON, no rows, or a ragged series (the
    first one in mapping order). Series are matched to the times by position alone,
    so one of another length cannot be placed.
    """
    parsed = computed_once(payloads, {"_document": F.try_parse_json(F.col(text))})
    document = F.col("_document")
    arrays = {f"_series_{target}": _series(document, source) for target, source in series.items()}
    parsed = computed_once(parsed, {"_time": _series(document, time), **arrays})
    points = F.size("_time")
    problem = F.when(document.isNull(), "payload is not JSON").when(
        F.col("_time").isNull() | (points == 0), "producer returned no rows"
    )
    for target, source in series.items():
        values = F.col(f"_series_{target}")
        raw = F.variant_get(document, f"$['hourly']['{source}']", "variant")
        named = F.concat(F.col(entity).cast("string"), F.lit(f": series '{source}' "))
        problem = problem.when(
            values.isNull() & raw.isNotNull() & ~F.is_variant_null(raw),
            F.concat(named, F.lit("is not an array")),
        ).when(
            F.size(values) != points,
            F.concat(
                named,
                F.format_string("holds %d values for %d times", F.size(values), points),
            ),
        )
    return computed_once(parsed, {"_problem": problem})


def refused_units(parsed: DataFrame, unit: Sequence[str]) -> DataFrame:
    """Units that cannot be flattened, with ``problem``."""
    return parsed.filter(F.col("_problem").isNotNull()).select(
        *unit, F.col("_problem").alias("problem")
    )


def flatten_series(
    parsed: DataFrame,
    series: Mapping[str, str],
    keep: Sequence[str],
    time: str = "observed_at_utc",
    defaults: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per index of the arrays of :func:`with_series`.

    ``keep`` names the columns carried to every row. ``defaults`` maps a field
    of the document to the column used when the field is absent; an explicit
    null in the document stays null and is left for the contract to refuse.
    """
    points = F.size("_time")
    nothing = F.array_repeat(F.lit(None).cast("variant"), points)
    arrays = [F.col("_time").alias(time)] + [
        F.coalesce(F.col(f"_series_{target}"), nothing).alias(target) for target in series
    ]
    overrides = [
        F.coalesce(
            F.variant_get(F.col("_document"), f"$['{field}']", "variant"),
            F.col(column).cast("variant"),
        ).alias(field)
        for field, column in (defaults or {}).items()
    ]
    return parsed.filter(F.col("_problem").isNull()).select(
        *keep, *overrides, F.inline(F.arrays_zip(*arrays))
    )


def unknown_names(series: Mapping[str, str], time: str = "time") -> Column:
    """Sorted names under ``hourly`` that no target column is read from."""
    known = [time, *series.values()]
    hourly = F.try_variant_get(F.col("_document"), "$['hourly']", "map<string,variant>")
    return F.array_sort(F.array_except(F.map_keys(hourly), F.array(*map(F.lit, known))))


def unknown_series(
    parsed: DataFrame, series: Mapping[str, str], unit: Sequence[str]
) -> DataFrame:
    """Units whose payload has series nobody asked for, one row per name.

    Looked up in the raw payload: flattening reads known series only, so later
    steps could not see a new one.
    """
    return parsed.select(*unit, F.explode(unknown_names(series)).alias("field"))
