"""Upsert on plain Parquet.

Parquet has no row-level operations, so a merge rewrites the partitions it
changes and no others. They are replaced all or none (``sources.publish``): a
merge that is cut off before its manifest is in place changed nothing, and one
that is cut off later is finished by the next writer and read whole before that.
One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators.checks import check_unique_combination
from tablegate.operators.dedupe import dedupe_latest
from tablegate.operators.joins import semi_join
from tablegate.session import materialize, staged
from tablegate.sources.publish import read_table, record_schema, recover, replace_partitions

# So many partitions are named one by one in a filter.
_LISTED_PARTITIONS = 1000


def merge_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], guard: str | None = None
) -> DataFrame:
    """The merged table with ``_action``: insert, update, unchanged or keep.

    A matched row takes the source's values when ``guard`` differs, or always
    without a guard. A null guard on either side is no difference. Columns new
    in the source are appended and null in old rows. ``source`` has one row per
    key; the target may break that rule, all copies are then updated.

    Written as a left join plus an anti join, not a full outer join: with a small
    source neither side of the target is shuffled, and AQE can split hot keys.
    """
    keys = list(keys)
    columns = target.columns + [c for c in source.columns if c not in target.columns]
    types = {f.name: f.dataType for f in [*source.schema, *target.schema]}
    # Aliases instead of new names: both joins of the source then read it by one shuffle.
    def old(c: str):
        return F.col(f"__old.`{c}`")

    def new(c: str):
        return F.col(f"__new.`{c}`")

    on = reduce(and_, [old(k) == new(k) for k in keys])
    hit = new(keys[0]).isNotNull()
    if guard is None:
        changed = hit
    else:
        changed = hit & F.coalesce(old(guard) != new(guard), F.lit(False))

    def merged(c: str):
        before = old(c) if c in target.columns else F.lit(None).cast(types[c])
        if c not in source.columns or c in keys:
            return before.alias(c)
        return F.when(changed, new(c).cast(types[c])).otherwise(before).alias(c)

    action = F.when(~hit, "keep").when(changed, "update").otherwise("unchanged")
    present = target.alias("__old").join(source.alias("__new"), on, "left").select(
        *[merged(c) for c in columns], action.alias("_action")
    )

    # Null keys match nothing. Set apart, they leave the other rows as the join above reads them.
    keyless = reduce(or_, [F.col(k).isNull() for k in keys])
    known = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    unmatched = source.filter(~keyless).join(known, keys, "left_anti")
    absent = unmatched.unionByName(source.filter(keyless)).select(
        *[
            (F.col(c) if c in source.columns else F.lit(None)).cast(types[c]).alias(c)
            for c in columns
        ],
        F.lit("insert").alias("_action"),
    )
    return present.unionByName(absent)


def _nothing(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A table without rows that Spark knows to be empty while planning: its joins fall away."""
    return spark.range(0).limit(0).select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


_COUNTS = {"inserted": "insert", "updated": "update", "unchanged": "unchanged", "kept": "keep"}


def _action_counts() -> list:
    return [
        F.count_if(F.col("_action") == action).alias(f"rows_{name}")
        for name, action in _COUNTS.items()
    ]


def merge_counts(merged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Inserted, updated, unchanged and kept rows, overall or per group.

    Only keys, guard and ``by`` are read, the other columns are pruned.
    """
    return merged.groupBy(*by).agg(*_action_counts())


def upsert(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition: str,
    guard: str | None = None,
    latest_by: Sequence[str] | None = None,
    count_by: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Merge ``source`` into the table at ``path``; returns the counts.

    ``partition`` must be a function of the key (a day of a key timestamp), so a
    row never changes partition. If a key occurs more than once in the source (its
    keys are counted, which moves keys only), the latest by ``latest_by`` is kept, and
    without an order the merge is refused. The first pass reads keys and guard of
    the touched partitions and decides; when nothing changed there is no second
    pass and nothing is written. ``source`` should be cheap to read twice, such
    as a landed table.
    """
    repeated = not check_unique_combination(source, keys).isEmpty()
    if repeated and latest_by is None:
        raise ValueError(f"the source of a merge repeats keys ({', '.join(keys)}): name an order")
    if repeated:
        with staged(dedupe_latest(source, keys, latest_by), "merge-source") as latest:
            return upsert(
                spark, path, latest, keys, partition, guard, count_by=count_by, schema=schema
            )
    group = [*count_by, *([] if partition in count_by else [partition])]

    recover(spark, path)
    target = read_table(spark, path, schema)
    if target is None:
        target = _nothing(spark, schema or source.schema)
    touched = named_partitions(source.select(partition).distinct(), partition)
    if touched is None:
        return materialize(merge_counts(merge_rows(target.limit(0), source, keys, guard), group))
    target = touched(target)

    counts = materialize(merge_counts(merge_rows(target, source, keys, guard), group))
    changed = counts.filter("rows_inserted + rows_updated > 0").select(partition).distinct()
    affected = named_partitions(changed, partition)
    if affected is not None:
        merged = merge_rows(affected(target), affected(source), keys, guard)
        _write(merged, path, partition, keys)
    return counts


def _write(
    merged: DataFrame,
    path: str,
    partition: str,
    keys: Sequence[str],
    actions: Observation | None = None,
) -> None:
    """Publish merged rows; ``actions`` counts them where they are written.

    That is in the last stage, behind the shuffle: a task of it that is run again after
    a lost executor counts once.
    """
    record_schema(merged.sparkSession, path, merged.drop("_action").schema)

    def finish(rows: DataFrame) -> DataFrame:
        counted = rows if actions is None else rows.observe(actions, *_action_counts())
        return counted.drop("_action")

    replace_partitions(merged, path, [partition], sort_by=keys, finish=finish)


def named_partitions(
    values: DataFrame, partition: str
) -> Callable[[DataFrame], DataFrame] | None:
    """A filter for some partitions, listed as literals so that the scan is pruned.

    Too many to list are pruned by their range and then matched by a join. None
    stands for no partition at all.
    """
    listed = [row[0] for row in values.limit(_LISTED_PARTITIONS + 1).collect()]
    if not listed:
        return None
    value = F.col(partition)
    if len(listed) <= _LISTED_PARTITIONS:
        named = value.isin([v for v in listed if v is not None])
        return lambda df: df.filter(named | value.isNull() if None in listed else named)
    low, high = values.agg(F.min(partition), F.max(partition)).first()
    ranged = value.between(low, high) | value.isNull()
    return lambda df: semi_join(df.filter(ranged), values, [partition])


def incremental_merge(
    spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], partition: str
) -> dict[str, int]:
    """Merge a rebuilt window into a mart: matched rows are always updated.

    Every partition of the window changes, so none has to be looked at first: the
    target's are read once, and the counts returned come from the write itself.
    """
    with staged(rows, "mart-window") as window:
        if not check_unique_combination(window, keys).isEmpty():
            raise ValueError(f"the source of a merge repeats keys ({', '.join(keys)})")
        recover(spark, path)
        target = read_table(spark, path)
        if target is None:
            target = _nothing(spark, window.schema)
        touched = named_partitions(window.select(partition).distinct(), partition)
        if touched is None:
            return {f"rows_{name}": 0 for name in _COUNTS}
        actions = Observation()
        _write(merge_rows(touched(target), window, keys), path, partition, keys, actions)
        return actions.get
