"""Contiguous row numbers in dataset order, without a single-task window."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuneprep.runtime import column, materialize, names

INDEX = "idx"

# monotonically_increasing_id() keeps the row's place in its partition in the low 33 bits.
_PLACE_MASK = (1 << 33) - 1


def index_keys(
    df: DataFrame,
    order_col,
    carry: Mapping[str, Column] | None = None,
    index_col: str = INDEX,
    unique: bool = False,
    within=(),
) -> DataFrame:
    """Order columns, carried values and the 0-based contiguous index.

    Only these narrow columns are range-sorted. The sorted keys are stored together with their
    partition and place, so the sampled range bounds are drawn once and the result never depends
    on a re-computation. The index is place + rows in earlier partitions. ``within`` (columns) gives
    each of their groups an index of its own. With ``unique`` a key that is null or repeated is an
    error; equal keys share a range, so they are counted where they are, without a further shuffle.
    """
    groups = names(within)
    order = [*groups, *names(order_col)]
    carry = carry or {}
    narrow = df.select(
        *[column(c) for c in order], *[value.alias(name) for name, value in carry.items()]
    )
    ranged = narrow.repartitionByRange(*[column(c) for c in order])
    if unique:
        ranged = _only_unique(ranged, order, list(carry), groups)
    placed = (
        ranged.sortWithinPartitions(*[column(c) for c in order])
        .withColumn("_tp_part", F.spark_partition_id())
        .withColumn("_tp_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_MASK)))
    )
    stored = materialize(placed, "index-keys")
    return add_offsets(stored, "_tp_part", "_tp_place", index_col, groups).select(
        *[column(c) for c in order], *[column(c) for c in carry], column(index_col)
    )


def _only_unique(
    ranged: DataFrame, order: list[str], carried: list[str], groups: list[str]
) -> DataFrame:
    """The same rows, or an error that names a key which is null or repeated."""
    keys = [column(c) for c in order]
    null = F.lit(False)
    for name in order:
        if name not in groups:  # rows without a split are a group of their own
            null = null | column(name).isNull()
    shown = F.concat_ws(", ", *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    message = F.concat(F.lit("order columns must be unique and not null: "), shown)
    # A value that must be looked at, so that the check is not optimised away.
    checked = F.when(null | (F.col("_tp_same") > 1), F.raise_error(message).cast("boolean"))
    return (
        ranged.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_tp_same"), *[F.first(column(c)).alias(c) for c in carried])
        .filter(F.coalesce(checked, F.lit(True)))
        .drop("_tp_same")
    )


def add_offsets(placed: DataFrame, part: str, place: str, index_col: str, groups=()) -> DataFrame:
    """Turn (partition, place in partition) into a global index, or one for each of the ``groups``.

    Groups must follow each other in the order of the rows. There is one offset row per partition of
    the sort and per group that begins inside one, so that table is bounded by the numbers of shuffle
    partitions and of groups (splits): its running sum may use one task, and it may be broadcast. The
    rows stay where they are, however many of them a group has.
    """
    within = [column(c) for c in names(groups)]
    segments = placed.groupBy(column(part).alias("_tp_p"), *within).agg(
        F.count(F.lit(1)).alias("_tp_rows"), F.min(column(place)).alias("_tp_first")
    )
    before = (
        Window.partitionBy(F.lit(0))
        .orderBy("_tp_p", "_tp_first")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum("_tp_rows").over(before), F.lit(0))
    own = Window.partitionBy(F.lit(0), *within)
    offsets = (
        segments.withColumn("_tp_start", start)
        .withColumn("_tp_offset", F.col("_tp_start") - F.min("_tp_start").over(own) - F.col("_tp_first"))
        .select("_tp_p", *[w.alias(f"_tp_g_{i}") for i, w in enumerate(within)], "_tp_offset")
    )
    same = column(part) == F.col("_tp_p")
    for i, group in enumerate(within):
        same = same & group.eqNullSafe(F.col(f"_tp_g_{i}"))
    return placed.join(F.broadcast(offsets), same).select(
        *[column(c) for c in placed.columns], (column(place) + F.col("_tp_offset")).alias(index_col)
    )
