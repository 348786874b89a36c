"""Seeded order, limits and splits that do not depend on the partitioning.

Every order is over (md5 key, order columns), a total order, so "the first k rows" is a cut in that
order. Finding the cut reads the order columns only; applying it is a filter on each row. No
operator here but the shuffle itself moves whole rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tuneprep.functions.hashing import HOLDOUT, SHUFFLE, SIDE, leading_bits, order_key
from tuneprep.operators.placement import hash_slot, shuffle_partitions, stretch
from tuneprep.runtime import SPLIT, column, materialize, names, temporary_tables

TRAIN, TEST, VALIDATION = "train", "test", "validation"

# Keys are counted by their first hexadecimal digits: at most 16**4 groups, each holding about
# 1/65536 of the rows.
_DIGITS = 4
# Rows are placed by the first eight digits, a 32-bit number.
_PLACE_DIGITS = 8


def seeded_shuffle(df: DataFrame, seed: int, order_col) -> DataFrame:
    """Rows in a uniformly random order fixed by the seed.

    The md5 key is uniform, so its range bounds are known: rows go straight to their slot and are
    sorted there. One shuffle, without the sampling pass over the input that ``orderBy`` makes.
    Partition i holds the i-th stretch of the order, and so does the i-th file written from it. Rows
    of all splits are interleaved; each split's rows are in the order of its own shuffle.
    """
    order = names(order_col)
    slots = shuffle_partitions(df)
    return (
        df.withColumn("_tp_key", order_key(SHUFFLE, seed, order))
        .withColumn("_tp_slot", hash_slot(F.col("_tp_key"), slots))
        .repartitionById(slots, F.col("_tp_slot"))
        .sortWithinPartitions("_tp_key", *[column(c) for c in order])
        .drop("_tp_key", "_tp_slot")
    )


def shuffle_rank(
    df: DataFrame, seed: int, order_col, rank_col: str = "rank", within: str | None = SPLIT
) -> DataFrame:
    """Add the 0-based place of a row in the shuffled order of its split."""
    group = [within] if within in df.columns else []
    order = [column(c) for c in names(order_col)]
    # Many more slots than tasks, so that tasks get even shares.
    slots = 16 * shuffle_partitions(df)
    slot = hash_slot(order_key(SHUFFLE, seed, order_col), slots)
    before = Window.partitionBy(*[column(c) for c in group], F.lit(0)).orderBy("_tp_slot")
    # One row per slot and split.
    offsets = (
        df.groupBy(*[column(c) for c in group], slot.alias("_tp_slot"))
        .agg(F.count(F.lit(1)).alias("_tp_rows"))
        .withColumn(
            "_tp_offset",
            F.coalesce(
                F.sum("_tp_rows").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .drop("_tp_rows")
    )
    in_slot = Window.partitionBy(*[column(c) for c in group], "_tp_slot").orderBy("_tp_key", *order)
    ranked = (
        df.withColumn("_tp_key", order_key(SHUFFLE, seed, order_col))
        .withColumn("_tp_slot", slot)
        .withColumn("_tp_place", F.row_number().over(in_slot) - 1)
    )
    # The window has placed the rows by the join columns: the join moves only the offsets.
    return ranked.join(offsets, [*group, "_tp_slot"]).select(
        *[column(c) for c in df.columns], (F.col("_tp_place") + F.col("_tp_offset")).alias(rank_col)
    )


def _first_k(
    df: DataFrame, k: Callable[[Column], Column], purpose: str, seed: int, order_col
) -> Column | None:
    """Predicate true for the ``k(total)`` rows with the smallest keys; None if that is all rows."""
    order = names(order_col)
    keys = df.select(order_key(purpose, seed, order).alias("_tp_key"), *[column(c) for c in order])
    everything = Window.partitionBy(F.lit(0))
    # At most 65536 groups: their running sum may use one task.
    crossing = (
        keys.groupBy(leading_bits(F.col("_tp_key"), _DIGITS).alias("_tp_group"))
        .agg(F.count(F.lit(1)).alias("_tp_rows"))
        .withColumn("_tp_upto", F.sum("_tp_rows").over(everything.orderBy("_tp_group")))
        .withColumn("_tp_wanted", k(F.sum("_tp_rows").over(everything)))
        .filter(F.col("_tp_upto") > F.col("_tp_wanted"))
        .orderBy("_tp_group")
        .first()
    )
    if crossing is None:
        return None
    wanted_here = crossing["_tp_wanted"] - (crossing["_tp_upto"] - crossing["_tp_rows"])
    # Ranks the keys of one group only, about 1/65536 of the rows, to find the first row left out.
    in_group = Window.partitionBy("_tp_group").orderBy("_tp_key", *[column(c) for c in order])
    cut = (
        keys.withColumn("_tp_group", leading_bits(F.col("_tp_key"), _DIGITS))
        .filter(F.col("_tp_group") == crossing["_tp_group"])
        .withColumn("_tp_place", F.row_number().over(in_group))
        .filter(F.col("_tp_place") == wanted_here + 1)
        .first()
    )
    key = order_key(purpose, seed, order)
    return (key < cut["_tp_key"]) | ((key == cut["_tp_key"]) & _before(df, cut, order))


def _before(df: DataFrame, cut: Row, order: list[str]) -> Column:
    """Rows whose order columns come before those of the ``cut`` row."""
    keys = df.select(*[column(c) for c in order])
    return F.struct(*[column(c) for c in order]) < _literal(keys, cut)


def _first_k_in_order(df: DataFrame, k: int, order_col) -> Column | None:
    order = names(order_col)
    cut = nth_row(df, k, order)
    return None if cut is None else _before(df, cut, order)


# Rows of a bracket that are few enough to be collected, and pivots that split a larger one.
_FEW = 4096
_PIVOTS = 1024


def nth_row(df: DataFrame, k: int, order_col) -> Row | None:
    """Order columns of the row with ``k`` rows before it; None if there are not that many.

    A bracket around the row is narrowed until it holds a few thousand rows: a sample of it gives
    pivots, one aggregation counts the rows between them exactly. Every round reads the order columns
    only and leaves about a thousandth of the rows; nothing is sorted, shuffled or stored but counts.
    The sample decides how fast the bracket shrinks, never which row is found.
    """
    order = names(order_col)
    keys = df.select(*[column(c) for c in order])
    by = [column(c) for c in order]
    key = F.struct(*by)
    inside, size = keys, keys.count()
    if k >= size:
        return None
    for seed in range(64):
        if size <= _FEW:
            return inside.orderBy(*by).limit(k + 1).collect()[k]
        share = min(1.0, 2 * _PIVOTS / size)
        # Twice as many as needed on average; the limit only guards the driver.
        sampled = inside.sample(share, seed=seed).limit(8 * _PIVOTS).collect()
        pivots = sorted(set(sampled), key=_nulls_first)
        pivots = pivots[:: max(1, len(pivots) // _PIVOTS)]
        if not pivots:
            continue
        listed = df.sparkSession.createDataFrame(
            [(p, i) for i, p in enumerate(pivots)],
            T.StructType([T.StructField("_tp_at", keys.schema), T.StructField("_tp_start", T.LongType())]),
        ).agg(F.sort_array(F.collect_list(F.struct("_tp_at", "_tp_start"))).alias("cuts"))
        placed = inside.withColumn("_tp_cuts", listed.scalar()).select(
            stretch(F.col("_tp_cuts"), len(pivots), key)["part"].alias("part")
        )
        counts = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
        part = -1
        while k >= counts.get(part, 0):
            k -= counts.get(part, 0)
            part += 1
        here = counts[part]
        if part >= 0:
            low = _literal(keys, pivots[part])
            if here == size or here > _FEW:
                # A key that repeats very often may be all there is: settle it by its own count.
                same = inside.filter(key == low).count()
                if k < same:
                    return pivots[part]
                inside, k, here = inside.filter(key > low), k - same, here - same
            else:
                inside = inside.filter(key >= low)
        if part + 1 < len(pivots):
            inside = inside.filter(key < _literal(keys, pivots[part + 1]))
        size = here
    raise RuntimeError("no bracket was found")


def _nulls_first(row: Row) -> tuple:
    return tuple((value is not None, value) for value in row)


def _literal(keys: DataFrame, row: Row) -> Column:
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in keys.schema])


def limit_train(
    df: DataFrame, n: int, order_col, seed: int | None = None, split_col: str = SPLIT
) -> DataFrame:
    """At most ``n`` rows of the train split; other splits stay whole. ``n <= 0`` means no limit.

    With a seed the first rows of the shuffled order are kept, a uniform sample; without one, the
    first rows in dataset order.
    """
    return _apply(df, _within_limit(df, n, order_col, seed, split_col))


def _within_limit(keys, n, order_col, seed, split_col=SPLIT) -> Column | None:
    if n <= 0:
        return None
    train = keys.filter(column(split_col) == TRAIN)
    first = (
        _first_k_in_order(train, n, order_col)
        if seed is None
        else _first_k(train, lambda total: F.lit(n).cast("bigint"), SHUFFLE, seed, order_col)
    )
    return None if first is None else (column(split_col) != TRAIN) | first


def _apply(df: DataFrame, predicate: Column | None) -> DataFrame:
    return df if predicate is None else df.filter(predicate)


def has_split(df: DataFrame, name: str, split_col: str = SPLIT) -> bool:
    """Whether the split has a row. On a table partitioned by split this opens one file at most."""
    return not df.filter(column(split_col) == name).select(column(split_col)).isEmpty()


def train_test_split(
    df: DataFrame,
    ratio: float,
    seed: int,
    order_col,
    split_col: str = SPLIT,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Hold out exactly ``ceil(ratio * n)`` train rows as ``test``, unless a validation split exists.

    The result replaces the collection: any other split is dropped, with a warning. ``keys`` is a
    narrow stored copy of the order and split columns of ``df`` to find the cut on, for files that
    cannot be read column by column.
    """
    if not 0 < ratio < 1:
        raise ValueError(f"ratio must lie between 0 and 1, got {ratio}")
    known = df if keys is None else keys
    if has_split(known, VALIDATION, split_col):
        return df
    if not has_split(known, TRAIN, split_col):
        raise ValueError("there is no train split to hold rows out of")
    warnings.warn("no validation split: every split but train is dropped", stacklevel=2)
    held = _first_k(
        known.filter(column(split_col) == TRAIN),
        lambda total: F.ceil(total * F.lit(ratio)),
        HOLDOUT,
        seed,
        order_col,
    )
    if held is None:
        raise ValueError(f"ratio {ratio} would hold out every train row")
    side = F.when(held, F.lit(TEST)).otherwise(F.lit(TRAIN))
    return df.filter(column(split_col) == TRAIN).withColumn(split_col, side)


def limit_and_split(
    df: DataFrame, limit: int, ratio: float, seed: int, order_col, shuffled: bool = True
) -> DataFrame:
    """``limit_train``, then ``train_test_split``, over one narrow stored copy of the row keys.

    Both cuts are found on the copy, so a row format such as JSON lines is scanned once for it and
    once for the result, and not again for every pass.
    """
    with temporary_tables(df.sparkSession):
        keys = materialize(df.select(SPLIT, *[column(c) for c in names(order_col)]), "row-keys")
        within = _within_limit(keys, limit, order_col, seed if shuffled else None)
        return train_test_split(
            _apply(df, within), ratio, seed, order_col, keys=_apply(keys, within)
        )


def hash_split(
    df: DataFrame, ratio: float, seed: int, order_col, split_col: str = SPLIT
) -> DataFrame:
    """Hold out about ``ratio`` of the rows by their key alone.

    A projection without any job; a row keeps its side while the data grows.
    """
    share = leading_bits(order_key(SIDE, seed, order_col), _PLACE_DIGITS) / (16**_PLACE_DIGITS)
    return df.withColumn(
        split_col, F.when(share < ratio, F.lit(TEST)).otherwise(F.lit(TRAIN))
    )


def choose_eval_split(df: DataFrame, split_col: str = SPLIT) -> DataFrame:
    """The ``validation`` rows if there are any, else the ``test`` rows."""
    name = VALIDATION if has_split(df, VALIDATION, split_col) else TEST
    return df.filter(column(split_col) == name)
