"""Exact deduplication that keeps the first row in dataset order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneprep.functions.hashing import content_hash
from tuneprep.runtime import SPLIT, column, materialize, names

# Broadcast at most this many repeated texts, and at most this many bytes of their order keys and
# split names (a hash is 32 bytes): the hashed relation stays near 100 MB.
MAX_BROADCAST_GROUPS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

_HASH = "_tp_content"
_FIRST = "_tp_first"
_COPIES = "_tp_copies"


@dataclass(frozen=True)
class Deduplicated:
    rows: DataFrame
    dropped: DataFrame


def _group_columns(df: DataFrame, within) -> list[str]:
    return [c for c in names(within or []) if c in df.columns]


def with_content_hash(df: DataFrame, key: str) -> DataFrame:
    """Add the hash that the functions below otherwise compute; worth storing with the rows."""
    return df.withColumn(_HASH, content_hash(column(key)))


def _hash(df: DataFrame, key: str) -> Column:
    return F.col(_HASH) if _HASH in df.columns else content_hash(column(key))


def copy_groups(df: DataFrame, key: str, order_col, within=SPLIT) -> DataFrame:
    """One row per distinct text: its hash, its first row and its number of copies.

    Map-side partial aggregation folds the copies of a text before the shuffle, so a text that is a
    third of all rows costs one row per task. Only a hash and an order key are shuffled.
    """
    order = names(order_col)
    first = column(order[0]) if len(order) == 1 else F.struct(*[column(c) for c in order])
    return df.groupBy(
        *[column(c) for c in _group_columns(df, within)], _hash(df, key).alias(_HASH)
    ).agg(F.min(first).alias(_FIRST), F.count(F.lit(1)).alias(_COPIES))


def dedup_with_counts(
    df: DataFrame,
    key: str,
    order_col,
    within=SPLIT,
    max_broadcast_groups: int = MAX_BROADCAST_GROUPS,
) -> Deduplicated:
    """First row in order of every distinct ``key``, and the number of dropped rows.

    Texts are compared by SHA-256. One narrow pass finds the groups and stores them. ``df`` is read
    once more for the result: store it first, ``with_content_hash``, if it is costly to compute;
    the narrow pass then reads hashes and order keys alone. Given the groups,

    * if few texts are repeated, those groups are broadcast and each row decides alone whether it
      is a later copy: the wide rows are not shuffled at all;
    * otherwise the wide rows are semi-joined with the winners on the unique order columns, which
      no repeated text can skew.
    """
    order = names(order_col)
    group = _group_columns(df, within)
    groups = materialize(copy_groups(df, key, order, group), "copy-groups")
    repeated = groups.filter(F.col(_COPIES) > 1)

    if _may_broadcast(repeated, group, max_broadcast_groups):
        rows = _drop_later_copies(df, repeated, key, order, group)
    else:
        rows = _keep_winners(df, groups, order, group)

    dropped = groups.groupBy(*group).agg(
        F.sum(F.col(_COPIES) - 1).alias("dropped_duplicates")
    )
    return Deduplicated(rows.drop(_HASH), dropped)


def _may_broadcast(repeated: DataFrame, group: list[str], max_groups: int) -> bool:
    key_bytes = F.lit(0)
    for name in [*group, _FIRST]:
        key_bytes = key_bytes + F.coalesce(F.octet_length(column(name).cast("string")), F.lit(0))
    size = (
        repeated.limit(max_groups + 1)
        .agg(F.count(F.lit(1)).alias("groups"), F.sum(key_bytes).alias("bytes"))
        .first()
    )
    return size["groups"] <= max_groups and (size["bytes"] or 0) <= MAX_BROADCAST_BYTES


def dedup_first(
    df: DataFrame,
    key: str,
    order_col,
    within=SPLIT,
    max_broadcast_groups: int = MAX_BROADCAST_GROUPS,
) -> DataFrame:
    """``dedup_with_counts`` without the counts. ``within=None`` deduplicates across splits."""
    return dedup_with_counts(df, key, order_col, within, max_broadcast_groups).rows


def stored_dedup(df: DataFrame, key: str, order_col, within=SPLIT) -> DataFrame:
    """``dedup_first`` of rows that are costly to compute: they are stored, with hashes, once."""
    return dedup_first(
        materialize(with_content_hash(df, key), "clean"), key, order_col, within
    )


def _drop_later_copies(df, repeated, key, order, group):
    this = column(order[0]) if len(order) == 1 else F.struct(*[column(c) for c in order])
    winners = repeated.select(
        *[column(c).alias(f"_tp_g_{i}") for i, c in enumerate(group)],
        F.col(_HASH).alias("_tp_g_hash"),
        _FIRST,
    )
    same = _hash(df, key) == F.col("_tp_g_hash")
    for i, c in enumerate(group):
        same = same & column(c).eqNullSafe(F.col(f"_tp_g_{i}"))
    # A row falls out iff its text is repeated and its place is not the first one.
    return df.join(F.broadcast(winners), same & (this != F.col(_FIRST)), "left_anti")


def _keep_winners(df, groups, order, group):
    if len(order) == 1:
        places = [F.col(_FIRST).alias("_tp_o_0")]
    else:
        places = [F.col(_FIRST)[c].alias(f"_tp_o_{i}") for i, c in enumerate(order)]
    winners = groups.select(*[column(c).alias(f"_tp_g_{i}") for i, c in enumerate(group)], *places)
    same = F.lit(True)
    for i, c in enumerate(order):
        same = same & (column(c) == F.col(f"_tp_o_{i}"))
    for i, c in enumerate(group):
        same = same & column(c).eqNullSafe(F.col(f"_tp_g_{i}"))
    return df.join(winners, same, "left_semi")
