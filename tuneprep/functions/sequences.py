"""Token id arrays: masks, completion start, labels, padding, truncation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tuneprep.functions.binding import bind

# Fixed value: the label that losses and scores skip.
IGNORE_LABEL = -100


def attention_mask(ids: Column, given: Column | None = None) -> Column:
    """The given mask where there is one, else a one for every token."""
    ones = F.transform(ids, lambda _: F.lit(1))
    return ones if given is None else F.coalesce(given, ones)


def completion_start(ids: Column, pattern: Sequence[int]) -> Column:
    """Index just after the first occurrence of ``pattern``; 0 if it is empty or does not occur."""
    pattern = list(pattern)
    if not pattern:
        return F.lit(0)
    match = bind({"ids": ids}, lambda get: _first_match(get("ids"), pattern))
    return F.coalesce(F.nullif(match, F.lit(0)) - 1 + len(pattern), F.lit(0)).cast("int")


def tag_found(start: Column) -> Column:
    """Whether ``completion_start`` met its pattern: a match never ends at 0."""
    return start > 0


def _first_match(ids: Column, pattern: list[int]) -> Column:
    """1-based position of the first match, 0 without one; tests later tokens only at an anchor."""

    def matches(token, i):
        hit = token == F.lit(pattern[0])
        for offset, wanted in enumerate(pattern[1:], start=1):
            hit = hit & (F.get(ids, i + offset) == F.lit(wanted))
        return hit

    return F.array_position(F.transform(ids, matches), True)


def completion_labels(
    padded_ids: Column, start: Column, length: Column | None = None, mask_padding: bool = False
) -> Column:
    """Copy of the padded ids with every position before ``start`` ignored.

    Padding keeps its id by default; ``mask_padding`` ignores it too and then needs the unpadded
    ``length``.
    """
    if mask_padding and length is None:
        raise ValueError("mask_padding needs the unpadded length")
    width = F.size(padded_ids)
    end = length if mask_padding else width
    return F.concat(
        _ignored(start),
        F.slice(padded_ids, start + 1, F.greatest(end - start, F.lit(0))),
        _ignored(width - end) if mask_padding else F.array().cast("array<int>"),
    )


def _ignored(count: Column) -> Column:
    return F.array_repeat(F.lit(IGNORE_LABEL), count.cast("int"))


def pad_right(values: Column, width: Column, fill: int) -> Column:
    missing = (width - F.size(values)).cast("int")
    return F.concat(values, F.array_repeat(F.lit(fill).cast("int"), missing))


def keep_first(values: Column, n: Column | int) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.slice(values, F.lit(1), F.greatest(n.cast("int"), F.lit(0)))


def keep_last(values: Column, n: int) -> Column:
    count = F.least(F.lit(n), F.size(values))
    # A start of 0 is an error in slice(), so an empty result starts at 1.
    return F.when(count > 0, F.slice(values, F.size(values) - count + 1, count)).otherwise(
        F.slice(values, F.lit(1), F.lit(0))
    )
