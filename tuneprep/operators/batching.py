"""Padded batches with completion-only labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuneprep.functions.sequences import (
    attention_mask,
    completion_labels,
    completion_start,
    pad_right,
    tag_found,
)
from tuneprep.operators.indexing import INDEX
from tuneprep.operators.placement import KEY, PART, RANK, groups_of, ranked
from tuneprep.runtime import column, names

LENGTH = "n_tokens"
# The sides of a preference pair and their columns of completion ids.
PAIR_SIDES = {"chosen": "chosen_ids", "rejected": "rejected_ids"}


def lay_out(
    df: DataFrame,
    batch_size: int,
    lengths: Mapping[str, Column],
    order_col,
    seed: int | None = None,
    index_col: str = INDEX,
) -> DataFrame:
    """Group consecutive rows: ``batch_id``, ``pos_in_batch`` and, for each length, its batch maximum.

    Every split has batches of its own, numbered from 0. The rows follow each other in dataset order
    or, with a ``seed``, in its shuffled order, and their place in it is kept as ``rank``. Batches
    never straddle two parts of the layout, so whole rows are shuffled and sorted once, and the
    maxima are windows over that same layout. The maxima are columns ``_tp_width_<name>``.

    With an index column in place, and no seed, rows are shuffled by the batch it tells.
    """
    if batch_size < 1:
        raise ValueError(f"batch_size must be positive, got {batch_size}")
    by_index = seed is None and index_col in df.columns
    if by_index:
        rank, rows = column(index_col), df
        batch = Window.partitionBy(*[column(c) for c in groups_of(df, order_col)], "batch_id")
    else:
        rows, window = ranked(df, order_col, seed, batch_size)
        rank = F.col(RANK)
    sized = rows.withColumns({f"_tp_length_{name}": value for name, value in lengths.items()})
    if not by_index:
        # The rows from here to where the batch may end; whole at the first row of a batch.
        ahead = window.rowsBetween(0, batch_size - 1)
        sized = sized.withColumns(
            {f"_tp_ahead_{name}": F.max(f"_tp_length_{name}").over(ahead) for name in lengths}
        )
    laid_out = sized.withColumns(
        {
            "batch_id": F.expr(f"`{index_col if by_index else RANK}` div {batch_size}"),
            "pos_in_batch": (rank % batch_size).cast("int"),
        }
    )
    if by_index:
        width = {n: F.max(f"_tp_length_{n}").over(batch) for n in lengths}
    else:
        so_far = window.rowsBetween(Window.unboundedPreceding, 0)
        first = F.col("pos_in_batch") == 0
        width = {
            n: F.last(F.when(first, F.col(f"_tp_ahead_{n}")), ignorenulls=True).over(so_far)
            for n in lengths
        }
    found = laid_out.withColumns({f"_tp_width_{n}": w for n, w in width.items()})
    helpers = [f"_tp_{kind}_{n}" for kind in ("length", "ahead") for n in lengths]
    return found.drop(*helpers, PART, KEY, *([] if seed is not None or by_index else [RANK]))


def pad_batch(
    df: DataFrame,
    batch_size: int,
    pad_id: int,
    order_col,
    index_col: str = INDEX,
    seed: int | None = None,
) -> DataFrame:
    """Group consecutive rows and right-pad ids and masks to the longest row of their batch.

    Every split has batches of its own, numbered from 0, in dataset order or in the shuffled order of
    a ``seed``. Order keys that are null or repeat within a split are an error.

    Adds ``batch_id``, ``pos_in_batch`` and ``n_tokens`` (the unpadded length), with a seed ``rank``.
    Token arrays are shuffled once, see ``lay_out``. ``df`` is read twice: store the tokens first.
    """
    length = column(LENGTH) if LENGTH in df.columns else F.size("input_ids")
    laid_out = lay_out(
        df.withColumn(LENGTH, length), batch_size, {"ids": column(LENGTH)}, order_col, seed, index_col
    )
    given = column("attention_mask") if "attention_mask" in df.columns else None
    width = F.col("_tp_width_ids")
    return laid_out.withColumns(
        {
            "input_ids": pad_right(F.col("input_ids"), width, pad_id),
            "attention_mask": pad_right(attention_mask(F.col("input_ids"), given), width, 0),
        }
    ).drop("_tp_width_ids")


def collate(
    df: DataFrame,
    batch_size: int,
    pad_id: int,
    order_col,
    completion_ids: Sequence[int] = (),
    mask_padding: bool = False,
    seed: int | None = None,
) -> DataFrame:
    """Padded batches with ``labels`` that ignore everything up to the completion tag.

    The tag is searched in the unpadded ids. Where it does not occur the whole row is trained on;
    ``tag_found`` tells those rows apart.
    """
    start = completion_start(F.col("input_ids"), completion_ids)
    padded = pad_batch(
        df.withColumn("completion_start", start), batch_size, pad_id, order_col, seed=seed
    )
    return padded.withColumn("tag_found", tag_found(F.col("completion_start"))).withColumn(
        "labels",
        completion_labels(
            F.col("input_ids"), F.col("completion_start"), F.col(LENGTH), mask_padding
        ),
    )


def collate_pairs(
    df: DataFrame,
    batch_size: int,
    pad_id: int,
    order_col,
    seed: int | None = None,
    mask_padding: bool = True,
    prompt: str = "prompt_ids",
    sides: Mapping[str, str] = PAIR_SIDES,
    index_col: str = INDEX,
) -> DataFrame:
    """Batches of preference pairs: every side is the prompt and its completion, padded on its own.

    Per side ``input_ids_<side>``, ``attention_mask_<side>`` and ``labels_<side>``, next to the row
    identity, ``batch_id``, ``pos_in_batch`` and ``idx``. A side is padded to the longest sequence of
    that side in the batch. Labels ignore the prompt on both sides and, unless ``mask_padding`` is
    off, the padding, so that a sequence score counts completion tokens only. Both sides are laid
    out in one pass over dataset order or the shuffled order of a ``seed``; ``idx`` is the place in
    it, unless the column is there already: then it says the order, and no seed may be given.
    """
    if index_col in df.columns and seed is not None:
        raise ValueError(f"column {index_col!r} already gives the order: pass no seed")
    identity = [c for c in (*groups_of(df, order_col), *names(order_col))]
    indexed = [index_col] if index_col in df.columns else []
    tokens = df.select(
        *[column(c) for c in dict.fromkeys([*identity, *indexed])],
        F.size(column(prompt)).alias("_tp_prompt"),
        *[F.concat(column(prompt), column(ids)).alias(f"input_ids_{side}") for side, ids in sides.items()],
    )
    lengths = {side: F.size(f"input_ids_{side}") for side in sides}
    laid_out = lay_out(tokens, batch_size, lengths, order_col, seed, index_col)
    if not indexed:
        rank = F.col("batch_id") * batch_size + F.col("pos_in_batch")
        laid_out = laid_out.withColumn(index_col, rank)
    out = {}
    for side in sides:
        ids, width = F.col(f"input_ids_{side}"), F.col(f"_tp_width_{side}")
        padded = pad_right(ids, width, pad_id)
        out[f"input_ids_{side}"] = padded
        out[f"attention_mask_{side}"] = pad_right(attention_mask(ids), width, 0)
        out[f"labels_{side}"] = completion_labels(padded, F.col("_tp_prompt"), F.size(ids), mask_padding)
    kept = dict.fromkeys([*identity, index_col, "batch_id", "pos_in_batch"])
    return laid_out.select(
        *[column(c) for c in kept], *[value.alias(name) for name, value in out.items()]
    )
