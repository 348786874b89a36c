"""Prompt separation and length control of preference pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneprep.functions.binding import bind
from tuneprep.functions.sequences import keep_first, keep_last
from tuneprep.runtime import column


def common_prefix_length(a: Column, b: Column) -> Column:
    """Characters that both texts start with, by binary descent: 31 comparisons at most."""
    steps = F.array(*[F.lit(1 << bit) for bit in range(30, -1, -1)])

    def search(get):
        def descend(known, step):
            reach = known.cast("bigint") + step
            agree = (reach <= get("shortest")) & (
                F.substring(get("a"), F.lit(1), reach.cast("int"))
                == F.substring(get("b"), F.lit(1), reach.cast("int"))
            )
            return F.when(agree, reach.cast("int")).otherwise(known)

        return F.aggregate(steps, F.lit(0), descend)

    return bind({"a": a, "b": b, "shortest": F.least(F.length(a), F.length(b))}, search)


def split_common_prompt(
    df: DataFrame, marker: str | None = None, chosen: str = "chosen", rejected: str = "rejected"
) -> DataFrame:
    """``prompt`` and what follows it on either side.

    The prompt is the longest common prefix of both texts. With a turn marker it ends after the
    last marker in that prefix, and is empty if there is none.
    """
    left, right = column(chosen), column(rejected)
    df = df.withColumn("prompt", F.substring(left, F.lit(1), common_prefix_length(left, right)))
    if marker is not None:
        tail = F.substring_index(F.col("prompt"), marker, -1)
        df = df.withColumn(
            "prompt",
            F.when(
                F.contains(F.col("prompt"), F.lit(marker)),
                F.substring(
                    F.col("prompt"), F.lit(1), F.length("prompt") - F.length(tail)
                ),
            ).otherwise(""),
        )
    after = F.length("prompt") + 1
    return df.withColumns(
        {
            chosen: F.substring(left, after, F.length(left)),
            rejected: F.substring(right, after, F.length(right)),
        }
    )


def truncate_pair(df: DataFrame, max_prompt: int, max_len: int) -> DataFrame:
    """Keep the end of ``prompt_ids`` and the start of both completions, within ``max_len``."""
    if max_prompt > max_len:
        raise ValueError(f"max_prompt {max_prompt} exceeds max_len {max_len}")
    cut = df.withColumn("prompt_ids", keep_last(F.col("prompt_ids"), max_prompt))
    room = F.lit(max_len) - F.size("prompt_ids")
    return cut.withColumns(
        {
            "chosen_ids": keep_first(F.col("chosen_ids"), room),
            "rejected_ids": keep_first(F.col("rejected_ids"), room),
        }
    )
