"""Column mapping, row filters and templates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneprep.functions.text import has_text, normalize_text, render_template, stringify
from tuneprep.runtime import SPLIT, column, names

# Fixed value: the two texts of a preference pair, in the order they are written.
PAIR_COLUMNS = ("chosen", "rejected")


def validate_mapping(
    df: DataFrame, column_map: Mapping[str, str], required: Sequence[str] = ()
) -> None:
    """Raise unless all ``required`` targets are mapped and at least one source column exists."""
    absent = [key for key in required if key not in column_map]
    if absent:
        raise ValueError(
            f"column_map must contain {sorted(required)}, got {sorted(column_map)}"
        )
    if not any(source in df.columns for source in column_map.values()):
        raise ValueError(
            f"none of the mapped columns {sorted(column_map.values())} is among "
            f"{sorted(df.columns)}"
        )


def carried_columns(df: DataFrame, order_col, split_col: str | None = SPLIT) -> list[str]:
    """Row identity that every step passes on: the order columns and, if present, the split."""
    order = names(order_col)
    unknown = [c for c in order if c not in df.columns]
    if unknown:
        raise ValueError(f"order columns {unknown} are not among {df.columns}")
    split = [split_col] if split_col in df.columns and split_col not in order else []
    return split + order


def map_columns(
    df: DataFrame,
    column_map: Mapping[str, str],
    order_col,
    required: Sequence[str] = (),
    split_col: str | None = SPLIT,
) -> DataFrame:
    """Exactly the target columns, as text, next to the row identity.

    A mapped source column that does not exist reads as null. With ``required`` only those targets
    are kept, in that order.
    """
    validate_mapping(df, column_map, required)
    carried = carried_columns(df, order_col, split_col)
    targets = list(required) or list(column_map)
    clash = set(targets).intersection(carried)
    if clash:
        raise ValueError(f"targets {sorted(clash)} collide with order or split columns")
    values = [
        (
            stringify(df, column_map[target])
            if column_map[target] in df.columns
            else F.lit(None).cast("string")
        ).alias(target)
        for target in targets
    ]
    return df.select(*[column(c) for c in carried], *values)


def drop_missing(df: DataFrame, cols) -> DataFrame:
    """Keep rows whose ``cols`` all hold a visible character.

    Meant for the raw texts, before ``normalize_columns``: the outcome is the same and the filter
    runs at the scan.
    """
    for name in names(cols):
        df = df.filter(has_text(column(name)))
    return df


def normalize_columns(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({name: normalize_text(column(name)) for name in names(cols)})


def drop_degenerate_pairs(
    df: DataFrame, chosen: str = "chosen", rejected: str = "rejected"
) -> DataFrame:
    """Drop pairs whose two texts are equal (case-sensitive) or of which one is null.

    A plain filter on computed columns is pushed below the projection and computes both texts a
    second time. Unnesting a filtered one-element array keeps the texts computed once.
    """
    pair = F.array(F.struct(column(chosen), column(rejected)))
    kept = F.filter(pair, lambda p: p[chosen] != p[rejected])
    others = [column(c) for c in df.columns if c not in (chosen, rejected)]
    return df.select(*others, F.inline(kept)).select(*[column(c) for c in df.columns])


def format_template(
    df: DataFrame, template: str, out_col: str, order_col, split_col: str | None = SPLIT
) -> DataFrame:
    """The rendered template as the only text column, next to the row identity.

    ``out_col`` may be the name of an input column: the template is rendered from the inputs first.
    """
    carried = carried_columns(df, order_col, split_col)
    if out_col in carried:
        raise ValueError(f"output column {out_col!r} collides with order or split columns")
    return df.select(*[column(c) for c in carried], render_template(df, template).alias(out_col))
