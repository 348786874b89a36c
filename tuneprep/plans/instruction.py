"""Supervised fine-tuning data: raw splits to labelled batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tuneprep.operators.batching import LENGTH, collate
from tuneprep.operators.dedup import stored_dedup
from tuneprep.operators.mapping import (
    drop_missing,
    format_template,
    map_columns,
    normalize_columns,
)
from tuneprep.operators.metrics import PrepCounts, Written
from tuneprep.operators.placement import in_order
from tuneprep.operators.sampling import TRAIN, has_split, limit_and_split, seeded_shuffle
from tuneprep.operators.tokens import Encoder, encode, encode_literal
from tuneprep.runtime import SPLIT, materialize, names, temporary_tables
from tuneprep.sources.prepared import pending_splits, read_prepared, write_prepared

# Prompt templates by model family and the tag that opens the completion. The
# example templates end with a line break, the completion templates do not.
ROLE_TAG_TEMPLATE = "<|user|>\n{prompt}\n<|assistant|>\n{response}\n"
ROLE_TAG_COMPLETION = "<|assistant|>"
CHAT_MARKUP_TEMPLATE = (
    "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n"
    "<|im_start|>user\n{prompt}<|im_end|>\n"
    "<|im_start|>assistant\n{response}<|im_end|>\n"
)
CHAT_MARKUP_COMPLETION = "<|im_start|>assistant"

# Defaults of the data configuration.
DEFAULT_COLUMN_MAP = {"prompt": "instruction", "response": "response"}
DEFAULT_DEDUPLICATE = "prompt"
DEFAULT_SEED = 42
DEFAULT_EVAL_RATIO = 0.05
DEFAULT_MAX_TOKENS = 2048
DEFAULT_BATCH_SIZE = 6


def clean_instructions(
    df: DataFrame,
    column_map: Mapping[str, str],
    order_col,
    deduplicate: str | None = None,
    counts: PrepCounts | None = None,
) -> DataFrame:
    """Mapped, non-empty, normalised and, if asked for, deduplicated rows."""
    texts = list(column_map)
    mapped = map_columns(df, column_map, order_col)
    if counts:
        mapped = counts.rows_in(mapped, texts)
    clean = normalize_columns(drop_missing(mapped, texts), texts)
    return stored_dedup(clean, deduplicate, order_col) if deduplicate else clean


def prepare_instructions(
    df: DataFrame,
    column_map: Mapping[str, str],
    order_col,
    splits,
    path: str,
    deduplicate: str | None = None,
    fmt: str = "json",
    if_exists: str = "skip",
    only_mapped: bool = False,
    compression: str | None = None,
) -> Written:
    """Clean the splits that are not written yet and write them. Returns the splits written.

    Their ``counts`` (rows in, dropped by reason, out) are taken on the way and kept in the manifest.
    Order columns are written along, as later steps need an order; with ``only_mapped`` the files
    have exactly the mapped columns, one row after the other in dataset order. ``compression`` as in
    ``write_prepared``.
    """
    todo = pending_splits(df.sparkSession, path, splits, if_exists)
    if not todo:
        return Written()
    with temporary_tables(df.sparkSession):
        counts = PrepCounts(todo)
        raw = df.filter(df[SPLIT].isin(*todo))
        clean = clean_instructions(raw, column_map, order_col, deduplicate, counts)
        if only_mapped:
            clean = in_order(clean, order_col, list(column_map))
        rows = counts.rows_out(clean)
        written = write_prepared(rows, path, todo, fmt, if_exists, counts.by_split, compression)
        return Written(written, counts.by_split())


def assemble_instructions(
    df: DataFrame,
    template: str,
    order_col,
    text_field: str = "prompt",
    seed: int = DEFAULT_SEED,
    shuffle: bool = True,
    limit: int = -1,
    eval_ratio: float = DEFAULT_EVAL_RATIO,
    place: bool = True,
) -> DataFrame:
    """Limited, rendered and split rows; in shuffled order if ``shuffle``.

    The cut and the split decide row by row, so the only shuffle of whole rows is the last step. With
    ``place`` off that step is left to ``batch_instructions``: given the same seed, it lays out the
    tokens in the same order, and texts are not shuffled at all.
    """
    if not has_split(df, TRAIN):
        raise ValueError("there is no train split to assemble")
    split = limit_and_split(df, limit, eval_ratio, seed, order_col, shuffle)
    rendered = format_template(split, template, text_field, order_col)
    return seeded_shuffle(rendered, seed, order_col) if shuffle and place else rendered


def instruction_dataset(
    raw: DataFrame,
    template: str,
    order_col,
    splits,
    path: str,
    column_map: Mapping[str, str] = DEFAULT_COLUMN_MAP,
    deduplicate: str | None = DEFAULT_DEDUPLICATE,
    text_field: str = "prompt",
    seed: int = DEFAULT_SEED,
    shuffle: bool = True,
    limit: int = -1,
    eval_ratio: float = DEFAULT_EVAL_RATIO,
    fmt: str = "json",
    if_exists: str = "skip",
    place: bool = True,
) -> DataFrame:
    """Raw splits to training texts: prepare what is not written yet, read it back, assemble."""
    prepare_instructions(raw, column_map, order_col, splits, path, deduplicate, fmt, if_exists)
    texts = T.StructType([T.StructField(name, T.StringType()) for name in column_map])
    order = [raw.schema[name] for name in names(order_col)]
    prepared = read_prepared(raw.sparkSession, path, T.StructType([*order, *texts]), fmt)
    return assemble_instructions(
        prepared.filter(prepared[SPLIT].isin(*splits)),
        template, order_col, text_field, seed, shuffle, limit, eval_ratio, place,
    )


def tokenize_instructions(
    df: DataFrame,
    text_field: str,
    encoder: Encoder,
    order_col,
    max_len: int = DEFAULT_MAX_TOKENS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Stored token ids, masks, lengths and ``keep``: later steps read them more than once."""
    encoded = encode(df, text_field, encoder, max_len, order_col, keep=keep)
    return materialize(encoded.withColumn(LENGTH, F.size("input_ids")), "tokens")


def batch_instructions(
    tokens: DataFrame,
    encoder: Encoder,
    order_col,
    pad_id: int,
    completion_template: str | None = None,
    batch_size: int = DEFAULT_BATCH_SIZE,
    mask_padding: bool = False,
    seed: int | None = None,
) -> DataFrame:
    """Padded batches with labels from stored tokens, split by split.

    Without a completion template every token is trained on. With a ``seed`` the batches follow its
    shuffled order, the same that ``assemble_instructions`` cuts by, and ``rank`` is the place in it;
    without one they follow the order columns.
    """
    tag = encode_literal(encoder, completion_template) if completion_template else []
    return collate(tokens, batch_size, pad_id, order_col, tag, mask_padding, seed)
