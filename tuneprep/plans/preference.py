"""Preference data: raw pairs to prepared pairs, and pairs to losses."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tuneprep.operators.batching import collate_pairs
from tuneprep.operators.dedup import stored_dedup
from tuneprep.operators.mapping import (
    PAIR_COLUMNS,
    drop_degenerate_pairs,
    drop_missing,
    map_columns,
    normalize_columns,
)
from tuneprep.operators.metrics import PrepCounts, Written
from tuneprep.operators.pairs import split_common_prompt, truncate_pair
from tuneprep.operators.placement import in_order
from tuneprep.operators.sampling import limit_and_split, seeded_shuffle
from tuneprep.operators.scoring import dpo_loss, lookup_reference
from tuneprep.operators.tokens import Encoder, encode_columns
from tuneprep.runtime import SPLIT, materialize, names, temporary_tables
from tuneprep.sources.prepared import pending_splits, read_prepared, write_prepared

# Defaults of the preference configuration.
DEFAULT_COLUMN_MAP = {"chosen": "chosen", "rejected": "rejected"}
DEFAULT_BETA = 0.1
DEFAULT_LABEL_SMOOTHING = 0.0
DEFAULT_MAX_PROMPT = 512
DEFAULT_MAX_TOKENS = 2048
DEFAULT_SEED = 42
DEFAULT_EVAL_RATIO = 0.05
DEFAULT_BATCH_SIZE = 6


def clean_pairs(
    df: DataFrame,
    column_map: Mapping[str, str],
    order_col,
    deduplicate: str | None = None,
    counts: PrepCounts | None = None,
) -> DataFrame:
    """Mapped, complete, normalised pairs whose sides differ; deduplicated by one side if asked."""
    if deduplicate is not None and deduplicate not in PAIR_COLUMNS:
        raise ValueError(f"deduplicate must be one of {PAIR_COLUMNS}, got {deduplicate!r}")
    mapped = map_columns(df, column_map, order_col, required=PAIR_COLUMNS)
    if counts:
        mapped = counts.rows_in(mapped, PAIR_COLUMNS)
    normalized = normalize_columns(drop_missing(mapped, PAIR_COLUMNS), PAIR_COLUMNS)
    if counts:
        normalized = counts.cleaned(normalized, PAIR_COLUMNS)
    clean = drop_degenerate_pairs(normalized)
    return stored_dedup(clean, deduplicate, order_col) if deduplicate else clean


def prepare_pairs(
    df: DataFrame,
    column_map: Mapping[str, str],
    order_col,
    splits,
    path: str,
    deduplicate: str | None = None,
    fmt: str = "json",
    if_exists: str = "skip",
    only_mapped: bool = False,
) -> Written:
    """Clean the splits that are not written yet and write them. Returns the splits written.

    Their ``counts`` (rows in, dropped by reason, out) are taken on the way and kept in the manifest.
    With ``only_mapped`` the files have just the two sides, one pair after the other in dataset order.
    """
    todo = pending_splits(df.sparkSession, path, splits, if_exists)
    if not todo:
        return Written()
    with temporary_tables(df.sparkSession):
        counts = PrepCounts(todo)
        raw = df.filter(df[SPLIT].isin(*todo))
        clean = clean_pairs(raw, column_map, order_col, deduplicate, counts)
        if only_mapped:
            clean = in_order(clean, order_col, PAIR_COLUMNS)
        written = write_prepared(counts.rows_out(clean), path, todo, fmt, if_exists, counts.by_split)
        return Written(written, counts.by_split())


def assemble_pairs(
    df: DataFrame,
    order_col,
    seed: int = DEFAULT_SEED,
    shuffle: bool = True,
    limit: int = -1,
    eval_ratio: float = DEFAULT_EVAL_RATIO,
    place: bool = True,
) -> DataFrame:
    """Limited and split pairs; in shuffled order if ``shuffle``.

    With ``place`` off the order is left to ``batch_pairs``, which lays out the tokens by the seed.
    """
    split = limit_and_split(df, limit, eval_ratio, seed, order_col, shuffle)
    return seeded_shuffle(split, seed, order_col) if shuffle and place else split


def preference_dataset(
    raw: DataFrame,
    order_col,
    splits,
    path: str,
    column_map: Mapping[str, str] = DEFAULT_COLUMN_MAP,
    deduplicate: str | None = None,
    seed: int = DEFAULT_SEED,
    shuffle: bool = True,
    limit: int = -1,
    eval_ratio: float = DEFAULT_EVAL_RATIO,
    fmt: str = "json",
    if_exists: str = "skip",
    place: bool = True,
) -> DataFrame:
    """Raw splits to train and eval pairs: prepare what is not written yet, read back, assemble."""
    prepare_pairs(raw, column_map, order_col, splits, path, deduplicate, fmt, if_exists)
    texts = T.StructType([T.StructField(name, T.StringType()) for name in PAIR_COLUMNS])
    order = [raw.schema[name] for name in names(order_col)]
    prepared = read_prepared(raw.sparkSession, path, T.StructType([*order, *texts]), fmt)
    return assemble_pairs(
        prepared.filter(prepared[SPLIT].isin(*splits)),
        order_col, seed, shuffle, limit, eval_ratio, place,
    )


def truncate_texts(
    pairs: DataFrame,
    encoder: Encoder,
    order_col,
    marker: str | None = None,
    max_prompt: int = DEFAULT_MAX_PROMPT,
    max_len: int = DEFAULT_MAX_TOKENS,
) -> DataFrame:
    """Pairs as token ids: common prompt split off, tokenised, cut to length."""
    parts = split_common_prompt(pairs, marker)
    texts = ["prompt", *PAIR_COLUMNS]
    return truncate_pair(encode_columns(parts, texts, encoder, order_col), max_prompt, max_len)


def batch_pairs(
    pairs: DataFrame,
    encoder: Encoder,
    order_col,
    pad_id: int,
    batch_size: int = DEFAULT_BATCH_SIZE,
    seed: int | None = None,
    marker: str | None = None,
    max_prompt: int = DEFAULT_MAX_PROMPT,
    max_len: int = DEFAULT_MAX_TOKENS,
    mask_padding: bool = True,
) -> DataFrame:
    """Pairs of texts to padded batches of both sides, in the shuffled order of a ``seed`` if given.

    The tokens are stored once; texts are not shuffled.
    """
    tokens = truncate_texts(pairs, encoder, order_col, marker, max_prompt, max_len)
    stored = materialize(tokens, "pair-tokens")
    return collate_pairs(stored, batch_size, pad_id, order_col, seed, mask_padding)


def score_pairs(
    pairs: DataFrame,
    cache: DataFrame | None = None,
    dataset_id: str | None = None,
    beta: float = DEFAULT_BETA,
    label_smoothing: float = DEFAULT_LABEL_SMOOTHING,
) -> DataFrame:
    """Loss per pair; against stored reference scores, or reference-free without a cache."""
    if cache is None:
        return dpo_loss(pairs, beta, label_smoothing, ref_chosen=None, ref_rejected=None)
    return dpo_loss(lookup_reference(pairs, cache, dataset_id), beta, label_smoothing)
