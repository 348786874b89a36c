"""Vocabulary and token ids."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tuneprep.functions.binding import bind
from tuneprep.functions.sequences import attention_mask, keep_first
from tuneprep.operators.indexing import index_keys
from tuneprep.operators.mapping import carried_columns
from tuneprep.runtime import column, materialize, prepare_workers

# Reserved ids 0..3, in this order.
SPECIAL_TOKENS = ("<pad>", "<unk>", "<bos>", "<eos>")
PAD_ID, UNK_ID, BOS_ID, EOS_ID = range(4)

# A vocabulary that travels to every worker is limited and checked; larger ones are joined.
MAX_VOCABULARY = 1_000_000

# Text that a worker splits at a time: the words and their places take several times as much.
_BLOCK_BYTES = 1 << 22

Encoder = Callable[[pa.Array], pa.Array]


def _split(texts: pa.Array) -> pa.Array:
    """Words of each text. Arrow's whitespace is that of Python; an empty text has one empty word."""
    return pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.fill_null(texts, "")))


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and number of rows of stretches with about ``_BLOCK_BYTES`` of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + _BLOCK_BYTES, "right")))
        yield start, end - start
        start = end


def _cut(batches: Iterator[pa.RecordBatch], place: int = -1) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of a bounded size of the text column at ``place``."""
    for batch in batches:
        for start, n in _blocks(batch.column(place % batch.num_columns)):
            yield batch.slice(start, n)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _cut(batches):
        counted = pc.value_counts(pc.list_flatten(_split(batch.column(0))))
        yield pa.RecordBatch.from_arrays(
            [counted.field("values"), counted.field("counts")], ["token", "n"]
        )


def _token_counts(df: DataFrame, text_col: str) -> DataFrame:
    return (
        df.select(column(text_col))
        .mapInArrow(_count_words, "token string, n bigint")
        .filter(~F.col("token").isin("", *SPECIAL_TOKENS))
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
    )


def _with_reserved(ranked: DataFrame) -> DataFrame:
    entries = [
        F.struct(F.lit(token).alias("token"), F.lit(i).alias("token_id"), F.lit(0).cast("bigint").alias("n"))
        for i, token in enumerate(SPECIAL_TOKENS)
    ]
    reserved = ranked.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*entries)))
    return reserved.union(ranked)


def build_vocab(df: DataFrame, text_col: str, size: int) -> DataFrame:
    """``token, token_id, n`` of the ``size`` most frequent tokens, after the reserved ones.

    Tokens are runs of non-whitespace, ranked by (count descending, token ascending). Words are
    split and counted per Arrow batch, three times as fast as exploding them in the JVM; Spark folds
    those counts map-side and sums them per token.
    """
    if not 0 < size <= MAX_VOCABULARY:
        raise ValueError(f"size must be in 1..{MAX_VOCABULARY}, got {size}")
    prepare_workers(df.sparkSession)
    top = _token_counts(df, text_col).orderBy(F.desc("n"), "token").limit(size)
    # At most ``size`` rows are left to number.
    by_rank = Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "token")
    ranked = top.select(
        "token", (F.row_number().over(by_rank) + len(SPECIAL_TOKENS) - 1).alias("token_id"), "n"
    )
    return _with_reserved(ranked)


def full_vocab(df: DataFrame, text_col: str) -> DataFrame:
    """``build_vocab`` of every token that occurs, however many there are, stored.

    The ranks come from a distributed sort of the counts, not from one task. For ``encode_by_join``.
    """
    prepare_workers(df.sparkSession)
    counts = _token_counts(df, text_col).withColumn("_tp_less", -F.col("n"))
    ranked = index_keys(counts, ["_tp_less", "token"], index_col="token_id").select(
        "token",
        (F.col("token_id") + len(SPECIAL_TOKENS)).cast("int").alias("token_id"),
        (-F.col("_tp_less")).alias("n"),
    )
    return _with_reserved(ranked)


class WordEncoder:
    """Whitespace tokens looked up in a vocabulary; unknown ones become ``<unk>``."""

    def __init__(self, vocab: DataFrame):
        entries = vocab.select("token", "token_id").limit(MAX_VOCABULARY + 5).collect()
        if len(entries) > MAX_VOCABULARY + len(SPECIAL_TOKENS):
            raise ValueError(f"the vocabulary has more than {MAX_VOCABULARY} tokens")
        table = (
            pa.array([e["token"] for e in entries], pa.string()),
            pa.array([e["token_id"] for e in entries], pa.int32()),
        )
        self._table = vocab.sparkSession.sparkContext.broadcast(table)

    def __call__(self, texts: pa.Array) -> pa.Array:
        tokens, token_ids = self._table.value
        words = _split(texts)
        flat = pc.list_flatten(words)
        real = pc.not_equal(flat, "")
        # Only a text without any token has an empty word, and just that one.
        first = pc.list_element(words, 0) if len(words) else pa.array([], pa.string())
        counts = pc.if_else(pc.equal(first, ""), 0, pc.list_value_length(words))
        flat = flat.filter(real)
        found = pc.take(token_ids, pc.index_in(flat, value_set=tokens))
        ends = pc.cumulative_sum(pc.cast(counts, pa.int32()))
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
        return pa.ListArray.from_arrays(offsets, pc.fill_null(found, UNK_ID))


def _token_ids(df: DataFrame, encoder: Encoder):
    prepare_workers(df.sparkSession)

    @F.arrow_udf("array<int>")
    def token_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [encoder(texts.slice(start, n)) for start, n in _blocks(texts)]
            yield pa.concat_arrays(parts) if parts else encoder(texts)

    return token_ids


def encode(
    df: DataFrame,
    text_col: str,
    encoder: Encoder,
    max_len: int,
    order_col,
    bos_id: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Token ids cut to ``max_len`` and a mask of ones, next to the row identity and ``keep``.

    The whole text is tokenised, then cut. Texts cross to Python in Arrow batches; the cut and the
    mask stay in the JVM.
    """

    ids = _token_ids(df, encoder)(column(text_col))
    if bos_id is not None:
        ids = F.concat(F.array(F.lit(bos_id)), ids)
    return (
        df.select(
            *[column(c) for c in [*carried_columns(df, order_col), *keep]],
            ids.alias("input_ids"),
        )
        .withColumn("input_ids", keep_first(F.col("input_ids"), max_len))
        .withColumn("attention_mask", attention_mask(F.col("input_ids")))
    )


def _packer(identity: list[str], most: int):
    """Rows of an Arrow batch as numbers within it, and one row with the batch's distinct words."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches):
            words = _split(batch.column(batch.num_columns - 1))
            flat = pc.list_flatten(words)
            first = pc.list_element(words, 0)
            counts = pc.if_else(pc.equal(first, ""), 0, pc.list_value_length(words))
            coded = flat.filter(pc.not_equal(flat, "")).dictionary_encode()
            offsets = pa.concat_arrays(
                [pa.array([0], pa.int32()), pc.cumulative_sum(pc.cast(counts, pa.int32()))]
            )
            local = pc.list_slice(pa.ListArray.from_arrays(offsets, coded.indices), 0, most)
            n, listed = batch.num_rows, pa.array([coded.dictionary.to_pylist()], pa.list_(pa.string()))
            columns = [
                pa.concat_arrays([column_, pa.nulls(1, column_.type)])
                for column_ in batch.columns[: len(identity)]
            ]
            columns += [
                pa.array([uuid.uuid4().hex] * (n + 1), pa.string()),
                pa.concat_arrays([local.cast(pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int32()))]),
                pa.concat_arrays([pa.nulls(n, listed.type), listed]),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*identity, "_tp_batch", "_tp_local", "_tp_words"])

    return pack


def encode_by_join(
    df: DataFrame,
    text_col: str,
    vocab: DataFrame,
    max_len: int,
    order_col,
    bos_id: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``encode`` with a vocabulary of any size: it is looked up by a join, not sent to the workers.

    One pass over the texts numbers the words of each Arrow batch and stores the numbers next to one
    list of distinct words per batch. The words of all lists are joined with the vocabulary on the
    word, where a frequent word has one row for each batch and not for each time it occurs. The ids
    go back to their batch and are put in place of its numbers. What is shuffled is distinct words
    and, once, the cut token arrays. Unknown words are ``<unk>``; a word that the vocabulary lists
    twice is an error.
    """
    prepare_workers(df.sparkSession)
    identity = [*carried_columns(df, order_col), *keep]
    room = max(0, max_len - (0 if bos_id is None else 1))
    source = df.select(*[column(c) for c in identity], column(text_col).cast("string").alias("_tp_text"))
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in source.schema if f.name != "_tp_text"]
        + [
            T.StructField("_tp_batch", T.StringType()),
            T.StructField("_tp_local", T.ArrayType(T.IntegerType())),
            T.StructField("_tp_words", T.ArrayType(T.StringType())),
        ]
    )
    packed = materialize(source.mapInArrow(_packer(identity, max(1, room)), schema), "packed-words")
    asked = packed.filter(F.col("_tp_words").isNotNull()).select(
        "_tp_batch", F.posexplode("_tp_words").alias("_tp_at", "token")
    )
    found = asked.join(vocab.select("token", "token_id"), "token", "left").select(
        "_tp_batch", F.struct("_tp_at", F.coalesce("token_id", F.lit(UNK_ID)).cast("int").alias("id")).alias("hit")
    )
    # As many entries as a batch has distinct words.
    listed = found.groupBy("_tp_batch").agg(
        F.sort_array(F.collect_list("hit")).alias("hits"), F.max("hit._tp_at").alias("last")
    )
    once = F.when(F.size("hits") == F.col("last") + 1, F.col("hits.id")).otherwise(
        F.raise_error(F.lit("the vocabulary lists a token twice")).cast("array<int>")
    )
    answers = listed.select("_tp_batch", once.alias("_tp_ids"))
    rows = packed.filter(F.col("_tp_local").isNotNull()).join(answers, "_tp_batch", "left")
    ids = bind(
        {"local": F.col("_tp_local"), "ids": F.col("_tp_ids")},
        lambda get: F.transform(get("local"), lambda i: F.get(get("ids"), i)),
    )
    if room == 0:
        ids = F.array().cast("array<int>")
    if bos_id is not None:
        ids = F.concat(F.array(F.lit(bos_id)), ids)
    return rows.select(
        *[column(c) for c in identity], keep_first(ids, max_len).alias("input_ids")
    ).withColumn("attention_mask", attention_mask(F.col("input_ids")))


def encode_columns(df: DataFrame, text_cols, encoder: Encoder, order_col) -> DataFrame:
    """``<name>_ids`` for several text columns of a row, uncut, next to the row identity."""
    token_ids = _token_ids(df, encoder)
    return df.select(
        *[column(c) for c in carried_columns(df, order_col)],
        *[token_ids(column(name)).alias(f"{name}_ids") for name in text_cols],
    )


def encode_literal(encoder: Encoder, text: str) -> list[int]:
    """Ids of one driver-side string, such as the tag that opens a completion."""
    return encoder(pa.array([text], pa.string()))[0].as_py()


def resolve_special_ids(pad: int | None, eos: int | None) -> tuple[int, int | None]:
    """(pad, eos), where a missing pad id is the eos id."""
    if pad is None and eos is None:
        raise ValueError("neither a pad nor an eos id is defined")
    return (eos if pad is None else pad), eos


