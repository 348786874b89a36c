"""Token and sequence log-probabilities, reference scores and the pair loss."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneprep.functions.scores import (
    log_softmax_at,
    pair_loss,
    record_logp,
    record_logps,
    scored,
)
from tuneprep.runtime import column, names
from tuneprep.sources.bucketed import write_bucketed
from tuneprep.sources.prepared import partition_folder, write_once

# Width of the exponent bands of the streaming log-sum-exp: exp() of a band stays far inside the
# range of a double.
_BAND = 256


def shift_labels(labels: DataFrame) -> DataFrame:
    """Labels moved one position back, so that they meet the logits that predict them."""
    return labels.filter(F.col("pos") > 0).select(
        "seq_id", (F.col("pos") - 1).alias("pos"), "label"
    )


def _score_dense(logits: DataFrame, labels: DataFrame, how: str) -> DataFrame:
    joined = logits.join(shift_labels(labels), ["seq_id", "pos"], how)
    return joined.select(
        "seq_id",
        "pos",
        "label",
        scored(log_softmax_at(F.col("logits"), F.col("label")), F.col("label")).alias("logp"),
    )


def token_logprobs(logits: DataFrame, labels: DataFrame) -> DataFrame:
    """``seq_id, pos, label, logp`` from one array of logits per position.

    The logits at ``pos`` score the label at ``pos + 1``; the last logits and the first label have
    no partner. An ignored label scores 0.0. The softmax is an expression on the row: the only
    shuffle is the equi-join with the labels, and none where both tables are bucketed by sequence.
    """
    return _score_dense(logits, labels, "inner")


def token_logprobs_long(logits: DataFrame, labels: DataFrame) -> DataFrame:
    """As ``token_logprobs``, from one row ``seq_id, pos, token_id, logit`` per vocabulary entry.

    One pass and at most one shuffle: once the labels are joined, both aggregations reuse the
    partitioning. The log-sum-exp keeps its sums per exponent band, so they cannot overflow and
    fold map-side, where a maximum first and a sum second would read the logits twice. An entry of
    -inf has probability 0 and adds nothing; a position with +inf or NaN, or with nothing but -inf,
    scores NaN, as the softmax is undefined there.
    """
    logit = F.col("logit").cast("double")
    finite = ~F.isnan(logit) & (F.abs(logit) < F.lit(float("inf")))
    band = F.floor(F.when(finite, logit) / _BAND)
    undefined = F.isnan(logit) | (logit == F.lit(float("inf")))
    top = F.col("_tp_top").cast("double")
    total = F.aggregate(
        "_tp_bands",
        F.lit(0.0),
        lambda acc, b: acc + b["_tp_sum"] * F.exp((b["_tp_band"] - top) * _BAND),
    )
    return (
        logits.join(shift_labels(labels), ["seq_id", "pos"])
        .withColumn("_tp_band", band)
        .groupBy("seq_id", "pos", "label", "_tp_band")
        .agg(
            F.sum(F.exp(logit - F.col("_tp_band") * _BAND)).alias("_tp_sum"),
            F.max(undefined).alias("_tp_undefined"),
            F.max(F.when(F.col("token_id") == F.col("label"), F.col("logit"))).alias("_tp_picked"),
        )
        .groupBy("seq_id", "pos", "label")
        .agg(
            F.max("_tp_picked").alias("_tp_picked"),
            F.max("_tp_band").alias("_tp_top"),
            F.max("_tp_undefined").alias("_tp_undefined"),
            # One entry per band in use: a handful, whatever the vocabulary.
            F.collect_list(
                F.when(
                    F.col("_tp_band").isNotNull(),
                    F.struct(F.col("_tp_band").cast("double").alias("_tp_band"), "_tp_sum"),
                )
            ).alias("_tp_bands"),
        )
        .select(
            "seq_id",
            "pos",
            "label",
            scored(
                F.when(F.col("_tp_picked").isNull(), F.lit(None))
                .when(F.col("_tp_undefined") | top.isNull(), F.lit(float("nan")))
                .otherwise(F.col("_tp_picked") - top * _BAND - F.log(total)),
                F.col("label"),
            ).alias("logp"),
        )
    )


def sequence_logprob(logits: DataFrame, labels: DataFrame) -> DataFrame:
    """``seq_id, logp``: the sum over scored positions; 0.0 for a sequence that has none."""
    return _score_dense(logits, labels, "left").groupBy("seq_id").agg(F.sum("logp").alias("logp"))


def record_logprobs(
    df: DataFrame, logits: str = "logits", labels: str = "labels", out_col: str = "logps"
) -> DataFrame:
    """Add the token scores of records that hold their logits and labels together.

    A projection: records stay where they are, nothing is joined or shuffled. See ``record_logps``.
    """
    return df.withColumn(out_col, record_logps(column(logits), column(labels)))


def score_records(df: DataFrame, sides=("",), keep: bool = False) -> DataFrame:
    """Add ``logp`` from ``logits`` and ``labels``, or ``logp_<side>`` from ``logits_<side>`` ....

    With ``sides=("chosen", "rejected")`` a batch of pairs with the model's outputs becomes what
    ``dpo_loss`` takes, without a shuffle. Logits and labels are dropped unless ``keep``.
    """
    ends = [f"_{side}" if side else "" for side in sides]
    used = [f"{name}{end}" for end in ends for name in ("logits", "labels")]
    scores = {
        f"logp{end}": record_logp(column(f"logits{end}"), column(f"labels{end}")) for end in ends
    }
    out = df.withColumns(scores)
    return out if keep else out.drop(*used)


def reference_scores(token_scores: DataFrame, dataset_id: str) -> DataFrame:
    """Both sides' sequence scores per pair, from rows ``idx, side, logp`` (one per token or more).

    ``side`` is ``chosen`` or ``rejected``. One aggregation with map-side sums.
    """

    def side(name):
        return F.sum(F.when(F.col("side") == name, F.col("logp"))).alias(f"ref_logp_{name}")

    return (
        token_scores.groupBy("idx")
        .agg(side("chosen"), side("rejected"))
        .select(F.lit(dataset_id).alias("dataset_id"), "idx", "ref_logp_chosen", "ref_logp_rejected")
    )


REFERENCE_SCHEMA = (
    "dataset_id string, idx bigint, ref_logp_chosen double, ref_logp_rejected double"
)


def precompute_reference(
    token_scores: DataFrame, dataset_id: str, path: str, if_exists: str = "skip"
) -> DataFrame:
    """Compute the reference scores of a data set once, keep them under ``path``, read them back.

    Each data set has its own folder, so a second one never reuses the scores of the first.
    """
    scores = reference_scores(token_scores, dataset_id).select(
        F.col("idx").cast("bigint"), "ref_logp_chosen", "ref_logp_rejected"
    )
    folder = partition_folder(scores.sparkSession, path, "dataset_id", dataset_id)
    write_once(scores, folder, "parquet", if_exists)
    return token_scores.sparkSession.read.schema(REFERENCE_SCHEMA).parquet(path)


def lookup_reference(pairs: DataFrame, cache: DataFrame, dataset_id: str) -> DataFrame:
    """Add the stored reference scores by ``idx``; a pair without both of them is an error.

    A side whose own ``logp_<side>`` is null, such as that of a last pair left without a partner,
    needs no reference: its score may be null, as its loss is. Catalyst picks the join from the sizes
    it measures: broadcast for a small cache, else a merge.
    """
    stored = cache.filter(F.col("dataset_id") == dataset_id).select(
        "idx",
        F.lit(True).alias("_tp_stored"),
        F.col("ref_logp_chosen").alias("_tp_chosen"),
        F.col("ref_logp_rejected").alias("_tp_rejected"),
    )

    def found(side):
        message = F.concat(F.lit("no reference score for idx "), F.col("idx").cast("string"))
        wrong = F.raise_error(message).cast("double")
        score, own = F.col(f"_tp_{side}"), f"logp_{side}"
        if own not in pairs.columns:
            return F.coalesce(score, wrong)
        unscored = F.col("_tp_stored").isNotNull() & column(own).isNull()
        return F.when(score.isNull() & ~unscored, wrong).otherwise(score)

    return pairs.join(stored, "idx", "left").select(
        *[column(c) for c in pairs.columns],
        found("chosen").alias("ref_logp_chosen"),
        found("rejected").alias("ref_logp_rejected"),
    )


def bucketed_reference(
    token_scores: DataFrame,
    dataset_id: str,
    path: str,
    table: str,
    buckets: int,
    if_exists: str = "skip",
) -> DataFrame:
    """``precompute_reference`` into a table bucketed by ``idx``, for look-ups that shuffle nothing.

    Pairs, or token scores to be summed again, that ``write_bucketed`` stored with the same key and
    number of buckets meet it bucket by bucket: neither side moves, whatever its size, and the cache
    need not fit a broadcast. Every data set has a table of its own.
    """
    folder = partition_folder(token_scores.sparkSession, path, "dataset_id", dataset_id)
    scores = reference_scores(token_scores, dataset_id).select(
        "dataset_id", F.col("idx").cast("bigint"), "ref_logp_chosen", "ref_logp_rejected"
    )
    return write_bucketed(scores, folder, table, "idx", buckets, if_exists)


def dpo_loss(
    df: DataFrame,
    beta: float = 0.1,
    label_smoothing: float = 0.0,
    ref_chosen: str | None = "ref_logp_chosen",
    ref_rejected: str | None = "ref_logp_rejected",
) -> DataFrame:
    """Add ``loss`` per pair. A reference column given as None counts as 0."""
    return df.withColumn(
        "loss",
        pair_loss(
            F.col("logp_chosen"),
            F.col("logp_rejected"),
            None if ref_chosen is None else column(ref_chosen),
            None if ref_rejected is None else column(ref_rejected),
            beta,
            label_smoothing,
        ),
    )


def mean_dpo_loss(df: DataFrame, by=()) -> DataFrame:
    return df.groupBy(*[column(c) for c in names(by)]).agg(F.avg("loss").alias("mean_loss"))
