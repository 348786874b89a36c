"""Numerically stable score expressions over double columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tuneprep.functions.binding import bind
from tuneprep.functions.sequences import IGNORE_LABEL


def log_sigmoid(x: Column) -> Column:
    return -(F.greatest(-x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x))))


def pair_loss(
    logp_chosen: Column,
    logp_rejected: Column,
    ref_logp_chosen: Column | None = None,
    ref_logp_rejected: Column | None = None,
    beta: float = 0.1,
    label_smoothing: float = 0.0,
) -> Column:
    """Preference loss of one pair; a reference side that is not supplied counts as 0."""
    ref_chosen = F.lit(0.0) if ref_logp_chosen is None else ref_logp_chosen
    ref_rejected = F.lit(0.0) if ref_logp_rejected is None else ref_logp_rejected
    margin = F.lit(float(beta)) * ((logp_chosen - logp_rejected) - (ref_chosen - ref_rejected))
    eps = float(label_smoothing)
    return -F.lit(1.0 - eps) * log_sigmoid(margin) - F.lit(eps) * log_sigmoid(-margin)


def log_softmax_at(logits: Column, index: Column) -> Column:
    """Log-softmax of an array of logits, read at one 0-based index; null outside the array."""
    values = logits.cast("array<double>")

    def normalized(get):
        total = F.aggregate(
            get("values"), F.lit(0.0), lambda acc, x: acc + F.exp(x - get("peak"))
        )
        return F.get(get("values"), index) - get("peak") - F.log(total)

    return bind({"values": values, "peak": F.array_max(values)}, normalized)


def scored(logp: Column, label: Column) -> Column:
    """0.0 for an ignored or absent label; a label that has no log-probability is an error."""
    message = F.concat(F.lit("label outside the vocabulary: "), label.cast("string"))
    return F.when(F.coalesce(label, F.lit(IGNORE_LABEL)) == IGNORE_LABEL, 0.0).otherwise(
        F.coalesce(logp, F.raise_error(message).cast("double"))
    )


def _over_record(logits: Column, labels: Column, body) -> Column:
    """``body(positions, score)`` for one record; ``score(t)`` is the log-probability of label t + 1."""

    def run(get):
        n = F.size(get("logits"))
        same = F.when(n == F.size(get("labels")), n).otherwise(
            F.raise_error(F.lit("a record needs one label for each position of its logits")).cast("int")
        )
        # sequence(0, -1) would count down.
        positions = F.when(same > 1, F.sequence(F.lit(0), same - 2)).otherwise(F.array().cast("array<int>"))

        def score(t):
            label = F.get(get("labels"), t + 1)
            return scored(log_softmax_at(F.get(get("logits"), t), label), label)

        return body(positions, score)

    bound = bind({"logits": logits, "labels": labels}, run)
    return F.when(logits.isNotNull() & labels.isNotNull(), bound)


def record_logps(logits: Column, labels: Column) -> Column:
    """Log-probability of every following label of one record: an array one shorter than the labels.

    ``logits`` has an array of logits per position, ``labels`` one label per position. The logits at
    t score the label at t + 1; ignored and null labels score 0.0 and their softmax is not computed.
    One position is normalised at a time and nothing but its score is kept. An entry of -inf has
    probability 0; a position with NaN or +inf, or with nothing but -inf, scores NaN. Fewer than two
    positions give an empty array; null logits or labels give null.
    """
    return _over_record(logits, labels, lambda positions, score: F.transform(positions, score))


def record_logp(logits: Column, labels: Column) -> Column:
    """Sum of ``record_logps``, without building the array; 0.0 if nothing is scored."""
    return _over_record(
        logits,
        labels,
        lambda positions, score: F.aggregate(positions, F.lit(0.0), lambda acc, t: acc + score(t)),
    )


def shifted_sum(logps: Column, labels: Column) -> Column:
    """Sum of gathered log-probabilities where the *next* label counts; 0.0 if none does.

    ``logps[t]`` scores ``labels[t + 1]``; the last score and the first label have no partner.
    """
    following = F.slice(labels, F.lit(2), F.greatest(F.size(labels) - 1, F.lit(0)))
    counted = F.zip_with(
        logps.cast("array<double>"),
        following,
        lambda lp, label: F.when(
            F.coalesce(label, F.lit(IGNORE_LABEL)) != IGNORE_LABEL, lp
        ).otherwise(0.0),
    )
    return F.aggregate(counted, F.lit(0.0), lambda acc, x: acc + x)
