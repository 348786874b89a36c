import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tuneprep.functions import scores
from tuneprep.operators import metrics, scoring
from tuneprep.plans import preference

IGNORE = -100


def log_softmax(x):
    x = np.asarray(x, dtype=float)
    peak = x.max()
    return x - peak - math.log(np.exp(x - peak).sum())


@pytest.fixture(scope="module")
def batch():
    rng = np.random.default_rng(4)
    data = {}
    for s, length in enumerate([1, 2, 5, 8, 3]):
        logits = rng.normal(size=(length, 11)) * 5
        labels = rng.integers(0, 11, size=length)
        data[s] = (logits, labels)
    data[2][1][:] = IGNORE
    data[3][1][2:4] = IGNORE
    data[3][0][0] = np.linspace(-1000, 1000, 11)
    data[3][0][5] = -1000.0
    return data


@pytest.fixture(scope="module")
def frames(spark, batch):
    logits = spark.createDataFrame(
        [(s, t, [float(v) for v in x]) for s, (m, _) in batch.items() for t, x in enumerate(m)],
        "seq_id bigint, pos int, logits array<double>",
    )
    labels = spark.createDataFrame(
        [(s, t, int(y)) for s, (_, l) in batch.items() for t, y in enumerate(l)],
        "seq_id bigint, pos int, label int",
    )
    return logits, labels


def expected_tokens(batch):
    return {
        (s, t): 0.0 if labels[t + 1] == IGNORE else log_softmax(logits[t])[labels[t + 1]]
        for s, (logits, labels) in batch.items()
        for t in range(len(labels) - 1)
    }


def test_token_logprobs(batch, frames):
    logits, labels = frames
    wanted = expected_tokens(batch)
    long = logits.select("seq_id", "pos", F.posexplode("logits").alias("token_id", "logit"))
    for out in (
        scoring.token_logprobs(logits, labels),
        scoring.token_logprobs_long(long, labels),
    ):
        got = {(r["seq_id"], r["pos"]): r["logp"] for r in out.collect()}
        assert got.keys() == wanted.keys()
        assert all(math.isclose(got[k], wanted[k], abs_tol=1e-9) for k in wanted)


def test_sequence_logprob_sums_and_keeps_empty_sequences(batch, frames):
    wanted = {s: 0.0 for s in batch}
    for (s, _), value in expected_tokens(batch).items():
        wanted[s] += value
    got = {r["seq_id"]: r["logp"] for r in scoring.sequence_logprob(*frames).collect()}
    assert got.keys() == wanted.keys() and got[0] == 0.0 and got[2] == 0.0
    assert all(math.isclose(got[s], wanted[s], abs_tol=1e-9) for s in wanted)


def test_array_form(spark, batch):
    rows = [
        (s, [float(log_softmax(x)[max(y, 0)]) for x, y in zip(m, [*l[1:], 0])], [int(y) for y in l])
        for s, (m, l) in batch.items()
    ]
    rows.append((9, [], []))
    df = spark.createDataFrame(rows, "s int, lp array<double>, y array<int>")
    out = df.select("s", scores.shifted_sum(F.col("lp"), F.col("y")).alias("v")).collect()
    for r in out:
        keys = [k for k in expected_tokens(batch) if k[0] == r["s"]]
        assert math.isclose(r["v"], sum(expected_tokens(batch)[k] for k in keys), abs_tol=1e-9)


def test_label_outside_the_vocabulary_is_an_error(spark, frames):
    logits, labels = frames
    wrong = labels.withColumn("label", F.lit(11))
    with pytest.raises(Exception, match="outside the vocabulary"):
        scoring.token_logprobs(logits, wrong).collect()


def loss(delta, beta, eps):
    def log_sigmoid(x):
        return -(max(-x, 0.0) + math.log1p(math.exp(-abs(x))))

    return -(1 - eps) * log_sigmoid(beta * delta) - eps * log_sigmoid(-beta * delta)


@pytest.mark.parametrize("beta,eps", [(0.1, 0.0), (0.5, 0.2), (1.0, 0.5)])
def test_pair_loss(spark, beta, eps):
    rng = random.Random(1)
    rows = [tuple(rng.uniform(-50, 50) for _ in range(4)) for _ in range(50)]
    rows += [(1000.0, -1000.0, 0.0, 0.0), (-1000.0, 1000.0, 0.0, 0.0), (0.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(
        rows, "logp_chosen double, logp_rejected double, ref_logp_chosen double, ref_logp_rejected double"
    )
    cases = {
        (True, True): lambda c, r, x, y: (c - r) - (x - y),
        (False, False): lambda c, r, x, y: c - r,
        (True, False): lambda c, r, x, y: (c - r) - x,
        (False, True): lambda c, r, x, y: (c - r) + y,
    }
    for (chosen, rejected), delta in cases.items():
        out = scoring.dpo_loss(
            df, beta, eps,
            "ref_logp_chosen" if chosen else None, "ref_logp_rejected" if rejected else None,
        ).collect()
        for r, row in zip(out, rows):
            assert math.isclose(r["loss"], loss(delta(*row), beta, eps), rel_tol=1e-9, abs_tol=1e-12)
    mean = scoring.mean_dpo_loss(scoring.dpo_loss(df, beta, eps)).first()["mean_loss"]
    whole = [loss(cases[True, True](*row), beta, eps) for row in rows]
    assert math.isclose(mean, sum(whole) / len(whole), rel_tol=1e-9)


@pytest.fixture
def cache(spark, tmp_path):
    # A third of all scores belongs to one pair.
    rows = [(i, s, float(-i - (s == "rejected"))) for i in range(5) for s in ("chosen", "rejected")]
    rows += [(2, "chosen", -0.5)] * 10
    scores_a = spark.createDataFrame(rows, "idx bigint, side string, logp double")
    scores_b = scores_a.withColumn("logp", F.lit(-100.0))
    path = str(tmp_path / "reference")
    scoring.precompute_reference(scores_a, "a", path)
    return scoring.precompute_reference(scores_b, "b", path), scores_b, path


def test_reference_scores_are_kept_per_dataset(spark, cache):
    stored, other, path = cache
    pairs = spark.createDataFrame([(2, 1.0), (4, 2.0)], "idx bigint, logp_chosen double")
    out = scoring.lookup_reference(pairs, stored, "a").orderBy("idx").collect()
    assert [(r["ref_logp_chosen"], r["ref_logp_rejected"]) for r in out] == [(-7.0, -3.0), (-4.0, -5.0)]
    assert scoring.lookup_reference(pairs, stored, "b").first()["ref_logp_rejected"] == -100.0
    again = scoring.precompute_reference(other, "a", path)
    assert again.filter("dataset_id = 'a' AND idx = 4").first()["ref_logp_chosen"] == -4.0


def test_missing_reference_is_an_error(spark, cache):
    stored, _, _ = cache
    pairs = spark.createDataFrame([(0, 0.0), (77, 0.0)], "idx bigint, logp_chosen double")
    with pytest.raises(Exception, match="no reference score for idx 77"):
        scoring.lookup_reference(pairs, stored, "a").collect()
    with pytest.raises(Exception, match="no reference score"):
        scoring.lookup_reference(pairs, stored, "unknown").collect()
    one_sided = stored.withColumn("ref_logp_rejected", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="no reference score"):
        scoring.lookup_reference(pairs.limit(1), one_sided, "a").collect()


def test_a_side_without_a_score_needs_no_reference(spark, tmp_path):
    """An odd number of sequences leaves the last pair with its chosen side only."""
    sides = spark.createDataFrame(
        [(0, "chosen", -1.0), (0, "rejected", -2.0), (1, "chosen", -3.0)], "idx bigint, side string, logp double"
    )
    cache = scoring.precompute_reference(sides, "odd", str(tmp_path / "odd"))
    schema = "idx bigint, logp_chosen double, logp_rejected double"
    pairs = spark.createDataFrame([(0, -1.5, -2.5), (1, -3.5, None)], schema)
    found = scoring.lookup_reference(pairs, cache, "odd")
    assert sorted(tuple(r)[3:] for r in found.collect()) == [(-3.0, None), (-1.0, -2.0)]
    losses = {r["idx"]: r["loss"] for r in scoring.dpo_loss(found).collect()}
    assert losses[1] is None and math.isclose(losses[0], loss(0.0, 0.1, 0.0))
    assert math.isclose(scoring.mean_dpo_loss(scoring.dpo_loss(found)).first()["mean_loss"], losses[0])
    for rows in ([(1, -3.5, -4.5)], [(2, None, None)]):  # a score that is needed; a pair that is not stored
        with pytest.raises(Exception, match="no reference score"):
            scoring.lookup_reference(spark.createDataFrame(rows, schema), cache, "odd").collect()


def test_score_pairs(spark, cache):
    stored, _, _ = cache
    pairs = spark.createDataFrame([(1, -3.0, -4.0)], "idx bigint, logp_chosen double, logp_rejected double")
    free = preference.score_pairs(pairs).first()["loss"]
    against = preference.score_pairs(pairs, stored, "a").first()["loss"]
    assert math.isclose(free, loss(1.0, 0.1, 0.0)) and math.isclose(against, loss(0.0, 0.1, 0.0))


def test_perplexity(spark):
    rows = [("a", 19.0, 1), ("a", 20.998, 1), ("b", 20.0, 1), ("c", 21.0, 2), ("d", 1.0, 3), ("d", 2.0, 1)]
    df = spark.createDataFrame(rows, "g string, loss double, n int")
    got = {r["g"]: r["perplexity"] for r in metrics.perplexity(df, "loss", "g").collect()}
    assert math.isclose(got["a"], math.exp(19.999), rel_tol=1e-9)
    assert got["b"] == got["c"] == float("inf")
    assert math.isclose(got["d"], math.exp(1.5))
    weighted = metrics.perplexity(df.filter("g = 'd'"), "loss", weight_col="n").first()
    assert math.isclose(weighted["perplexity"], math.exp(1.25))
    assert metrics.perplexity(df.limit(0), "loss").first()["perplexity"] is None


def test_prep_report_adds_up(spark):
    rows = [
        ("t", "a", "b"), ("t", "a ", "c"), ("t", "x", "x "), ("t", None, "b"), ("t", "q", " "),
        ("v", "a", "b"), ("v", "a", "b\n"), ("v", " ", None),
    ]
    df = spark.createDataFrame(rows, "split string, chosen string, rejected string")
    out = metrics.prep_report(df, ["chosen", "rejected"], "chosen", pair=True)
    got = {r["split"]: tuple(r)[1:] for r in out.collect()}
    assert got == {"t": (5, 2, 1, 1, 1), "v": (3, 1, 0, 1, 1)}
    plain = metrics.prep_report(df, "chosen").orderBy("split").collect()
    assert [tuple(r) for r in plain] == [("t", 5, 1, 0, 0, 4), ("v", 3, 1, 0, 0, 2)]
    assert {tuple(r) for r in metrics.split_sizes(df).collect()} == {("t", 5), ("v", 3)}


def test_infinite_and_undefined_logits_in_both_forms(spark):
    inf, nan = float("inf"), float("nan")
    arrays = [[1.0, -inf, 2.0], [-inf, -inf, -inf], [inf, 0.0, 1.0], [nan, 0.0, 1.0], [-inf, 900.0, -900.0]]
    labels = spark.createDataFrame(
        [(s, p, 2 if s != 4 else 1) for s in range(5) for p in (0, 1)], "seq_id long, pos int, label int"
    )
    dense = spark.createDataFrame([(s, 0, a) for s, a in enumerate(arrays)], "seq_id long, pos int, logits array<double>")
    long = spark.createDataFrame(
        [(s, 0, t, x) for s, a in enumerate(arrays) for t, x in enumerate(a)],
        "seq_id long, pos int, token_id long, logit double",
    )
    for found in (scoring.token_logprobs(dense, labels), scoring.token_logprobs_long(long, labels)):
        got = {r["seq_id"]: r["logp"] for r in found.collect()}
        assert got[0] == pytest.approx(2 - math.log(math.exp(1) + math.exp(2)))
        assert all(math.isnan(got[s]) for s in (1, 2, 3))
        assert got[4] == pytest.approx(0.0)


def test_a_data_set_id_reads_back_as_it_was(spark, tmp_path):
    sides = spark.createDataFrame([(0, "chosen", -1.0), (0, "rejected", -2.0)], "idx long, side string, logp double")
    path = str(tmp_path / "cache")
    for name in ("org/pairs-v1", "a=b %"):
        cache = scoring.precompute_reference(sides, name, path)
    assert {r["dataset_id"] for r in cache.collect()} == {"org/pairs-v1", "a=b %"}
    pairs = spark.createDataFrame([(0,)], "idx long")
    assert scoring.lookup_reference(pairs, cache, "org/pairs-v1").first()["ref_logp_chosen"] == -1.0
