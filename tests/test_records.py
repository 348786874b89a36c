"""Scores of whole records, and reference scores stored by bucket."""

import math
import random
import re

import numpy as np
import pytest
from conftest import executed_plan
from pyspark.sql import functions as F

from tuneprep.operators import scoring
from tuneprep.plans import preference
from tuneprep.runtime import materialize
from tuneprep.sources import bucketed

IGNORE = -100
INF, NAN = math.inf, math.nan


def plain(logits, labels):
    """Shift, log-softmax, gather, one record."""
    out = []
    for row, label in zip(logits[:-1], labels[1:], strict=True):
        if label is None or label == IGNORE:
            out.append(0.0)
            continue
        x = np.array(row, float)
        with np.errstate(invalid="ignore"):
            peak = x.max()
            out.append(float(x[label] - peak - np.log(np.exp(x - peak).sum())))
    return out


def records():
    rng = np.random.default_rng(1)
    found = []
    for n in (2, 3, 9, 30):
        labels = [int(y) if rng.random() < 0.7 else rng.choice([IGNORE, None]) for y in rng.integers(0, 7, n)]
        found.append(((rng.normal(size=(n, 7)) * 9).tolist(), labels))
    found += [([[1.0, 2.0]], [1]), ([], []), ([[0.0, -INF], [INF, 0.0], [NAN, 1.0], [-INF, -INF], [1000.0, -1000.0], [0.0, 0.0]], [0, 0, 0, 1, 0, 1])]
    return [*found, ([[1.0, 2.0]] * 3, [IGNORE] * 3), ([[INF, NAN]] * 2, [0, IGNORE])]


def frame(spark, kind="double"):
    rows = [(i, *r) for i, r in enumerate(records())]
    rows += [(100, None, [1]), (101, [[1.0]], None)]
    df = spark.createDataFrame(rows, "i int, logits array<array<double>>, labels array<int>")
    return df.withColumn("logits", F.col("logits").cast(f"array<array<{kind}>>"))


def same(a, b):
    return len(a) == len(b) and all(
        x == y or (math.isnan(x) and math.isnan(y)) or abs(x - y) < 1e-5 * max(1, abs(y)) for x, y in zip(a, b, strict=True)
    )


@pytest.mark.parametrize("kind", ["double", "float"])
def test_records(spark, kind):
    df = frame(spark, kind)
    got = {r["i"]: r["logps"] for r in scoring.record_logprobs(df).collect()}
    sums = {r["i"]: r["logp"] for r in scoring.score_records(df).collect()}
    for i, (logits, labels) in enumerate(records()):
        wanted = plain(logits, labels)
        assert same(got[i], wanted), (i, got[i], wanted)
        assert same([sums[i]], [sum(wanted)])
    assert got[100] is got[101] is sums[100] is sums[101] is None


def test_records_agree_with_the_long_form(spark):
    rows = [(i, t, x, y) for i, (logits, labels) in enumerate(records()) for t, (x, y) in enumerate(zip(logits, labels, strict=True))]
    df = spark.createDataFrame(rows, "seq_id int, pos int, logits array<double>, label int")
    long = df.select("seq_id", "pos", F.posexplode("logits").alias("token_id", "logit"))
    tokens = scoring.token_logprobs_long(long, df.select("seq_id", "pos", "label")).collect()
    got = {r["i"]: r["logps"] for r in scoring.record_logprobs(frame(spark)).collect()}
    assert len(tokens) == sum(max(0, len(r[1]) - 1) for r in records())
    assert all(same([got[r["seq_id"]][r["pos"]]], [r["logp"]]) for r in tokens)


@pytest.mark.parametrize(("labels", "message"), [([0, 7], "outside the vocabulary"), ([0, -1], "outside the vocabulary"), ([0], "one label for each")])
def test_wrong_labels(spark, labels, message):
    df = spark.createDataFrame([([[0.0, 1.0]] * 2, labels)], "logits array<array<double>>, labels array<int>")
    with pytest.raises(Exception, match=message):
        scoring.score_records(df).collect()


def test_records_are_not_moved(spark):
    df = materialize(frame(spark), "records")
    pair = df.select("i", *[F.col(c).alias(f"{c}_{side}") for c in ("logits", "labels") for side in ("chosen", "rejected")])
    for out in (scoring.record_logprobs(df), scoring.score_records(df), preference.score_pairs(scoring.score_records(pair, ("chosen", "rejected")))):
        assert "Exchange" not in executed_plan(out)
    losses = preference.score_pairs(scoring.score_records(pair.filter("i < 4"), ("chosen", "rejected"))).collect()
    assert all(abs(r["loss"] - math.log(2)) < 1e-12 for r in losses)


def test_look_up_in_buckets_moves_nothing(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, side, rng.random()) for i in range(500) for side in ("chosen", "rejected") for _ in range(3)]
    scores = spark.createDataFrame(rows, "idx bigint, side string, logp double")
    path = str(tmp_path / "cache")
    cache = scoring.bucketed_reference(scores, "a/b", path, "cache_test", 4)
    pairs = spark.createDataFrame([(i, 1.0 * i, -1.0) for i in range(500)], "idx bigint, logp_chosen double, logp_rejected double")
    stored = bucketed.write_bucketed(pairs, str(tmp_path / "pairs"), "pairs_test", "idx", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = scoring.lookup_reference(stored, cache, "a/b")
        got = {r["idx"]: r for r in out.collect()}
        assert "Exchange" not in executed_plan(out) and "SortMergeJoin" in executed_plan(out)
        losses = preference.score_pairs(stored, cache, "a/b")
        losses.collect()
        assert "Exchange" not in executed_plan(losses)
        for i in range(500):
            for side in ("chosen", "rejected"):
                wanted = sum(x for j, s, x in rows if j == i and s == side)
                assert abs(got[i][f"ref_logp_{side}"] - wanted) < 1e-12
        # Scores summed again from a table bucketed alike stay where they are too.
        again = bucketed.write_bucketed(scores, str(tmp_path / "scores"), "scores_test", "idx", 4)
        rescored = scoring.reference_scores(again, "a/b")
        assert rescored.count() == 500 and "Exchange hashpartitioning" not in executed_plan(rescored)
        missing = pairs.union(spark.createDataFrame([(500, 0.0, 0.0)], pairs.schema))
        with pytest.raises(Exception, match="no reference score for idx 500"):
            scoring.lookup_reference(
                bucketed.write_bucketed(missing, str(tmp_path / "more"), "more_test", "idx", 4), cache, "a/b"
            ).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_buckets_are_kept_and_opened_again(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(100).selectExpr("id as idx", "id * 2 as v")
    bucketed.write_bucketed(first, path, "kept_test", "idx", 4)
    other = first.selectExpr("idx", "v + 1 as v")
    kept = bucketed.write_bucketed(other, path, "kept_test", "idx", 8)  # skipped
    assert kept.agg(F.sum("v")).first()[0] == 9900
    spark.sql("DROP TABLE kept_test")  # as a new session would begin
    again = bucketed.open_bucketed(spark, path, "kept_test")
    assert again.count() == 100
    assert re.search("Bucketed: true", executed_plan(again.groupBy("idx").count()))
    with pytest.raises(FileExistsError):
        bucketed.write_bucketed(other, path, "kept_test", "idx", 4, "error")
    new = bucketed.write_bucketed(other, path, "kept_test", "idx", 2, "overwrite")
    assert new.agg(F.sum("v")).first()[0] == 10000
    assert bucketed.bucket_count(0) == 1 and bucketed.bucket_count(10, 3) == 4
