import hashlib
import math
import random

import pytest
from conftest import executed_plan

from tuneprep.operators import placement, sampling


def key(purpose, seed, *parts):
    return hashlib.md5(":".join([purpose, str(seed), *map(str, parts)]).encode()).hexdigest()


def frame(spark, n=1000, partitions=4):
    rows = [(i, "validation" if i % 10 == 0 else "train", f"t{i}") for i in range(n)]
    return spark.createDataFrame(rows, "i bigint, split string, t string").repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_shuffle_order_and_rank(spark, partitions):
    df = frame(spark, partitions=partitions)
    order = [r["i"] for r in sampling.seeded_shuffle(df, 42, "i").collect()]
    assert order == sorted(range(1000), key=lambda i: key("shuffle", 42, i))
    ranks = {r["i"]: (r["split"], r["rank"]) for r in sampling.shuffle_rank(df, 42, "i").collect()}
    for split in ("train", "validation"):
        assert [ranks[i][1] for i in order if ranks[i][0] == split] == list(
            range(sum(s == split for s, _ in ranks.values()))
        )


def test_shuffle_does_not_sample_its_input(spark):
    plan = executed_plan(sampling.seeded_shuffle(frame(spark), 42, "i"))
    assert "rangepartitioning" not in plan


def test_written_files_keep_the_shuffled_order(spark, tmp_path):
    path = str(tmp_path / "s")
    sampling.seeded_shuffle(frame(spark), 1, "i").select("i").write.json(path)
    lines = [l for f in sorted((tmp_path / "s").glob("part-*")) for l in f.read_text().split("\n")]
    order = [int(l[5:-1]) for l in lines if l]
    assert order == sorted(range(1000), key=lambda i: key("shuffle", 1, i))


@pytest.mark.parametrize(
    "n,partitions", [(1, 7), (37, 1), (37, 7), (37, 64), (899, 7), (900, 7), (5000, 7)]
)
def test_limit_is_the_head_of_the_shuffled_train_split(spark, partitions, n):
    out = sampling.limit_train(frame(spark, partitions=partitions), n, "i", seed=5).collect()
    train = sorted((i for i in range(1000) if i % 10), key=lambda i: key("shuffle", 5, i))
    assert {r["i"] for r in out if r["split"] == "train"} == set(train[:n])
    assert sum(r["split"] == "validation" for r in out) == 100


@pytest.mark.parametrize("n", [0, -1])
def test_no_limit(spark, n):
    df = frame(spark)
    assert sampling.limit_train(df, n, "i", seed=5) is df


def test_limit_in_dataset_order(spark):
    out = sampling.limit_train(frame(spark), 50, "i").filter("split = 'train'").collect()
    assert sorted(r["i"] for r in out) == [i for i in range(1000) if i % 10][:50]
    assert sampling.limit_train(frame(spark), 2000, "i").count() == 1000


def test_cuts_shuffle_no_rows(spark, tmp_path):
    path = str(tmp_path / "in")
    frame(spark).write.parquet(path)
    out = sampling.limit_train(spark.read.parquet(path), 50, "i", seed=5)
    assert "Exchange" not in executed_plan(out)


@pytest.mark.filterwarnings("ignore:no validation")
@pytest.mark.parametrize(
    "ratio,partitions", [(0.05, 1), (0.05, 7), (0.05, 64), (0.333, 7), (0.99, 7)]
)
def test_split_has_the_exact_size(spark, partitions, ratio):
    df = frame(spark, partitions=partitions).replace("validation", "other", "split")
    out = sampling.train_test_split(df, ratio, 42, "i").collect()
    train = sorted((i for i in range(1000) if i % 10), key=lambda i: key("holdout", 42, i))
    held = train[: math.ceil(ratio * len(train))]
    assert {r["i"] for r in out if r["split"] == "test"} == set(held)
    assert sorted(r["i"] for r in out) == sorted(train)


@pytest.mark.filterwarnings("ignore:no validation")
def test_split_of_one_row_and_composite_string_keys(spark):
    one = spark.createDataFrame([(1, "train")], "i int, split string")
    with pytest.raises(ValueError, match="every train row"):
        sampling.train_test_split(one, 0.05, 1, "i")
    rows = [(f"d{i % 7}", i, "train") for i in range(100)]
    df = spark.createDataFrame(rows, "d string, i int, split string")
    out = sampling.train_test_split(df, 0.25, 9, ["d", "i"]).collect()
    held = sorted(rows, key=lambda r: key("holdout", 9, r[0], r[1]))[:25]
    assert {r["i"] for r in out if r["split"] == "test"} == {r[1] for r in held}


def test_split_leaves_a_validation_split_alone(spark):
    df = frame(spark)
    assert sampling.train_test_split(df, 0.05, 42, "i") is df
    with pytest.warns(UserWarning, match="dropped"):
        sampling.train_test_split(df.filter("split = 'train'"), 0.05, 42, "i")
    with pytest.raises(ValueError, match="no train"):
        sampling.train_test_split(df.filter("split = 'none'"), 0.05, 42, "i")
    with pytest.raises(ValueError, match="ratio"):
        sampling.train_test_split(df, 1.5, 42, "i")


def test_hash_split_is_stable_while_data_grows(spark):
    small = {r["i"]: r["split"] for r in sampling.hash_split(frame(spark, 500), 0.2, 3, "i").collect()}
    large = {r["i"]: r["split"] for r in sampling.hash_split(frame(spark), 0.2, 3, "i").collect()}
    assert all(large[i] == side for i, side in small.items())
    assert 150 < sum(side == "test" for side in large.values()) < 250


def test_eval_split(spark):
    assert sampling.choose_eval_split(frame(spark)).count() == 100
    test = frame(spark).replace("validation", "test", "split")
    assert {r["split"] for r in sampling.choose_eval_split(test).collect()} == {"test"}


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_index_is_contiguous_in_order(spark, partitions):
    df = spark.createDataFrame([(i * 7919 % 1009, i % 3) for i in range(1, 900)], "k int, v int")
    out = placement.with_index(df.repartition(partitions), "k").orderBy("k").collect()
    assert [r["idx"] for r in out] == list(range(899))
    assert [r["k"] for r in out] == sorted(i * 7919 % 1009 for i in range(1, 900))


def test_index_composite_strings_and_no_op(spark):
    rows = [(c, n) for c in "zyxab" for n in (10, 2, 1)]
    df = spark.createDataFrame(rows, "c string, n int")
    out = placement.with_index(df, ["c", "n"])
    assert [(r["c"], r["n"]) for r in out.orderBy("idx").collect()] == sorted(rows)
    assert placement.with_index(out, ["c", "n"]) is out
    assert placement.with_index(df.limit(0), ["c", "n"]).count() == 0


def test_temporary_columns_do_not_touch_those_of_the_user(spark):
    from tuneprep.operators import dedup

    rows = [(i, "train", f"k{i}", i, "same" if i < 3 else f"t{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "i int, split string, _key string, _place int, _content string")
    for out in (
        sampling.seeded_shuffle(df, 1, "i"),
        sampling.shuffle_rank(df, 1, "i").drop("rank"),
        placement.with_index(df, "i").drop("idx"),
    ):
        assert sorted(tuple(r) for r in out.select(df.columns).collect()) == rows
    kept = dedup.dedup_first(df, "_content", "i")
    assert sorted(tuple(r) for r in kept.select(df.columns).collect()) == rows[:1] + rows[3:]


@pytest.mark.parametrize("order,cols", [(["b"], (1,)), (["a", "b"], (0, 1)), (["c"], (2,)), (["a"], (0,))])
def test_nth_row_by_brackets(spark, monkeypatch, order, cols):
    """Integers, strings and doubles, nulls and keys that repeat hundreds of times."""
    monkeypatch.setattr(sampling, "_FEW", 50)
    monkeypatch.setattr(sampling, "_PIVOTS", 16)
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(40)]), f"s{rng.random()}", rng.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, c double").repartition(5)
    wanted = sorted((tuple(r[i] for i in cols) for r in rows), key=lambda t: [(x is not None, x or 0) for x in t])
    for k in (0, 77, 1500, 2999):
        assert tuple(sampling.nth_row(df, k, order)) == wanted[k]
    assert sampling.nth_row(df, 3000, order) is None


def test_limit_in_order_sorts_and_stores_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sampling, "_FEW", 10)
    stored = []
    monkeypatch.setattr(sampling, "materialize", lambda *a: stored.append(a))
    path = str(tmp_path / "in")
    frame(spark).write.parquet(path)
    out = sampling.limit_train(spark.read.parquet(path), 123, "i")
    assert out.count() == 223 and stored == []
    assert "Exchange" not in executed_plan(out) and "Sort" not in executed_plan(out)
