import random

import pytest
from conftest import executed_plan

from tuneprep.operators import dedup


def first_copies(rows, within=True):
    seen, kept = set(), []
    for split, i, text in sorted(rows, key=lambda r: r[1]):
        key = (split, text) if within else text
        if key not in seen:
            seen.add(key)
            kept.append((split, i, text))
    return sorted(kept)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    # One text is a third of all rows; nulls count as one text; case matters.
    texts = ["hot"] * 200 + [rng.choice("abcdefgHG") * rng.randint(1, 9) for _ in range(380)]
    texts += [None] * 20
    rng.shuffle(texts)
    return [(rng.choice(["train", "validation"]), i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("within", ["split", None])
@pytest.mark.parametrize("limit", [dedup.MAX_BROADCAST_GROUPS, 0])
@pytest.mark.parametrize("partitions", [1, 16])
def test_first_row_wins_whatever_the_layout(spark, rows, within, limit, partitions):
    df = spark.createDataFrame(rows, "split string, i int, t string").repartition(partitions)
    out = dedup.dedup_first(df, "t", "i", within, max_broadcast_groups=limit)
    assert sorted(tuple(r) for r in out.collect()) == first_copies(rows, within is not None)
    assert out.columns == df.columns


def test_counts_and_idempotence(spark, rows):
    df = spark.createDataFrame(rows, "split string, i int, t string")
    result = dedup.dedup_with_counts(df, "t", "i")
    kept = first_copies(rows)
    dropped = {r["split"]: r["dropped_duplicates"] for r in result.dropped.collect()}
    for split in dropped:
        before = sum(r[0] == split for r in rows)
        assert dropped[split] == before - sum(r[0] == split for r in kept)
    again = dedup.dedup_first(result.rows, "t", "i")
    assert again.count() == len(kept)


@pytest.mark.parametrize("limit", [dedup.MAX_BROADCAST_GROUPS, 0])
def test_composite_order(spark, limit):
    rows = [(2, 0, "x"), (1, 9, "x"), (1, 3, "x"), (3, 1, "y"), (3, 0, "y"), (0, 0, "z")]
    df = spark.createDataFrame(rows, "a int, b int, t string")
    out = dedup.dedup_first(df, "t", ["a", "b"], max_broadcast_groups=limit)
    assert sorted(tuple(r) for r in out.collect()) == [(0, 0, "z"), (1, 3, "x"), (3, 0, "y")]


def test_stored_rows_give_the_same(spark, rows):
    df = spark.createDataFrame(rows, "split string, i int, t string")
    out = dedup.stored_dedup(df, "t", "i")
    assert sorted(tuple(r) for r in out.collect()) == first_copies(rows)


def test_groups_fold_before_the_shuffle(spark, rows):
    df = spark.createDataFrame(rows, "split string, i int, t string")
    plan = executed_plan(dedup.copy_groups(df, "t", "i"))
    assert "partial_min" in plan and "SortAggregate" not in plan


def test_few_repeated_texts_shuffle_no_rows(spark, rows):
    df = spark.createDataFrame(rows, "split string, i int, t string")
    plan = executed_plan(dedup.dedup_first(df, "t", "i"))
    assert "LeftAnti" in plan and "Exchange hashpartitioning" not in plan


def test_long_order_keys_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(dedup, "MAX_BROADCAST_BYTES", 10)
    rows = [("k" * 20 + str(i), "same") for i in range(5)]
    out = dedup.dedup_first(spark.createDataFrame(rows, "k string, t string"), "t", "k")
    assert "LeftSemi" in executed_plan(out)
    assert [r["k"] for r in out.collect()] == ["k" * 20 + "0"]
