"""Ranks, indexes and batches laid out by rank, against plain Python; and what their plans move."""

import hashlib
import random
import re

import pytest
from conftest import executed_plan

from tuneprep.operators import batching, placement
from tuneprep.runtime import materialize

SCHEMA = "k int, s string, split string, input_ids array<int>, note string"


def rows(n=700, hot=0.9):
    rng = random.Random(n)
    out = []
    for i in range(n):
        split = "train" if rng.random() < hot else rng.choice(["test", "validation", None])
        out.append((i, f"k{rng.random()}", split, list(range(rng.randrange(12))), "x" * rng.randrange(9)))
    return out


def order_of(data, seed, order):
    at = {"k": 0, "s": 1}

    def key(row):
        own = tuple(row[at[c]] for c in order)
        name = ":".join(["shuffle", str(seed), *map(str, own)])
        return own if seed is None else (hashlib.md5(name.encode()).hexdigest(), *own)

    return {
        split: sorted((r for r in data if r[2] == split), key=key) for split in {r[2] for r in data}
    }


@pytest.mark.parametrize("seed", [None, 42])
@pytest.mark.parametrize("order", [["k"], ["s"], ["s", "k"]])
@pytest.mark.parametrize("partitions", [7])
def test_ranks(spark, seed, order, partitions):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(partitions)
    out = placement.with_rank(df, order, seed)
    assert out.columns == [*df.columns, "rank"]
    got = out.collect()
    assert sorted(map(str, (r[:5] for r in got))) == sorted(map(str, data))  # whole rows, each once
    ranks = {r["k"]: r["rank"] for r in got}
    for own in order_of(data, seed, order).values():
        assert [ranks[r[0]] for r in own] == list(range(len(own)))


@pytest.mark.parametrize("seed", [None, 7])
@pytest.mark.parametrize("size", [1, 6, 5000])
def test_batches(spark, seed, size):
    data = rows(400)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = {r["k"]: r for r in batching.pad_batch(df, size, -1, "k", seed=seed).collect()}
    assert len(got) == len(data)
    for own in order_of(data, seed, ["k"]).values():
        for place, row in enumerate(own):
            batch = own[place // size * size : place // size * size + size]
            width = max(len(r[3]) for r in batch)
            r = got[row[0]]
            assert (r["batch_id"], r["pos_in_batch"]) == (place // size, place % size)
            assert r["input_ids"] == row[3] + [-1] * (width - len(row[3]))
            assert r["attention_mask"] == [1] * len(row[3]) + [0] * (width - len(row[3]))
            assert seed is None or r["rank"] == place


def test_partitions_follow_the_order(spark, tmp_path):
    df = spark.createDataFrame(rows(300), SCHEMA)
    path = str(tmp_path / "ranked")
    placement.with_rank(df, "k", 3).select("split", "rank").write.json(path)
    lines = [x for f in sorted((tmp_path / "ranked").glob("part-*")) for x in f.read_text().split("\n") if x]
    seen = [(re.search('split":"(.*?)"', x) or [0, ""])[1] + f'{int(re.search("rank.:([0-9]+)", x)[1]):05d}' for x in lines]
    assert len(seen) == 300 and seen == sorted(seen)


def wide_exchanges(df):
    """Exchanges of the executed plan that are not inside the subquery that lists the cuts."""
    df.collect()
    final = executed_plan(df).split("== Initial Plan ==")[0].split("Subquery")[0]
    return re.findall(r"Exchange \w+", executed_plan(df).split("Subquery subquery")[0]), final


@pytest.mark.parametrize("seed", [None, 42])
def test_whole_rows_are_shuffled_and_sorted_once(spark, seed):
    df = materialize(spark.createDataFrame(rows(200), SCHEMA), "t")
    for out in (
        placement.with_index(df, "k", seed=seed),
        batching.pad_batch(df, 6, 0, "k", seed=seed),
        batching.collate(df, 6, 0, "k", [3, 4], seed=seed),
    ):
        exchanges, plan = wide_exchanges(out)
        assert exchanges == ["Exchange shufflepartitionidpassthrough"], exchanges
        assert len(re.findall(r"\bSort \[", plan)) == 1 and "Join" not in plan


def test_a_hot_split_is_spread(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 100 = 0, 'test', 'train') split", "array(1) input_ids")
    for seed in (None, 1):
        parts, _ = placement.placed(df, "id", seed)
        counts = [r["count"] for r in parts.filter("split = 'train'").groupBy("_tp_part").count().collect()]
        assert len(counts) >= 7 and max(counts) < 2 * 5000 / len(counts)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    for seed in (None, 1):
        assert placement.with_index(df, "k", seed=seed).collect() == []
        assert batching.pad_batch(df, 3, 0, "k", seed=seed).collect() == []


def test_repeated_and_null_keys_with_a_seed(spark):
    for keys in ([1, 1, 2], [1, None, 2]):
        df = spark.createDataFrame([(k, "a", "train", [1], "") for k in keys], SCHEMA)
        with pytest.raises(Exception, match="unique and not null"):
            placement.with_index(df, "k", seed=5).collect()


@pytest.mark.parametrize(("seed", "mask_padding"), [(None, True), (9, True), (9, False)])
def test_pair_batches(spark, seed, mask_padding):
    rng = random.Random(3)
    ids = lambda: [rng.randrange(1, 9) for _ in range(rng.randrange(7))]
    data = [(i, f"x{i}", "train" if i % 5 else "test", ids(), ids(), ids()) for i in range(90)]
    df = spark.createDataFrame(
        data, "k int, s string, split string, prompt_ids array<int>, chosen_ids array<int>, rejected_ids array<int>"
    )
    out = batching.collate_pairs(df, 4, 0, "k", seed, mask_padding)
    sides = [f"{kind}_{side}" for side in ("chosen", "rejected") for kind in ("input_ids", "attention_mask", "labels")]
    assert out.columns == ["split", "k", "idx", "batch_id", "pos_in_batch", *sides]
    got = {r["k"]: r for r in out.collect()}
    for own in order_of(data, seed, ["k"]).values():
        for place, row in enumerate(own):
            batch = own[place // 4 * 4 : place // 4 * 4 + 4]
            r = got[row[0]]
            assert (r["idx"], r["batch_id"], r["pos_in_batch"]) == (place, place // 4, place % 4)
            for at, side in ((4, "chosen"), (5, "rejected")):
                pad = max(len(x[3]) + len(x[at]) for x in batch) - len(row[3]) - len(row[at])
                assert r[f"input_ids_{side}"] == row[3] + row[at] + [0] * pad
                assert r[f"attention_mask_{side}"] == [1] * len(row[3] + row[at]) + [0] * pad
                assert r[f"labels_{side}"] == [-100] * len(row[3]) + row[at] + [-100 if mask_padding else 0] * pad
    exchanges, _ = wide_exchanges(batching.collate_pairs(materialize(df, "p"), 4, 0, "k", seed))
    assert exchanges == ["Exchange shufflepartitionidpassthrough"]


def test_pair_batches_along_an_index(spark):
    df = spark.createDataFrame(
        [(i, 9 - i, [1] * i, [2] * (i % 3), [3]) for i in range(10)],
        "k int, idx bigint, prompt_ids array<int>, chosen_ids array<int>, rejected_ids array<int>",
    )
    got = {r["k"]: r for r in batching.collate_pairs(df, 5, 0, "k").collect()}
    assert [got[k]["batch_id"] for k in range(10)] == [1] * 5 + [0] * 5
    assert all(got[k]["idx"] == 9 - k and len(got[k]["labels_rejected"]) == (5 if k < 5 else 10) for k in range(10))
    with pytest.raises(ValueError, match="gives the order"):
        batching.collate_pairs(df, 5, 0, "k", seed=1)
