import random
import re

import pytest
from pyspark.sql import functions as F

from tuneprep.llm import mixing

SCHEMA = "doc_id long, text string, source string, copies string, idx int"


def water_fill(sizes, weights, most):
    """Reshare the excess round by round, as the target is defined."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        shares = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if shares[s] > most * sizes[s]]
        if not over:
            return fixed | shares
        fixed |= {s: most * sizes[s] for s in over}


def documents():
    rng = random.Random(3)
    rows = [(None, "no id", None), (1, None, "a"), (2, "", "a"), (3, "x", "empty"), (3, "x", "empty")]
    rows += [(4, " \t ", "blank"), (5, "a\x0bb\xa0c", "é"), (6, "w " * 5000, "big")]
    for i in range(300):
        rows.append((10 + i, "w " * rng.randint(1, 60), rng.choice("abbbbbbbbcd")))
    return rows


def test_targets_and_copies(spark):
    rows = documents()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got = mixing.copies(df).withColumn("source", F.lit(None)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = water_fill(sizes, (5, 2, 1), 3)
    by_id = {r[0]: r[2] for r in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        source = by_id[r.id]
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source])
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[source] += r.taken
    for source in "abcd":
        assert abs(taken[source] - want[source]) <= 120
    assert sorted(map(tuple, got), key=repr) == sorted(
        map(tuple, mixing.copies(df.repartition(5)).withColumn("source", F.lit(None)).collect()), key=repr
    )


def test_many_sources_give_the_same_as_few(spark, monkeypatch):
    rows = documents()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    few = sorted(map(tuple, mixing.copies(df).collect()), key=repr)
    monkeypatch.setattr(mixing, "HOT_SHARE", 0.3)  # at most 3 hot sources; the table has more
    assert sorted(map(tuple, mixing.copies(df).collect()), key=repr) == few


def test_repeated_rows_share_their_copies_alike_in_each_run(spark):
    rows = [(7, "w w", "a", f"other {i}", i) for i in range(5)] + [(8, "w " * 9, "b", "x", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    runs = [sorted(map(tuple, mixing.mix(x).collect())) for x in (df, df.repartition(4))]
    assert runs[0] == runs[1]
    total = sum(r.copies for r in mixing.copies(df).collect() if r.id == 7)
    assert sum(r[0] == 7 for r in runs[0]) == total


def test_mix_emits_each_row_as_often(spark):
    rows = documents()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    out = mixing.mix(df)
    assert out.columns == df.columns
    want = {r.id: 0 for r in mixing.copies(df).collect()}
    for r in mixing.copies(df).collect():
        want[r.id] += r.copies
    got = dict.fromkeys(want, 0)
    for r in out.collect():
        got[r.doc_id] += 1
    assert got == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.copies(empty).count() == 0
    assert mixing.mix(empty).count() == 0
