import random
import re

import pytest
import xxhash
from conftest import executed_plan

from tuneprep.llm import simhash
from tuneprep.llm.common import components

SCHEMA = "doc_id long, text string, bits string, component long"


def brute_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, bits, most):
    label = list(range(len(ids)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= most:
                label[root(i)] = root(j)
    sets = {}
    for i in range(len(ids)):
        sets.setdefault(root(i), []).append(ids[i])
    least = {r: min((x for x in v if x is not None), default=None) for r, v in sets.items()}
    return [least[root(i)] for i in range(len(ids))]


def texts():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "é", "delta", "x" * 40, "ÄB", "omega"]
    rows = [None, "", " \t\n", "one", "One two", "one two three four", "a\x0bb\x0cc\rd"]
    for _ in range(60):
        rows.append(" ".join(rng.choices(words, k=rng.randint(1, 9))))
    base = rng.choices([f"w{i}" for i in range(500)], k=400)
    for _ in range(25):
        near = list(base)
        near[rng.randrange(400)] = "changed"
        rows.append(" ".join(near))
    rows += rows[-3:]
    return rows


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_groups_are_those_of_brute_force(spark, most):
    rows = texts()
    ids = [None if i % 17 == 3 else 1000 - i for i in range(len(rows))]
    df = spark.createDataFrame(
        [(i, t, "clash", 7) for i, t in zip(ids, rows, strict=True)], SCHEMA
    )
    want = [brute_fingerprint(t) for t in rows]
    labels = brute_components(ids, want, most)
    got = simhash.groups(df, "doc_id", "text", max_bits=most).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2] is None, x[2] or 0)
    signed = [x - (1 << 64) if x >> 63 else x for x in want]
    assert sorted(((r.doc_id, r.bits, r.component_id) for r in got), key=key) == sorted(
        zip(ids, signed, labels, strict=True), key=key
    )
    if most == 2:
        assert len(set(labels[-28:])) < 25


def test_one_document_of_each_component_stays(spark):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "lone"), (9, None), (8, "")]
    df = spark.createDataFrame([(i, t, None, 1) for i, t in rows], SCHEMA)
    kept = simhash.keep_one(df, "doc_id", "text")
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, "lone"), (3, "a b c d"), (8, "")]


def test_one_of_rows_that_repeat_an_id_stays_whatever_their_order(spark):
    rows = [(1, "a b c d", "x", 1), (1, "a b c d", "y", 1), (1, "a b c d", None, 2), (1, "a b c d", "x", 1), (2, "z" * 300_000, "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    runs = [sorted(map(tuple, simhash.keep_one(x, "doc_id", "text").collect())) for x in (df, df.repartition(3), df.orderBy("bits"))]
    assert runs[0] == runs[1] == runs[2]
    assert [r[0] for r in runs[0]] == [1, 2] and set(runs[0]) <= set(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.groups(empty, "doc_id", "text").count() == 0
    assert simhash.keep_one(empty, "doc_id", "text").count() == 0


def test_components_of_long_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 260)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert all(got[i] == 100 for i in range(100, 161))
    assert all(got[i] == 7 for i in [7, *range(200, 260)])
    assert len(got) == 61 + 61


def plans_of_pairs(monkeypatch, job):
    """Physical plans that ``job`` finds near fingerprints with."""
    plans, found = [], simhash.near_fingerprints

    def near(*args):
        pairs = found(*args)
        plans.append(executed_plan(pairs))
        return pairs

    monkeypatch.setattr(simhash, "near_fingerprints", near)
    job()
    return plans


def assert_cells_meet_by_shuffle(plans):
    (plan,) = plans
    assert "Generate explode" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan


def test_cells_are_not_broadcast_for_groups(spark, monkeypatch):
    df = spark.createDataFrame([(i, t, None, 1) for i, t in enumerate(texts())], SCHEMA)
    assert_cells_meet_by_shuffle(plans_of_pairs(monkeypatch, lambda: simhash.groups(df, "doc_id", "text")))


def test_cells_are_not_broadcast_when_one_document_stays(spark, monkeypatch):
    df = spark.createDataFrame([(i, t, None, 1) for i, t in enumerate(texts())], SCHEMA)
    assert_cells_meet_by_shuffle(plans_of_pairs(monkeypatch, lambda: simhash.keep_one(df, "doc_id", "text")))
