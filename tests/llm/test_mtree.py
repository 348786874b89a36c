import math

import numpy as np
import pytest

from tuneprep.llm import mtree

SCHEMA = "vec_id long, embedding array<double>, rank string, query_id int"


def brute(rows, k=20, every=20):
    ok = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for row, (q, v) in enumerate(ok):  # every row is a query, and a candidate of all others
        if q % every:
            continue
        others = [(i, w) for other, (i, w) in enumerate(ok) if other != row and len(w) == len(v)]
        scores = [(-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in others]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def table(n=700, dim=6):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((n, dim)).round(1))]
    rows += [(2000 + i, rows[i % 5][1]) for i in range(300)]  # ties
    rows += [(20, rows[20][1]), (21, rows[21][1]), (None, rows[0][1]), (40, [9.0] * dim)]
    rows += [(5000, None), (5020, []), (5040, [1.0, None]), (5060, [math.nan] * dim), (5080, [math.inf] * dim)]
    return rows + [(6000, [1.5, -2.0]), (6001, [0.0, 1.0]), (6020, [1e-9] * dim), (6040, [-0.5])]


@pytest.mark.parametrize("sizes", [{}, {"routes": 3, "part": 100, "block": 11}])
def test_results_are_those_of_brute_force(spark, sizes):
    rows = table()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    assert sorted(map(tuple, mtree.top_k(df, **sizes).collect())) == brute(rows)


@pytest.mark.parametrize("scale", [8, 1 << 22])
def test_search_of_a_tree_of_many_pages(scale):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 10)) * 20
    x = (centres[rng.integers(0, 12, 3000)] + rng.standard_normal((3000, 10))) * scale
    x = np.floor(x).astype(np.int64)
    x[100:140] = x[0]
    q, s, i = mtree.search(x, np.arange(3000), x[:40], np.arange(40), 7)
    got = sorted(zip(q.tolist(), s.tolist(), i.tolist(), strict=True))
    exact = x.astype(object)
    want = []
    for n in range(40):
        scores = exact @ exact[n]
        order = sorted((-scores[j], j) for j in range(3000) if j != n)[:7]
        want += [(n, -a, j) for a, j in order]
    assert got == sorted(want)


def test_empty_table(spark):
    assert mtree.top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(20, [1.0, 0.0]), (20, [2.0, 0.0]), (21, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got = sorted(map(tuple, mtree.top_k(df).collect()))
    assert got == brute(rows) and len(got) == 4
