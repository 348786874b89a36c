import math

import numpy as np

from tuneprep.llm import caps

SCHEMA = "vec_id long, embedding array<float>, n_links string, class_id int"


def brute(rows, threshold=0.95):
    ok = [
        v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for _, v in rows
    ]
    label, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], np.float64), np.array(rows[j][1], np.float64)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    label[root(i)] = root(j)
    sets = {}
    for i, (vec_id, _) in enumerate(rows):
        sets.setdefault(root(i), []).append(vec_id)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in sets.items()}
    return [(rows[i][0], links[i], least[root(i)], rows[i][0] == least[root(i)]) for i in range(len(rows))]


def table():
    rng = np.random.default_rng(0)
    rows = [(1000 + i, v.tolist()) for i, v in enumerate(rng.standard_normal((150, 32)).astype(np.float32))]
    for centre in range(6):
        base = np.array(rows[centre][1])
        for i in range(25):
            noise = rng.standard_normal(32) * rng.choice([0.0, 0.05, 0.15])
            rows.append((10 * centre + i, ((base + noise) * rng.choice([1.0, 3.0])).astype(np.float32).tolist()))
    rows += [rows[3], rows[3], (None, rows[3][1]), (None, [1.0] * 32), (None, [1.0] * 32)]
    rows += [(1, None), (2, []), (3, [0.0] * 32), (4, [float("nan")] * 32), (5, [None] + [1.0] * 31)]
    rows += [(6, [float("inf")] + [1.0] * 31), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [3.0]), (11, [-0.0, 1.0]), (12, [0.0, 1.0])]
    return rows


def test_links_and_components_are_those_of_brute_force(spark):
    rows = table()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    for cell in (512, 7):  # cells of a few vectors: every filter is split
        got = caps.near_vectors(df, codes=24, cell=cell).collect()
        assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    r = rng.standard_normal((2000, 64))
    r -= (r * x).sum(axis=1, keepdims=True) * x
    y = 0.95 * x + math.sqrt(1 - 0.95**2) * r / np.linalg.norm(r, axis=1, keepdims=True)
    options = (caps.CODES, caps.BLOCKS, caps.CODEWORDS, caps.LEVEL, caps.SEED)
    sets = []
    for units in (x, y):
        row, own = caps.filter_lists(units, options)
        sets.append(set(zip(row.tolist(), own.tolist(), strict=True)))
    assert len({row for row, _ in sets[0] & sets[1]}) / 2000 > 0.99


def test_list_decoding_finds_all_directions_above_the_level():
    rng = np.random.default_rng(2)
    units = rng.standard_normal((50, 12))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    _, book = caps.codebook(12, 0, 3, 8, 1)
    row, own = caps.exceeded(units, book, 0.6 * math.sqrt(12))
    got = set(zip(row.tolist(), own.tolist(), strict=True))
    for n, u in enumerate(units):
        scores = {
            (a * 8 + b) * 8 + c: np.concatenate([book[0][1][a], book[1][1][b], book[2][1][c]]) @ u / math.sqrt(3)
            for a in range(8) for b in range(8) for c in range(8)
        }
        most = max(scores.values())
        assert {f for r, f in got if r == n} == {f for f, s in scores.items() if s >= min(0.6, most - 1e-9)}


def test_empty_table(spark):
    assert caps.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
