import hashlib
import math

import numpy as np
import pytest

from tuneprep.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, id int, vector string"


def brute(rows, k, rounds, components, scale=1024, seed=3):
    kept = []
    for vec_id, v in rows:
        if v is None or len(v) != components or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((vec_id, [math.floor(scale * x) for x in v]))

    def key(row):
        name = None if row[0] is None else hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest()
        return name is None, name or "", np.array(row[1], "<f8").tobytes()

    centres = [v for _, v in sorted(kept, key=key)[:k]]

    def assign():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres)))
        return out

    for _ in range(rounds):
        sides = assign()
        for j in range(len(centres)):
            own = [v for (_, v), (_, side) in zip(kept, sides, strict=True) if side == j]
            if own:
                centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    sides = assign()
    inertia = [sum(d for d, side in sides if side == j) for j in range(len(centres))]
    most = (1 << 63) - 1
    return [
        (i, j, min(d, most), min(inertia[j], most), min(sum(inertia), most),
         hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest())
        for (i, _), (d, j) in zip(kept, sides, strict=True)
    ]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 7, "clash") for i, v in rows], SCHEMA)


def points(n=150, components=6):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, components))
    rows = [(i, (centres[i % 5] + rng.normal(size=components) * 0.3).tolist()) for i in range(n)]
    # Ties, repeated rows and ids, null ids, and what takes no part.
    rows += [(n + i, [0.5] * components) for i in range(10)] + [rows[3], rows[3], (3, [1.0] * components)]
    rows += [(None, [0.25] * components), (None, [0.25] * components), (-1, None), (-2, [1.0]), (-3, [])]
    rows += [(-4, [math.nan] + [0.0] * (components - 1)), (-5, [None] + [0.0] * (components - 1))]
    return [*rows, (-6, [math.inf] * components)]


@pytest.mark.parametrize(("k", "rounds"), [(8, 10), (3, 2), (400, 3)])
def test_same_as_plain_rounds(spark, k, rounds):
    rows = points()
    counts = []
    got = centroids.cluster(frame(spark, rows), clusters=k, rounds=rounds, components=6, counts=counts)
    assert ordered(got.collect()) == ordered(brute(rows, k, rounds, 6))
    kept = len(brute(rows, k, rounds, 6))
    assert counts[0] == kept * min(k, kept)
    assert k == 400 or sum(counts[1:]) < 0.8 * kept * k * rounds  # the bounds spare evaluations


def test_numbers_beyond_64_bits(spark):
    rows = [(i, [1e30 * (i % 3), float(i), -1e20 * i]) for i in range(40)]
    got = centroids.cluster(frame(spark, rows), clusters=4, rounds=4, components=3)
    assert ordered(got.collect()) == ordered(brute(rows, 4, 4, 3))


def test_bounds_hold_through_any_history():
    rng = np.random.default_rng(7)
    vectors = np.floor(rng.normal(size=(300, 5)) * 200)
    cluster, bounds = np.full(300, -1), np.zeros((300, 6))
    rounds, past = np.zeros((300, 6), np.int64), []
    centres = np.floor(rng.normal(size=(6, 5)) * 200)
    for turn in range(25):
        # Centres wander to and fro: their total displacement is far below the length of the way.
        centres = np.floor(centres + rng.normal(size=centres.shape) * (40 if turn % 5 == 0 else 5) * (-1) ** turn)
        past.append([[int(x) for x in c] for c in centres])
        history = centroids.History(list(past))
        centroids.reassign(vectors, cluster, bounds, rounds, history)
        square = ((vectors[:, None] - centres[None]) ** 2).sum(axis=2)
        assert (cluster == square.argmin(axis=1)).all()
        slack = history.displacement[rounds, np.arange(6)[None, :]]
        assert (np.abs(np.sqrt(square) - bounds) <= slack + 1e-6).all()


def test_empty_tables(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        got = centroids.cluster(frame(spark, rows), components=6)
        assert got.collect() == []
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
