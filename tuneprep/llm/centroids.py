"""Centroid clustering with norm-of-sum bounds: distances are evaluated only where bounds fail.

Every vector carries, for each centroid, the distance that was last evaluated and the round of that
evaluation. The history of all centroids is kept. A bound is loosened by the norm of the centroid's
*total* displacement since that round, which is at most, and mostly far below, the sum of its drifts
round by round. Where a loosened bound of another centroid falls below that of the own one, distances
are evaluated anew, exactly, in integers; bounds carry a margin for rounding and decide only if
they are strictly apart, so ties still go to the smaller number.

The state of a round (vector, cluster, bounds) is a table in the shared folder and replaces that of
the round before. Sums follow the vectors that changed sides: per task, one row per centroid and
component travels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tuneprep.llm.common import fresh, prepare_workers, table
from tuneprep.runtime import column, drop_stored, materialize

CLUSTERS = 8
ROUNDS = 10
COMPONENTS = 64
SCALE = 1024
SEED = 3

#: Integers up to here give exact squared distances of 64 components in doubles; beyond it,
#: arithmetic is on Python integers.
_EXACT = 1 << 22
#: Largest scaled component: that of a 32-bit float. Sums of any number of them fit two decimals.
_LARGEST = 2.0**139
_LIMB = 1 << 60
_MARGIN = 1e-9
_LONGEST = (1 << 63) - 1


@dataclass
class History:
    """Centroids of every round so far, as exact integers."""

    rounds: list[list[list[int]]]
    #: displacement[s][j]: how far centroid j has moved since round s, rounded up.
    displacement: np.ndarray = field(init=False)
    small: bool = field(init=False)

    def __post_init__(self):
        now = np.array(self.rounds[-1], object)
        moved = []
        for past in self.rounds:
            gap = now - np.array(past, object)
            moved.append([float((g * g).sum()) ** 0.5 for g in gap])
        self.displacement = np.array(moved) * (1 + _MARGIN)
        self.small = all(abs(x) <= _EXACT for c in self.rounds[-1] for x in c)

    @property
    def current(self) -> int:
        return len(self.rounds) - 1


def scaled_vectors(values: pa.Array, components: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, integers as doubles) of the vectors that take part.

    Those have exactly ``components`` components, none null or non-finite. ``floor(scale * x)`` of a
    double is a double, so nothing is rounded.
    """
    lists = values.cast(pa.large_list(pa.float64()))
    lengths = np.where(lists.is_valid(), lists.value_lengths().fill_null(-1), -1)
    places = np.flatnonzero(lengths == components)
    flat = lists.take(pa.array(places)).flatten()
    holes = np.asarray(flat.is_null()).reshape(-1, components)
    numbers = flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, components)
    with np.errstate(over="ignore", invalid="ignore"):
        numbers = np.floor(numbers * scale)
        ok = ~holes.any(axis=1) & (np.abs(numbers) < _LARGEST).all(axis=1)
    return places[ok], numbers[ok] + 0.0


def _plain(vectors: np.ndarray, history: History) -> bool:
    """Whether doubles hold all squared distances exactly."""
    return history.small and (not len(vectors) or bool(np.abs(vectors).max() <= _EXACT))


def _squared(vectors: np.ndarray, centroid: list[int], plain: bool) -> np.ndarray:
    """Exact squared distances: integers in doubles where they fit, else Python integers."""
    if plain:
        gap = vectors - np.array(centroid, np.float64)
        return np.einsum("ij,ij->i", gap, gap)
    gap = np.array([[int(x) for x in v] for v in vectors], object).reshape(vectors.shape)
    gap = gap - np.array(centroid, object)
    return (gap * gap).sum(axis=1)


def reassign(
    vectors: np.ndarray, cluster: np.ndarray, bounds: np.ndarray, rounds: np.ndarray, history: History
) -> tuple[np.ndarray, int]:
    """Nearest centroid of each vector, in place, and (clusters before, distances evaluated).

    ``bounds`` has the distance to each centroid as it was in round ``rounds``; both are replaced
    wherever a distance is evaluated. A cluster of -1 has no bounds yet.
    """
    before, now = cluster.copy(), history.current
    k = bounds.shape[1]
    centroids = history.rounds[-1]
    plain = _plain(vectors, history)
    exact = np.full(bounds.shape, np.inf, np.float64 if plain else object)
    evaluated = 0

    def look(rows, j):
        nonlocal evaluated
        if not len(rows):
            return
        found = _squared(vectors[rows], centroids[j], plain)
        exact[rows, j] = found
        bounds[rows, j] = np.sqrt(found.astype(np.float64))
        rounds[rows, j] = now
        evaluated += len(rows)

    fresh_rows = np.flatnonzero(cluster < 0)
    for j in range(k):
        look(fresh_rows, j)
    moved = history.displacement[rounds, np.arange(k)[None, :]]
    lower = bounds * (1 - _MARGIN) - moved
    own = np.where(cluster < 0, 0, cluster)
    every = np.arange(len(vectors))
    upper = bounds[every, own] * (1 + _MARGIN) + moved[every, own]
    lower[every, own] = np.inf
    # First the own distance alone is made exact; it may settle the matter.
    doubtful = np.flatnonzero((cluster >= 0) & (lower <= upper[:, None]).any(axis=1))
    for j in range(k):
        look(doubtful[own[doubtful] == j], j)
    upper[doubtful] = bounds[doubtful, own[doubtful]] * (1 + _MARGIN)
    for j in range(k):
        rows = doubtful[lower[doubtful, j] <= upper[doubtful]]
        look(rows, j)
    settled = np.concatenate([fresh_rows, doubtful])
    if len(settled):  # the first of equal distances is that of the smaller number
        cluster[settled] = np.argmin(exact[settled], axis=1)
    return before, evaluated


def _pack(own: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(own.values()), list(own))


def _rows(array: np.ndarray, kind: str) -> pa.Array:
    return pa.array([row.tobytes() for row in array.astype(kind)], pa.binary())


def _unpack(batch: pa.RecordBatch, name: str, kind: str) -> np.ndarray:
    data = batch.column(name).to_pylist()
    return np.frombuffer(b"".join(data), kind).reshape(len(data), -1)


def _prepare(components: int, scale: int):
    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, numbers = scaled_vectors(batch.column(1), components, scale)
            yield _pack(
                {"id": batch.column(0).take(pa.array(places)), "vector": _rows(numbers, "<f8")}
            )

    return prepare


def _round(shared, k: int):
    """State of the next round: cluster, the one before, bounds and their rounds."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _unpack(batch, "vector", "<f8")
            if "cluster" in batch.schema.names:
                cluster = batch.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64)
                bounds = _unpack(batch, "bounds", "<f8").copy()
                rounds = _unpack(batch, "rounds", "<u2").astype(np.int64)
            else:
                cluster = np.full(len(vectors), -1)
                bounds = np.zeros((len(vectors), k))
                rounds = np.zeros((len(vectors), k), np.int64)
            before, evaluated = reassign(vectors, cluster, bounds, rounds, history)
            counted = np.zeros(len(vectors), np.int64)
            counted[0] = evaluated
            yield _pack(
                {
                    "id": batch.column("id"),
                    "vector": batch.column("vector"),
                    "cluster": pa.array(cluster, pa.int32()),
                    "was": pa.array(before, pa.int32()),
                    "bounds": _rows(bounds, "<f8"),
                    "rounds": _rows(rounds, "<u2"),
                    "evaluated": pa.array(counted),
                }
            )

    return step


def _integers(vectors: np.ndarray) -> np.ndarray:
    if not len(vectors) or np.abs(vectors).max() < 2.0**40:
        return vectors.astype(np.int64)  # sums of a batch stay far inside 64 bits
    return np.array([[int(x) for x in v] for v in vectors], object)


def _moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, what each cluster won and lost: rows and the sum of every component."""
    totals: dict[int, list] = {}
    for batch in batches:
        vectors = _integers(_unpack(batch, "vector", "<f8")) if batch.num_rows else None
        for name, sign in (("cluster", 1), ("was", -1)):
            side = batch.column(name).to_numpy(zero_copy_only=False)
            for j in np.unique(side[side >= 0]).tolist():
                own = vectors[side == j]
                held = totals.setdefault(j, [0, [0] * vectors.shape[1]])
                held[0] += sign * len(own)
                held[1] = [a + sign * b for a, b in zip(held[1], own.sum(axis=0).tolist(), strict=True)]
    rows = [(j, i, n, *divmod(x, _LIMB)) for j, (n, s) in totals.items() for i, x in enumerate(s)]
    kinds = {"j": pa.int32(), "i": pa.int32(), "rows": pa.int64()}
    columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds.values())]
    columns += [pa.array([Decimal(r[c]) for r in rows], pa.decimal128(38, 0)) for c in (3, 4)]
    yield pa.RecordBatch.from_arrays(columns, [*kinds, "high", "low"])


def _start(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest hash; nulls last, ties by their components."""
    shown = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = (
        vectors.select(shown.alias("hash"), "vector")
        .orderBy(F.asc_nulls_last("hash"), "vector")
        .limit(k)
        .collect()
    )
    return [[int(x) for x in np.frombuffer(bytes(row.vector), "<f8")] for row in chosen]


def _squares_to_own(shared):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _unpack(batch, "vector", "<f8")
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
            out = [0] * len(vectors)
            for j in np.unique(cluster).tolist():
                rows = np.flatnonzero(cluster == j)
                found = _squared(vectors[rows], history.rounds[-1][j], _plain(vectors, history))
                for i, x in zip(rows, found, strict=True):
                    out[i] = min(int(x), _LONGEST)
            yield _pack(
                {
                    "id": batch.column("id"),
                    "cluster": batch.column("cluster"),
                    "distance": pa.array(out, pa.int64()),
                }
            )

    return measure


def _digest(centroid: list[int]) -> Column:
    return F.sha2(F.lit(",".join(map(str, centroid))), 256)


def cluster(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: int = SEED,
    counts: list | None = None,
) -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector kept.

    Vectors of exactly ``components`` finite components become integers ``floor(scale * x)``; null
    vectors, other lengths, null or non-finite components (also once scaled, or beyond the range of
    a 32-bit float) take no part. Centroids start as the vectors with the smallest sha256 of
    ``seed:id`` and move to the floor of the exact mean in each round; fewer vectors make fewer
    centroids. Ties go to the smaller number. Ids may be null (they start last) or repeat, every row
    counts; other columns are not read; an empty table gives no rows. Distances and sums beyond 64
    bits are given as the largest number. ``counts`` receives the distances evaluated in each round.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    kind = df.schema[id_col].dataType
    base = [T.StructField("id", kind), T.StructField("vector", T.BinaryType())]
    state_schema = T.StructType(
        [
            *base,
            T.StructField("cluster", T.IntegerType()),
            T.StructField("was", T.IntegerType()),
            T.StructField("bounds", T.BinaryType()),
            T.StructField("rounds", T.BinaryType()),
            T.StructField("evaluated", T.LongType()),
        ]
    )
    state = materialize(
        df.select(column(id_col).alias("id"), column(vector_col).alias("vector")).mapInArrow(
            _prepare(components, scale), T.StructType(base)
        ),
        "vectors",
    )
    start = _start(state, clusters, seed)
    history = History([start]) if start else None
    k = len(start)
    rows, sums = [0] * k, [[0] * components for _ in range(k)]
    for turn in range(rounds + 1 if start else 0):
        shared = spark.sparkContext.broadcast(history)
        older, state = state, materialize(
            state.mapInArrow(_round(shared, k), state_schema), f"assigned-{turn}"
        )
        drop_stored(older)
        if counts is not None:
            counts.append(state.agg(F.sum("evaluated")).first()[0])
        if turn == rounds:
            break
        # Centroids times components rows, whatever the data.
        moved = (
            state.filter("cluster <> was")
            .select("vector", "cluster", "was")
            .mapInArrow(_moves, "j int, i int, rows long, high decimal(38,0), low decimal(38,0)")
            .groupBy("j", "i")
            .agg(F.sum("rows").alias("rows"), F.sum("high").alias("high"), F.sum("low").alias("low"))
            .collect()
        )
        for m in moved:
            sums[m.j][m.i] += int(m.high) * _LIMB + int(m.low)
            rows[m.j] += m.rows if m.i == 0 else 0
        following = [
            [s // n for s in own] if n else last
            for own, n, last in zip(sums, rows, history.rounds[-1], strict=True)
        ]
        history = History([*history.rounds, following])
    if not start:
        found = state.select(
            "id", F.lit(0).cast("int").alias("cluster"), F.lit(0).cast("long").alias("distance")
        )
        totals, digests = [], []
    else:
        shared = spark.sparkContext.broadcast(history)
        out = T.StructType(
            [base[0], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
        )
        older, found = state, materialize(
            state.select("id", "cluster", "vector").mapInArrow(_squares_to_own(shared), out), "clusters"
        )
        drop_stored(older)
        totals = [0] * k
        for row in (
            found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
        ):
            totals[row.cluster] = int(row.d)
        digests = [_digest(c) for c in history.rounds[-1]]

    def held(x):
        return F.lit(min(x, _LONGEST)).cast("long")

    own = F.col("cluster")
    id_name = fresh("id")
    return found.withColumnRenamed("id", id_name).select(
        column(id_name).alias(id_col),
        "cluster",
        "distance",
        (F.get(F.array(*map(held, totals)), own) if totals else held(0)).alias("cluster_inertia"),
        held(sum(totals)).alias("inertia"),
        (F.get(F.array(*digests), own) if digests else F.lit("")).alias("centroid_sha256"),
    )


def op11_centroids(spark, sf_dir):
    """Clusters of all embeddings."""
    return cluster(table(spark, sf_dir, "embeddings"))


def _rounds_sql() -> str:
    """One assignment and one move for each round, written out."""
    parts = []
    for t in range(ROUNDS + 1):
        parts.append(f"""
measured{t} AS MATERIALIZED (
  SELECT row, j, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
  FROM vectors, centroids{t}),
assigned{t} AS MATERIALIZED (
  SELECT row, j, d FROM measured{t} QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, j) = 1)""")
        if t < ROUNDS:
            parts.append(f"""
sums{t} AS (
  SELECT j, i, sum(v[i])::BIGINT AS s, count(*) AS n
  FROM assigned{t} JOIN vectors USING (row), (SELECT unnest(range(1, {COMPONENTS + 1})) AS i) GROUP BY j, i),
means{t} AS (SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM sums{t} GROUP BY j),
centroids{t + 1} AS MATERIALIZED (
  SELECT j, coalesce(m.c, o.c) AS c FROM centroids{t} o LEFT JOIN means{t} m USING (j))""")
    return ",".join(parts)


OP11_SQL = f"""
WITH kept AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = {COMPONENTS}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM kept),
centroids0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS j, v AS c
  FROM vectors QUALIFY j < {CLUSTERS}),{_rounds_sql()}
SELECT vec_id, j::INTEGER AS cluster, d AS distance,
  (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM assigned{ROUNDS} JOIN vectors USING (row) JOIN centroids{ROUNDS} USING (j)"""
