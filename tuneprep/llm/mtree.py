"""Exact top-k by inner product: best-first search of an M-tree.

The first level is spread over the cluster: each vector belongs to the nearest of a few routing
vectors (a bounded sample, ``routes``), and the vectors of a routing vector fall into parts of
bounded size. Every part meets every block of queries in a task of its own, where the part is a tree
of pages: a node stores its routing vector, its covering radius, and its distance to the parent's
routing vector; a leaf page stores its entries' distances likewise. For a query q and anything at
distance d from a known vector p, the inner product is at most q.p + |q| d. So a node whose stored
distances rule it out against the k-th best score so far is passed over without computing anything
for it, and the others are taken up in the order of their bounds. Ties are kept, nothing is
approximate; the best of all parts are merged per query.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tuneprep.llm.common import prepare_workers, table
from tuneprep.runtime import column, materialize

K = 20
SCALE = 64
QUERY_EVERY = 20
ROUTES = 8
PART = 32_768
QUERY_BLOCK = 2048

_PAGE = 256
_FAN_OUT = 16
_EXACT = 1 << 53


def _distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - centre) ** 2).sum(axis=1))


class Node:
    """A page: children, or the rows of a leaf with their distances to the routing vector."""

    __slots__ = ("children", "distances", "parent", "radius", "routing", "rows")

    def __init__(self, x: np.ndarray, rows: np.ndarray, routing: np.ndarray, above=None):
        self.routing = routing
        distances = _distances(x[rows], routing)
        self.radius = float(distances.max())
        self.parent = 0.0 if above is None else float(np.sqrt(((routing - above) ** 2).sum()))
        self.children: list[Node] = []
        self.rows = self.distances = None
        groups = self._split(x, rows) if len(rows) > _PAGE else []
        if len(groups) < 2:  # a page's worth, or vectors that are all the same
            order = np.argsort(distances, kind="stable")
            self.rows, self.distances = rows[order], distances[order]
        else:
            self.children = [Node(x, own, c, routing) for c, own in groups]

    @staticmethod
    def _split(x, rows):
        """Rows by the nearest of some of them, chosen far apart."""
        chosen = [rows[0]]
        nearest = _distances(x[rows], x[rows[0]])
        home = np.zeros(len(rows), np.int64)
        while len(chosen) < _FAN_OUT and nearest.max() > 0:
            chosen.append(rows[int(nearest.argmax())])
            d = _distances(x[rows], x[chosen[-1]])
            home[d < nearest] = len(chosen) - 1
            nearest = np.minimum(nearest, d)
        return [(x[c], own) for k, c in enumerate(chosen) if len(own := rows[home == k])]


class _Best:
    """The k best (score, id) of each query."""

    def __init__(self, queries: int, k: int):
        self.k, self.count = k, queries
        self.bar = np.full(queries, -np.inf)
        self.query, self.score, self.id = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64))
        self.waiting: list[tuple] = []
        self.size = 0

    def add(self, query, score, ids):
        self.waiting.append((query, score, ids))
        self.size += len(query)
        if self.size > 4 * self.count:
            self.merge()

    def merge(self):
        parts = [(self.query, self.score, self.id), *self.waiting]
        query, score, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.searchsorted(query, np.arange(self.count))
        place = np.arange(len(query)) - first[query]
        keep = place < self.k
        self.query, self.score, self.id = query[keep], score[keep], ids[keep]
        last = place == self.k - 1
        self.bar[query[last]] = score[last]
        self.waiting, self.size = [], 0


def search(x, ids, queries, own_numbers, k: int = K, numbers=None):
    """(query row, score, id) of the ``k`` best rows of ``x`` for each query, its own row left out.

    That is the row whose number (of ``numbers``, else of ``ids``) is the query's own.
    """
    numbers = ids if numbers is None else numbers
    most = max(1, int(np.abs(x).max(initial=0))) * max(1, int(np.abs(queries).max(initial=0))) * x.shape[1]
    exact = most < _EXACT
    xs, qs = (x.astype(np.float64), queries.astype(np.float64))
    norms = np.sqrt((qs**2).sum(axis=1))
    slack = 1e-9 * float(most) + 1e-9
    best = _Best(len(queries), k)
    root = Node(xs, np.arange(len(x)), xs[0])
    everyone = np.arange(len(queries))
    dots = qs @ root.routing
    heap = [(-np.inf, 0, root, everyone, dots)]
    number = 0
    while heap:
        _, _, node, active, dots = heapq.heappop(heap)
        going = dots + norms[active] * node.radius + slack >= best.bar[active]
        active, dots = active[going], dots[going]
        if not len(active):
            continue
        for child in node.children:
            reach = child.parent + child.radius
            near = dots + norms[active] * reach + slack >= best.bar[active]
            own = active[near]
            if len(own):
                own_dots = qs[own] @ child.routing
                bound = own_dots + norms[own] * child.radius
                number += 1
                heapq.heappush(heap, (-float(bound.max()), number, child, own, own_dots))
        if node.rows is None:
            continue
        # Entries stand by distance: what the farthest query can still need is one stretch of them.
        need = (best.bar[active] - slack - dots) / np.maximum(norms[active], 1e-300)
        needed = np.searchsorted(node.distances, need.min() - slack)
        rows = node.rows[needed:]
        if not len(rows):
            continue
        if exact:
            scores = (qs[active] @ xs[rows].T).astype(np.int64)
        else:
            scores = np.array(queries[active].astype(object) @ x[rows].T.astype(object))
            if np.abs(scores).max() >= 1 << 63:
                raise OverflowError("an inner product exceeds 64 bits")
            scores = scores.astype(np.int64)
        own = numbers[rows][None, :] == own_numbers[active][:, None]
        bar = best.bar[active][:, None]
        if len(rows) > k + 1:  # beyond the k + 1 best of a page, none is among the k best
            bar = np.maximum(bar, np.partition(scores, len(rows) - k - 1, axis=1)[:, [-k - 1]])
        q, r = np.nonzero((scores >= bar) & ~own)
        best.add(active[q], scores[q, r], ids[rows[r]])
        if not np.isfinite(best.bar[active]).all():
            best.merge()
    best.merge()
    return best.query, best.score, best.id


def _matrix(lists) -> np.ndarray:
    chunks = lists.combine_chunks()
    chunks = chunks.chunk(0) if isinstance(chunks, pa.ChunkedArray) else chunks
    return chunks.flatten().to_numpy().reshape(len(chunks), -1)


def _search_cell(k):
    def run(key, part: pa.Table, block: pa.Table) -> pa.Table:
        query = score = ids = query_ids = np.zeros(0, np.int64)
        if part.num_rows and block.num_rows:
            own = block.column("query_row").to_numpy()
            at, score, ids = search(
                _matrix(part.column("v")), part.column("id").to_numpy(),
                _matrix(block.column("v")), own, k, part.column("row").to_numpy(),
            )
            query, query_ids = own[at], block.column("query_id").to_numpy()[at]
        return pa.table({"query_row": query, "query_id": query_ids, "vec_id": ids, "score": score})

    return run


def _nearest_route(routes: dict[int, np.ndarray]):
    @F.arrow_udf("int")
    def nearest(vectors: pa.Array) -> pa.Array:
        lengths = np.diff(vectors.offsets.to_numpy())
        out = np.zeros(len(vectors), np.int32)
        for dim in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == dim)
            if dim in routes and dim:
                x = vectors.take(pa.array(at)).flatten().to_numpy().reshape(-1, dim).astype(float)
                away = np.stack([_distances(x, r) for r in routes[dim].astype(float)], axis=1)
                out[at] = away.argmin(axis=1)
        return pa.array(out)

    return nearest


def top_k(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    query_every: int = QUERY_EVERY,
    scale: int = SCALE,
    routes: int = ROUTES,
    part: int = PART,
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest integer inner products of each query.

    Components become floor(scale * x). Queries are the rows whose id is divisible by
    ``query_every``, each a query of its own though its id may repeat; candidates are all rows but the
    query's own with a vector of the same length (all, if fewer than ``k``); ties go to the smaller
    id. Rows without id take no part, nor do vectors that are null, empty, or hold a null or a
    non-finite number. An empty table gives no rows, and other columns are not read. Products beyond
    64 bits are an error.
    """
    prepare_workers(rows.sparkSession)
    v = column(vector_col).cast("array<double>")
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    usable = materialize(
        rows.filter(column(id_col).isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size(v) > 0))
        .select(
            column(id_col).cast("long").alias("id"),
            F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v"),
        )
        .withColumn("dim", F.size("v"))
        .withColumn("row", F.monotonically_increasing_id()),  # stored, so it stays with its row
        "search-vectors",
    )
    sample = usable.orderBy(F.xxhash64("id"), "v").limit(routes).select("dim", "v").collect()
    by_dim: dict[int, list] = {}
    for row in sample:
        by_dim.setdefault(row.dim, []).append(row.v)
    nearest = _nearest_route({d: np.array(x, np.int64) for d, x in by_dim.items()})
    routed = materialize(usable.withColumn("route", nearest("v")), "search-routes")
    parts = (
        routed.groupBy("dim", "route")
        .count()
        .select("dim", "route", F.ceil(F.col("count") / part).cast("int").alias("parts"))
    )
    queries = usable.filter(F.col("id") % query_every == 0).select(
        F.col("row").alias("query_row"), F.col("id").alias("query_id"), "v", "dim"
    )
    blocks = queries.groupBy("dim").count().select(
        "dim", F.ceil(F.col("count") / block).cast("int").alias("blocks")
    )
    hashed = F.xxhash64("row")
    cells = (
        routed.join(parts, ["dim", "route"])
        .join(blocks, "dim")
        .select(
            "dim",
            "route",
            F.pmod(hashed, F.col("parts")).cast("int").alias("part"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
            "row",
            "id",
            "v",
        )
    )
    asked = (
        queries.join(blocks, "dim")
        .withColumn("block", F.pmod(F.xxhash64("query_row"), F.col("blocks")).cast("int"))
        .join(parts, "dim")
        .select(
            "dim",
            "route",
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            "block",
            "query_row",
            "query_id",
            "v",
        )
    )
    keys = ["dim", "route", "part", "block"]
    # Fresh names, as both sides come from the same columns.
    asked = asked.toDF(*[f"asked_{c}" for c in keys], "query_row", "query_id", "v")
    found = (
        cells.groupBy(*keys)
        .cogroup(asked.groupBy(*[f"asked_{c}" for c in keys]))
        .applyInArrow(_search_cell(k), "query_row long, query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op5_mtree(spark, sf_dir):
    """The 20 best of every twentieth vector."""
    return top_k(table(spark, sf_dir, "embeddings"))


OP5_SQL = f"""
WITH usable AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(x * {SCALE}) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id,
    CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.row <> c.row AND len(q.v) = len(c.v)
  WHERE q.vec_id % {QUERY_EVERY} = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}"""
