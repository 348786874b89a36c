"""Near copies among vectors by spherical-cap filters.

A filter is a direction; a vector is in every filter whose direction it meets at ``level`` or more,
in standard deviations of the cosine of random directions. The directions are a product code: the coordinates fall into blocks, each block has its
own random unit codewords, and a direction is one codeword of each block. A vector is decoded to the
list of all filters it exceeds block by block, dropping what cannot reach the level any more, so the
work follows the list and not the number of filters. Vectors that share a filter are compared
exactly; a pair is counted in the first filter it shares. Equal vectors are one row throughout.

Several codes in rotated coordinates even out the lengths of the lists, and the nearest direction of
each code is always in the list. Measured on random pairs of 64 coordinates at cosine 0.95, which is
the hardest case (``tests/llm/test_caps.py``), the recall is 0.998 with 15 filters a vector. More
filters (``codewords``, ``blocks``) keep the candidates of larger tables few.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneprep.llm.common import components, prepare_workers, table
from tuneprep.runtime import column, materialize

THRESHOLD = 0.95
CODES = 12
BLOCKS = 2
CODEWORDS = 128
LEVEL = 3.84
SEED = 42
#: A filter with more vectors than this is compared block by block, each pair of blocks on its own.
CELL = 512

_PAIRS = 1 << 18
_DIM_SHIFT = 40


@lru_cache(maxsize=64)
def codebook(dim: int, code: int, blocks: int, codewords: int, seed: int):
    """A rotation, then coordinates and unit codewords of each block; no more blocks than coordinates."""
    rng = np.random.default_rng([seed, dim, code, codewords])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    edges = np.linspace(0, dim, min(blocks, dim) + 1).astype(int)
    book = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        # Few coordinates have few directions that differ; more words would only lengthen the lists.
        words = rng.standard_normal((min(codewords, 2 ** min(b - a, 30)), b - a))
        book.append((slice(a, b), words / np.linalg.norm(words, axis=1, keepdims=True)))
    return rotation, book


def exceeded(units: np.ndarray, book, level: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of every filter that a unit vector exceeds, in order of row, then filter."""
    scores = [units[:, at] @ words.T for at, words in book]
    need = level * np.sqrt(len(book) / units.shape[1])
    best = [s.max(axis=1) for s in scores]
    need = np.minimum(need, sum(best) - 1e-9)  # the nearest direction always is in the list
    row, code, total = np.arange(len(units)), np.zeros(len(units), np.int64), np.zeros(len(units))
    for k, score in enumerate(scores):
        still = sum(best[k + 1 :], np.zeros(len(units)))
        parts = []
        for a in range(0, len(row), 4096):
            own = row[a : a + 4096]
            sums = total[a : a + 4096, None] + score[own]
            i, j = np.nonzero(sums + still[own, None] >= need[own, None])
            parts.append((own[i], code[a : a + 4096][i] * score.shape[1] + j, sums[i, j]))
        row, code, total = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((code, row))
    return row[order], code[order]


def filter_lists(units: np.ndarray, options) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) over all codes; a filter's number begins with the length of the vectors."""
    codes, blocks, codewords, level, seed = options
    dim = units.shape[1]
    found = []
    for code in range(codes):
        rotation, book = codebook(dim, code, blocks, codewords, seed)
        row, own = exceeded(units @ rotation, book, level)
        found.append((row, own + code * codewords**blocks + (dim << _DIM_SHIFT)))
    row, own = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((own, row))
    return row[order], own[order]


def _decode(options):
    def run(batches):
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            lengths = np.diff(vectors.offsets.to_numpy())
            out_ids, out_lists = [], []
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                row, own = filter_lists(_units(vectors.take(pa.array(at)), dim), options)
                out_lists += np.split(own, np.searchsorted(row, np.arange(1, len(at))))
                out_ids += ids[at].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_ids, pa.int64()), pa.array(out_lists, pa.list_(pa.int64()))],
                ["class_id", "filters"],
            )

    return run


def _units(vectors: pa.ListArray, dim: int) -> np.ndarray:
    """Rows of length one. Each is first divided by its largest coordinate, so no square overflows."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the given ones connect, without circles."""
    up: dict[int, int] = {}

    def root(x):
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        r, s = root(x), root(y)
        if r != s:
            up[max(r, s)] = min(r, s)
            kept.append((x, y))
    return kept


class _Compare:
    """Compares the vectors of whole cells and sums up what they link to."""

    def __init__(self, threshold):
        self.threshold = threshold

    def cells(self, key, side, ids, copies, units, filters, lists):
        """Rows of complete cells in order; ``key`` numbers the cells."""
        starts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
        sizes = np.diff(np.append(starts, len(key)))
        found = []
        # Row i of a cell meets the rows after it; a slice of that triangle is compared at a time.
        later = np.repeat(starts + sizes, sizes) - np.arange(len(key)) - 1
        at = 0
        total = np.cumsum(later)
        while at < len(key):
            upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _PAIRS, "right")))
            n = later[at:upto]
            i = np.repeat(np.arange(at, upto), n)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            # A cell of two blocks compares rows of different blocks only (side 0 and 1; else 2).
            good = (side[i] == 2) | (side[i] != side[j])
            i, j = i[good], j[good]
            near = np.einsum("ij,ij->i", units[i], units[j]) >= self.threshold
            found.append((i[near], j[near]))
            at = upto
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        mine = self._first_shared(i, j, filters, lists)
        i, j = i[mine], j[mine]
        if not len(i):
            return []
        own = np.concatenate([ids[i], ids[j]])
        classes, back = np.unique(own, return_inverse=True)
        links = np.bincount(back, np.concatenate([copies[j], copies[i]]))
        rows = [(c, None, n) for c, n in zip(classes.tolist(), links.astype(int).tolist(), strict=True)]
        return rows + [(x, y, 0) for x, y in _forest(ids[i], ids[j])]

    def _first_shared(self, i, j, filters, lists):
        """Whether the filter of a pair's cell is the first one that both vectors exceed."""
        values, offsets = lists
        first = values[offsets[:-1]]
        mine = (first[i] == first[j]) & (filters[i] == first[i])
        rest = np.flatnonzero(first[i] != first[j])
        if not len(rest):
            return mine
        sizes = np.diff(offsets)
        width = int(sizes[np.concatenate([i[rest], j[rest]])].max())

        def padded(rows, blank):
            at = offsets[rows, None] + np.arange(width)
            inside = np.arange(width) < sizes[rows, None]
            return np.where(inside, values[np.minimum(at, len(values) - 1)], blank)

        step = max(1, (1 << 22) // (width * width))
        for part in np.split(rest, np.arange(step, len(rest), step)):
            own, other = padded(i[part], -1), padded(j[part], -2)
            own = np.where(own < filters[i[part], None], own, -1)
            mine[part] = ~(own[:, :, None] == other[:, None, :]).any(axis=(1, 2))
        return mine


def _compare(threshold):
    def run(batches):
        work, held = _Compare(threshold), []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            rows = pa.Table.from_batches(held).combine_chunks()
            key = [rows.column(c).to_numpy() for c in range(3)]
            # The last cell may go on in the next batch.
            other = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in key]))
            if len(other):
                cut = int(other[-1]) + 1
                yield from _results(work, rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
        if held:
            yield from _results(work, pa.Table.from_batches(held))

    return run


def _results(work, rows):
    rows = rows.combine_chunks()
    filters = rows.column(0).to_numpy()
    out = []
    for dim in np.unique(filters >> _DIM_SHIFT).tolist():
        own = rows.filter(pa.array(filters >> _DIM_SHIFT == dim)).combine_chunks()
        filt, i, j, ids, copies, part = (own.column(c).to_numpy() for c in (0, 1, 2, 3, 4, 7))
        vectors, lists = (
            c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (own.column(5), own.column(6))
        )
        offsets = lists.offsets.to_numpy()
        changed = np.logical_or.reduce([np.diff(x) != 0 for x in (filt, i, j)])
        key = np.concatenate([[0], np.cumsum(changed)])
        side = np.where(i == j, 2, part != i)
        out += work.cells(
            key, side, ids, copies, _units(vectors, dim), filt,
            (lists.flatten().to_numpy(), offsets - offsets[0]),
        )
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in out], pa.int64()) for k in range(3)], ["a", "b", "n"]
    )


def near_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    codes: int = CODES,
    blocks: int = BLOCKS,
    codewords: int = CODEWORDS,
    level: float = LEVEL,
    seed: int = SEED,
    cell: int = CELL,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    Links join vectors of one length whose cosine is ``threshold`` or more; ``n_links`` counts the
    other rows linked directly, ``component_id`` is the smallest id that links reach, the row's own
    included (null ids are passed over), ``kept`` says whether that is the row's own. Vectors that
    are null, empty, zero, or hold a null or a non-finite number link with nothing. Rows with equal
    vectors are linked with each other, and rows may repeat. An empty table gives no rows; other
    columns are not read.
    """
    prepare_workers(rows.sparkSession)
    given = rows.select(
        column(id_col).alias("id"),
        # Adding zero makes both zeros one.
        F.transform(column(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("v"),
    ).withColumn("ok", _usable(F.col("v")))
    usable = given.filter("ok").select("id", "v", F.xxhash64("v").alias("h"))
    classes = materialize(
        usable.groupBy("h", "v")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
        .withColumn("class_id", F.monotonically_increasing_id()),
        "vector-classes",
    )
    lists = materialize(
        classes.select("class_id", "v").mapInArrow(
            _decode((codes, blocks, codewords, level, seed)), "class_id long, filters array<long>"
        ),
        "filter-lists",
    )
    found = materialize(_links(classes, lists, threshold, cell), "vector-links")
    linked = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    label = components(found.filter("b is not null"), "a", "b")
    labelled = (
        classes.join(linked, classes["class_id"] == linked["a"], "left")
        .join(label, classes["class_id"] == label["node"], "left")
        .select(
            "h",
            "v",
            "least",
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component", "class_id").alias("component"),
        )
    )
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_vector = labelled.join(smallest, "component").select("h", "v", "n_links", "component_id")
    with_links = usable.join(by_vector, ["h", "v"], "left").select("id", "n_links", "component_id")
    alone = given.filter("not ok").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return with_links.union(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _usable(v):
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _links(classes: DataFrame, lists: DataFrame, threshold: float, cell: int) -> DataFrame:
    """``a, null, n``: class a is linked with n further rows; ``a, b, 0``: classes to be connected.

    Filters above ``cell`` vectors are known by their counts. Their vectors fall into blocks, and
    every pair of blocks is a cell of its own, so no task holds more than two blocks of a filter and
    no pair is left out.
    """
    counts = lists.select(F.explode("filters").alias("filter")).groupBy("filter").count()
    # A filter with a single vector has no pair.
    counts = counts.filter("count > 1").withColumn("parts", F.ceil(F.col("count") / cell).cast("int"))
    placed = (
        lists.select("class_id", "filters", F.explode("filters").alias("filter"))
        .join(counts, "filter")
        .withColumn("part", F.pmod(F.xxhash64("class_id"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )
    rows = placed.join(classes.select("class_id", "copies", "v"), "class_id").select(
        "filter",
        F.least("part", "other").alias("i"),
        F.greatest("part", "other").alias("j"),
        "class_id",
        "copies",
        "v",
        "filters",
        "part",
    )
    return (
        rows.repartition("filter", "i", "j")
        .sortWithinPartitions("filter", "i", "j")
        .mapInArrow(_compare(threshold), "a long, b long, n long")
    )


def op6_caps(spark, sf_dir):
    """Links and component of every vector."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP6_SQL = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (
  SELECT * FROM vectors
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM vectors
  UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counted ON vec_id = a"""
