"""What several operators of this subpackage share."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneprep.runtime import column, materialize, prepare_workers  # noqa: F401

#: Longest run of star contractions; each halves the longest path at least, so 60 exceeds any graph.
MAX_ROUNDS = 60


_FREED_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_freed(spark: SparkSession):
    """Let Spark delete a query's shuffle files when the query ends, as for a table that is stored then.

    Without it they stay until the driver collects its garbage, beside those of the queries after it.
    """
    before = spark.conf.get(_FREED_SETTING, "false")
    spark.conf.set(_FREED_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED_SETTING, before)


def fresh(name: str) -> str:
    """A column name that no input can clash with."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of all columns; rows are equal if both are."""
    values = [column(c) for c in df.columns]
    given = [v.isNotNull() for v in values]  # the hash itself passes nulls over
    return F.xxhash64(*values, *given), F.xxhash64(F.lit("row"), *values, *given)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(texts: pa.Array) -> list:
    """The UTF-8 of each text, nothing decoded; a null text is empty."""
    binary = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
    return [b"" if x is None else x for x in binary.to_pylist()]


_worker_state: dict = {}


def worker_state(kind: str, shared, build):
    """What a Python worker keeps between batches for one broadcast value.

    Workers outlive a query, so a new value replaces whatever was kept, of any kind.
    """
    key = (kind, id(shared.value))
    if key not in _worker_state:
        _worker_state.clear()
        pa.default_memory_pool().release_unused()  # what the batches of an earlier stage left over
        _worker_state[key] = build(shared.value)
    return _worker_state[key]


def id_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; 0 (held out) for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod, F.lit(0))


def _size_and_sum(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))
    ).first()
    return row[0], row[1]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component``: the smallest node reachable from every node that has a link.

    Alternating large- and small-star contraction on the links. Each round is a few equi-joins and
    partial minima; its links are stored in the shared folder, so nothing is recomputed when an
    executor is lost, and no neighbourhood is ever gathered in one row. Links of a node with itself,
    nulls and repeated links are ignored; without links the result is empty.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = materialize(
        links.select(F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi"))
        .filter("lo < hi")
        .distinct(),
        "links",
    )
    state = _size_and_sum(edges)
    for _ in range(MAX_ROUNDS):
        if state[0] == 0:
            break
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(
            edges.select("hi", "lo")
        )
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = (
            both.filter("v > u")
            .join(least, "u")
            .select(F.col("m").alias("lo"), F.col("v").alias("hi"))
            .distinct()
        )
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(lowest, "hi")
            .filter("lo > m")
            .select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
            .union(lowest.select(F.col("m").alias("lo"), "hi"))
            .distinct()
        )
        edges = materialize(small, "links")
        before, state = state, _size_and_sum(edges)
        if before == state:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
