"""Raw splits."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneprep.runtime import SPLIT

# Columns that give the rows of a Parquet source the order they are stored in.
ROW_ORDER = ("source_file", "source_row")

_FORMATS = {"parquet": "parquet", "json": "json", "jsonl": "json"}


def load_split(
    spark: SparkSession,
    path: str,
    split: str,
    schema=None,
    fmt: str | None = None,
    split_col: str = SPLIT,
    row_order: bool = False,
) -> DataFrame:
    """One named split of a Parquet or JSON-lines source, tagged with its name.

    JSON needs a schema: inferring one would read the whole source an extra time. ``row_order``
    adds the ``ROW_ORDER`` columns, for a source without an order column of its own; the reader
    knows them, so they cost no shuffle. Only Parquet numbers its rows.
    """
    fmt = _FORMATS.get(fmt or path.rstrip("/").rsplit(".", 1)[-1].lower())
    if fmt is None:
        raise ValueError(f"cannot tell the format of {path!r}: pass fmt='parquet' or fmt='json'")
    if fmt == "json" and schema is None:
        raise ValueError("a JSON source needs a schema")
    if row_order and fmt != "parquet":
        raise ValueError("only Parquet rows have a stored order: name an order column instead")
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.format(fmt).load(path)
    if row_order:
        file_col, row_col = ROW_ORDER
        rows = rows.select(
            "*",
            F.col("_metadata.file_path").alias(file_col),
            F.col("_metadata.row_index").alias(row_col),
        )
    return rows.withColumn(split_col, F.lit(split))


def load_splits(
    spark: SparkSession,
    paths: Mapping[str, str],
    schema=None,
    fmt: str | None = None,
    row_order: bool = False,
) -> DataFrame:
    """All splits in one plan. A filter on the split prunes the other sources."""
    if not paths:
        raise ValueError("no splits given")
    parts = [
        load_split(spark, path, split, schema, fmt, row_order=row_order)
        for split, path in paths.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
