"""Tables bucketed by a key: joins and aggregations on that key read them without a shuffle."""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tuneprep.runtime import column, path_exists, read_small, write_small

_LAYOUT = "_layout.json"


def write_bucketed(
    df: DataFrame, path: str, table: str, key: str, buckets: int, if_exists: str = "skip"
) -> DataFrame:
    """Store ``df`` under ``path`` in ``buckets`` files' worth of buckets by ``key``, sorted, and open it.

    Rows are shuffled once, to their bucket, so every bucket is one file. With ``skip`` a finished
    table under ``path`` is kept and opened as it is, with its own number of buckets.
    """
    if if_exists not in ("skip", "overwrite", "error"):
        raise ValueError(f"if_exists must be skip, overwrite or error, got {if_exists!r}")
    spark = df.sparkSession
    layout = f"{path}/{_LAYOUT}"
    if path_exists(spark, layout):
        if if_exists == "error":
            raise FileExistsError(f"a bucketed table is already stored under {path}")
        if if_exists == "skip":
            return open_bucketed(spark, path, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (
        df.repartition(buckets, column(key))
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    # Written last: it marks the table as finished, and lets another session register it again.
    write_small(spark, layout, json.dumps({"key": key, "buckets": buckets, "schema": df.schema.json()}))
    return spark.table(table)


def open_bucketed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The table that ``write_bucketed`` stored under ``path``, registered in this session."""
    layout = json.loads(read_small(spark, f"{path}/{_LAYOUT}"))
    schema = T.StructType.fromJson(json.loads(layout["schema"]))
    key = layout["key"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({fields}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def bucket_count(n_bytes: int, bucket_bytes: int = 128 * 1024 * 1024) -> int:
    """Buckets for about ``bucket_bytes`` each; tables to be joined need the same number."""
    return max(1, math.ceil(n_bytes / bucket_bytes))
