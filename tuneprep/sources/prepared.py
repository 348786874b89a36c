"""Prepared tables on shared storage: one folder per split, written once, switched in one step.

Data lie in ``<path>/split=<name>/version=<id>/``. Which version of which split counts is said by the
last manifest, ``<path>/_manifests/<number>.json``. A job writes its data first, under a name that no
one reads, then adds a manifest, and only then deletes what the manifest replaced: whenever it stops,
readers have either all of the old data or all of the new.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tuneprep.runtime import SPLIT, column, create_small, delete, list_names, path_exists, read_small, rename

_MODES = {"skip": "ignore", "overwrite": "overwrite", "error": "errorifexists"}
_MANIFESTS = "_manifests"
_VERSION = "version"
#: Writers that lose the race for a manifest number try the next one, with the others' splits kept.
_ATTEMPTS = 100


def _checked_mode(if_exists: str) -> str:
    if if_exists not in _MODES:
        raise ValueError(f"if_exists must be one of {sorted(_MODES)}, got {if_exists!r}")
    return _MODES[if_exists]


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether an earlier job committed its output here."""
    return path_exists(spark, f"{path}/_SUCCESS")


def write_once(df: DataFrame, path: str, fmt: str, if_exists: str = "skip") -> bool:
    """Write ``df``; with ``skip`` a finished output is kept as it is. Returns whether it wrote.

    What an interrupted job left behind is no finished output: it is replaced.
    """
    mode = _checked_mode(if_exists)
    if if_exists == "skip":
        if is_complete(df.sparkSession, path):
            return False
        mode = "overwrite"
    df.write.mode(mode).format(fmt).save(path)
    return True


def partition_folder(spark: SparkSession, path: str, name: str, value: str) -> str:
    """Folder of a partition value, escaped as Spark escapes it, so that it reads back as it was."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{path}/{name}={escape(value)}"


# --- manifests ----------------------------------------------------------------------------------


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """(number, splits) of the last readable manifest; (0, {}) if there is none."""
    found = [n for n in list_names(spark, f"{path}/{_MANIFESTS}") if n.endswith(".json")]
    for name in sorted(found, reverse=True):
        try:
            text = read_small(spark, f"{path}/{_MANIFESTS}/{name}")
            return int(name.removesuffix(".json")), json.loads(text)["splits"]
        except ValueError:
            continue  # its writer stopped on the way: the one before still counts
    return 0, {}


def _switch(spark: SparkSession, path: str, written: Mapping[str, dict]) -> dict:
    """Add a manifest in which the ``written`` splits replace their older versions; returns those."""
    for attempt in range(_ATTEMPTS):
        number, splits = _manifest(spark, path)
        text = json.dumps({"splits": {**splits, **written}}, ensure_ascii=False)
        # Unreadable manifests of interrupted jobs may hold the next numbers.
        if create_small(spark, f"{path}/{_MANIFESTS}/{number + 1 + attempt:09d}.json", text):
            return {split: splits[split] for split in written if split in splits}
    raise RuntimeError(f"no manifest could be added under {path}")


def prepared_splits(spark: SparkSession, path: str) -> dict[str, dict]:
    """The finished splits under ``path``: ``folder`` and, if the job counted them, ``counts``."""
    return _manifest(spark, path)[1]


def pending_splits(
    spark: SparkSession, path: str, splits: Sequence[str], if_exists: str = "skip"
) -> list[str]:
    """The splits a ``write_prepared`` call would write. Ask first to leave out their preparation."""
    if if_exists != "skip":
        return list(splits)
    done = prepared_splits(spark, path)
    return [s for s in splits if s not in done]


def write_prepared(
    df: DataFrame,
    path: str,
    splits: Sequence[str],
    fmt: str = "json",
    if_exists: str = "skip",
    counts: Callable[[], Mapping[str, dict]] | None = None,
    compression: str | None = None,
) -> list[str]:
    """Write each split of ``df`` to a folder of its own and return the splits written.

    JSON lines in UTF-8 with non-ASCII text kept raw, or Parquet. All splits to be written come from
    one pass over ``df``. With ``skip`` a finished split is kept although another is missing,
    whatever the arguments say by now; with ``error`` none may be there; with ``overwrite`` the old
    data stay readable until the new are complete. What an interrupted job left behind is never
    read; ``vacuum`` deletes it. ``counts``, asked once the data are written, goes into the manifest.
    ``compression`` names a codec of the format, such as ``gzip``; without one JSON lines are plain.
    """
    _checked_mode(if_exists)
    spark = df.sparkSession
    if if_exists == "error":
        for split in set(splits) & prepared_splits(spark, path).keys():
            raise FileExistsError(f"split {split!r} already exists under {path}")
    todo = pending_splits(spark, path, splits, if_exists)
    if not todo:
        return []
    version = uuid.uuid4().hex
    staging = f"{path}/_staging-{version}"
    options = {"compression": compression} if compression else {}
    wanted = df.filter(column(SPLIT).isin(*todo))
    wanted.write.partitionBy(SPLIT).format(fmt).options(**options).save(staging)
    counted = counts() if counts else {}
    written = {}
    for split in todo:
        folder = f"{partition_folder(spark, path, SPLIT, split)}/{_VERSION}={version}"
        rename(spark, partition_folder(spark, staging, SPLIT, split), folder)
        written[split] = {"folder": folder.removeprefix(f"{path}/")}
        if split in counted:
            written[split]["counts"] = dict(counted[split])
    replaced = _switch(spark, path, written)
    for old in [staging, *[f"{path}/{split['folder']}" for split in replaced.values()]]:
        delete(spark, old)
    return todo


def read_prepared(spark: SparkSession, path: str, schema, fmt: str = "json") -> DataFrame:
    """All finished splits under ``path`` with an explicit schema (without the split column)."""
    from pyspark.sql import types as T

    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    own = [f for f in fields if f.name != SPLIT]
    partitions = [T.StructField(name, T.StringType()) for name in (SPLIT, _VERSION)]
    splits = prepared_splits(spark, path)
    if not splits:
        raise FileNotFoundError(f"nothing is prepared under {path}")
    folders = [f"{path}/{split['folder']}" for split in splits.values()]
    reader = spark.read.schema(T.StructType([*own, *partitions])).option("basePath", path)
    return reader.format(fmt).load(folders).drop(_VERSION)


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete what no manifest names: versions and stagings of jobs that stopped on the way.

    Not while another job writes there. Returns the folders deleted.
    """
    kept = {split["folder"] for split in prepared_splits(spark, path).values()}
    gone = []
    for name in list_names(spark, path):
        if name.startswith("_staging-"):
            gone.append(name)
        elif name.startswith(f"{SPLIT}="):
            own = [f"{name}/{version}" for version in list_names(spark, f"{path}/{name}")]
            gone += [folder for folder in own if folder not in kept]
    for folder in gone:
        delete(spark, f"{path}/{folder}")
    return sorted(gone)
