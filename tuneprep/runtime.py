"""Shared storage for intermediate tables, and small column helpers."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT = "split"

_local_dirs: dict[str, str] = {}
_job_dir: ContextVar[str | None] = ContextVar("job_dir", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tuneprep-")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    base = _job_dir.get() or f"{shared_dir(spark)}/tuneprep"
    return f"{base}/{name}-{uuid.uuid4().hex}"


@contextmanager
def temporary_tables(spark: SparkSession):
    """Remove the tables that ``materialize`` writes inside the block when it ends.

    For jobs that have written their result by then; a lazy result still needs its tables.
    """
    path = scratch_path(spark, "job")
    token = _job_dir.set(path)
    try:
        yield
    finally:
        _job_dir.reset(token)
        delete(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read and never a re-computation, and gives
    Catalyst the true size of the table. Outside of ``temporary_tables`` the files stay until the
    shared folder is cleaned.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._tp_path = path
    return stored


def drop_stored(stored: DataFrame) -> None:
    """Delete a table of ``materialize`` that nothing will read again, such as an earlier round."""
    delete(stored.sparkSession, stored._tp_path)


def _files(spark: SparkSession, path: str):
    """Hadoop's path and file system: whatever store the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, files = _files(spark, path)
    return files.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    target, files = _files(spark, path)
    return [f.getPath().getName() for f in files.listStatus(target)] if files.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    target, files = _files(spark, path)
    files.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a place that does not exist yet; without a source the place is an empty folder."""
    old, files = _files(spark, source)
    new, _ = _files(spark, target)
    files.mkdirs(new.getParent())
    if not files.exists(old):
        files.mkdirs(new)
    elif not files.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def create_small(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless the name is taken already: of several writers just one succeeds."""
    from py4j.protocol import Py4JJavaError

    target, files = _files(spark, path)
    try:
        stream = files.create(target, False)
    except Py4JJavaError:
        if files.exists(target):
            return False
        raise
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    return True


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small driver-side file, such as a manifest."""
    target, files = _files(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and move it there: it is never seen half written."""
    target, files = _files(spark, path)
    draft, _ = _files(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = files.create(draft, True)
    stream.write(text.encode())
    stream.close()
    if not files.rename(draft, target):
        files.delete(draft, False)
        raise FileExistsError(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="tuneprep-")) / root.name), "zip", root.parent, root.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


#: Rows of one Arrow batch, where the session leaves Spark's default: texts may be long, and a worker
#: holds a batch of them several times over.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare_workers(spark: SparkSession) -> None:
    """Ship the package and bound the batches; a session's own batch size is left alone."""
    ship_package(spark)
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def column(name: str) -> Column:
    """Reference a top-level column whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")
