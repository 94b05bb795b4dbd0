"""Shared scratch space and the few file-system calls Spark has no DataFrame API for."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=None)
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="run-")


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one machine, may fall back to a
    temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return _local_root(spark.sparkContext.applicationId)
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, removed with the scratch space it was made in, or else
    by the JVM when the session ends."""
    path = f"{scratch_root(spark)}/lakesieve-{label}-{uuid.uuid4().hex}"
    jpath, fs = _handle(spark, path)
    fs.deleteOnExit(jpath)
    if _open_spaces():
        _open_spaces()[-1].paths.append(path)
    return path


class ScratchSpace:
    """Paths that go together, and a way for a result to outlive them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` stored outside this space, so that it is still there when the space has gone."""
        kept = staged(df, label)
        path = self.paths.pop()
        if len(_open_spaces()) > 1:
            _open_spaces()[-2].paths.append(path)
        return kept


_LOCAL = threading.local()


def _open_spaces() -> list[ScratchSpace]:
    """The scratch spaces this thread is in, innermost last."""
    if not hasattr(_LOCAL, "spaces"):
        _LOCAL.spaces = []
    return _LOCAL.spaces


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[ScratchSpace]:
    """What is staged inside is deleted at the end, but for what :meth:`ScratchSpace.keep` stored.

    A DataFrame that reads a staged table is of no use after that, unless its result was kept.
    """
    space = ScratchSpace(spark)
    _open_spaces().append(space)
    try:
        yield space
    finally:
        _open_spaces().pop()
        for path in space.paths:
            delete_path(spark, path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` computed once and kept as a table in the shared folder.

    Later plans start from a table whose size is known and which no lost executor can take away.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _handle(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _handle(spark, path)
    return fs.exists(jpath)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as Spark writes it in ``_metadata.file_path``: with its scheme, encoded, no slash at its end,
    and one slash behind a scheme without a host."""
    jpath, fs = _handle(spark, path)
    return re.sub(r"^(\w+):///", r"\1:/", fs.makeQualified(jpath).toUri().toString())


def delete_path(spark: SparkSession, path: str) -> None:
    jpath, fs = _handle(spark, path)
    fs.delete(jpath, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``: one directory listing, no Spark job."""
    jpath, fs = _handle(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def partition_dirs(spark: SparkSession, root: str, column: str) -> dict[str, str]:
    """Partition value -> directory, for the first level of a Hive-style layout.

    Values stay strings, so ordering them is string ordering whatever they look like.
    """
    prefix = f"{column}="
    return {
        unquote(name[len(prefix):]): f"{root.rstrip('/')}/{name}"
        for name in child_names(spark, root) if name.startswith(prefix)
    }


#: Folder beside a table for what is half written or about to be replaced. No table has this name.
WORK_FOLDER = "_lakesieve_work"


def beside(path: str, label: str) -> str:
    """A fresh path on the file system of ``path``, in the work folder next to it."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/{WORK_FOLDER}/{name}.{label}-{uuid.uuid4().hex}"


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put the finished dataset ``staged`` in the place of ``path``.

    The old data is kept aside until the new data is in place, so a failure between the two
    renames leaves one complete copy and nothing half written.
    """
    jpath, fs = _handle(spark, path)
    jstaged, _ = _handle(spark, staged)
    aside, _ = _handle(spark, beside(path, "previous"))
    fs.mkdirs(aside.getParent())
    had_data = fs.exists(jpath)
    if had_data and not fs.rename(jpath, aside):
        raise OSError(f"cannot move the old data of {path} aside")
    if not fs.rename(jstaged, jpath):
        if had_data:
            fs.rename(aside, jpath)
        raise OSError(f"cannot move {staged} to {path}")
    if had_data:
        fs.delete(aside, True)
