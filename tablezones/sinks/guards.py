"""Checks and moves around a destructive write.

A folder is never overwritten in place. The new data is written to a fresh
sibling folder first; only when that is complete does it take the target's
place. So a failed or empty write leaves the old data as it was, and a job may
read the folder that it replaces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

from tablezones.errors import UnsafeOverwriteError


def _filesystem(spark: SparkSession, path: str):
    """Hadoop path and file system of ``path``."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        raise UnsafeOverwriteError(f"{path}: replacing a folder needs a session with a JVM handle; append to a fresh folder instead")
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` resolved against ``fs.defaultFS`` and the working directory."""
    hpath, fs = _filesystem(spark, path)
    return fs.makeQualified(hpath).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = _filesystem(spark, path)
    return bool(fs.exists(hpath))


def _key(uri: str) -> tuple[str, str, str]:
    # 'file:/a' and 'file:///a' name the same file.
    parts = urlsplit(uri)
    return parts.scheme, parts.netloc, parts.path.rstrip("/")


def _under(child: tuple[str, str, str], parent: tuple[str, str, str]) -> bool:
    return child[:2] == parent[:2] and (child[2] == parent[2] or child[2].startswith(parent[2] + "/"))


def refuse_self_overwrite(spark: SparkSession, target: str, inputs: Iterable[str]) -> None:
    """Raise if replacing ``target`` would take away one of ``inputs`` (root
    paths that the job reads). The check compares paths only: constant cost at
    any table size."""
    root = _key(qualified(spark, target))
    for path in inputs:
        src = _key(qualified(spark, path))
        if _under(src, root) or _under(root, src):
            raise UnsafeOverwriteError(f"refusing to overwrite {target}: it overlaps input {path}")


def _delete(spark: SparkSession, path: str) -> None:
    hpath, fs = _filesystem(spark, path)
    fs.delete(hpath, True)


def _move(spark: SparkSession, src: str, dst: str) -> None:
    hsrc, fs = _filesystem(spark, src)
    if not fs.rename(hsrc, _filesystem(spark, dst)[0]):
        raise OSError(f"could not move {src} to {dst}")


def replace_folder(spark: SparkSession, target: str, write: Callable[[str], bool]) -> bool:
    """Run ``write(folder)`` on a fresh sibling of ``target``; when it returns
    true, that folder takes the target's place. Otherwise, or when it raises,
    the target stays as it was.

    Two renames make the swap, each atomic on a file system with renames
    (HDFS, POSIX); between them, or if the driver dies there, the old data is
    in the ``.old-`` sibling. On an object store a rename copies."""
    name = target.rstrip("/")
    head, _, tail = name.rpartition("/")
    mark = uuid.uuid4().hex[:8]
    # A leading dot or underscore hides both from directory readers.
    new, old = (f"{head}/.{tail}.{kind}-{mark}" if head else f".{tail}.{kind}-{mark}" for kind in ("new", "old"))
    if name.startswith("/") and not head:
        new, old = f"/.{tail}.new-{mark}", f"/.{tail}.old-{mark}"
    try:
        keep = write(new)
    except BaseException:
        _delete(spark, new)
        raise
    if not keep:
        _delete(spark, new)
        return False
    if path_exists(spark, target):
        _move(spark, name, old)
        try:
            _move(spark, new, name)
        except BaseException:
            _move(spark, old, name)
            raise
        _delete(spark, old)
    else:
        _move(spark, new, name)
    return True
