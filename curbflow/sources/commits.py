"""A log of numbered commits beside the data they name: readers pin one, writers add the next."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LOG = "_commits"
_DIGITS = 12
_ATTEMPTS = 50


class CommitConflict(RuntimeError):
    """Another writer has taken the number."""


def _hadoop(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _is(error: Py4JJavaError, name: str) -> bool:
    return name in error.java_exception.getClass().getName()


def _name(number: int) -> str:
    return f"{number:0{_DIGITS}d}.json"


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the commits under ``path``, least first; none where there is no log."""
    folder, fs = _hadoop(spark, f"{path.rstrip('/')}/{LOG}")
    try:
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
    except Py4JJavaError as error:
        if _is(error, "FileNotFoundException"):
            return []
        raise
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] not in "._")


def read_commit(spark: SparkSession, path: str, number: int) -> dict:
    file, fs = _hadoop(spark, f"{path.rstrip('/')}/{LOG}/{_name(number)}")
    stream = fs.open(file)
    try:
        return json.loads(bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def latest(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """(number, content) of the newest commit, or ``None``."""
    found = numbers(spark, path)
    return (found[-1], read_commit(spark, path, found[-1])) if found else None


def commit(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Add commit ``number``; :class:`CommitConflict` if it is there already.

    The content is written under a temporary name, then given its final one
    unless that is taken, so a reader sees a commit whole or not at all. Two
    writers are told apart as far as the file system's rename is atomic; on
    a mounted folder a hard link is made, which is.
    """
    root = f"{path.rstrip('/')}/{LOG}"
    temp, fs = _hadoop(spark, f"{root}/.{uuid.uuid4().hex}")
    final, _ = _hadoop(spark, f"{root}/{_name(number)}")
    temp, final = fs.makeQualified(temp), fs.makeQualified(final)
    data = json.dumps(content, sort_keys=True).encode()
    fs.mkdirs(temp.getParent())
    taken = CommitConflict(f"commit {number} of {path} exists")
    if final.toUri().getScheme() == "file":
        own, name = temp.toUri().getPath(), final.toUri().getPath()
        with open(own, "wb") as out:
            out.write(data)
        try:
            os.link(own, name)
        except FileExistsError:
            raise taken from None
        finally:
            os.remove(own)
        return
    out = fs.create(temp, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    context = spark.sparkContext
    options = context._gateway.new_array(context._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    files = context._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), context._jsc.hadoopConfiguration())
    try:
        files.rename(temp, final, options)
    except Py4JJavaError as error:
        fs.delete(temp, False)
        if _is(error, "FileAlreadyExistsException"):
            raise taken from None
        raise


def commit_next(spark: SparkSession, path: str, change: Callable[[dict | None], dict]) -> tuple[int, dict]:
    """Commit ``change(newest content)`` under the next number, again from the start after a conflict."""
    for _ in range(_ATTEMPTS):
        before = latest(spark, path)
        number, content = (before[0] + 1, change(before[1])) if before else (1, change(None))
        try:
            commit(spark, path, number, content)
            return number, content
        except CommitConflict:
            continue
    raise CommitConflict(f"{path}: {_ATTEMPTS} attempts met other writers")


def prune(spark: SparkSession, path: str, keep: int) -> None:
    """Delete all but the newest ``keep`` commits."""
    for number in numbers(spark, path)[:-keep]:
        file, fs = _hadoop(spark, f"{path.rstrip('/')}/{LOG}/{_name(number)}")
        fs.delete(file, False)
