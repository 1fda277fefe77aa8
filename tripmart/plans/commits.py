"""Numbered commits: small JSON files of which each number is written once.

A commit is created whole and only if its number is free, so of two writers
that saw the same last number one wins and the other looks again
(``CommitLog.update``). Readers take the highest number, or all of them. What
a commit names (folders of data) is written before it, under names of its own,
and never changed after; a crash before the commit leaves unnamed folders and
nothing else.

The file is written under a temporary name and then given its number: on a
local disk by a hard link, else by a rename that must not replace. Both fail
if the number is taken (HDFS and stores with an atomic rename; object stores
without one need a file system layer that has it).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

try:
    from py4j.protocol import Py4JJavaError
except ImportError:  # another bridge to the JVM
    class Py4JJavaError(Exception):
        pass


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._root.getFileSystem(self._conf)

    def _file(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def numbers(self) -> list[int]:
        """Numbers of all commits, ascending."""
        if not self._fs.exists(self._root):
            return []
        names = (f.getPath().getName() for f in self._fs.listStatus(self._root))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def path_of(self, number: int) -> str:
        return f"{self.path}/{number:012d}.json"

    def text(self, number: int) -> str:
        stream = self._fs.open(self._file(f"{number:012d}.json"))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict | None]:
        """Number and content of the last commit; (0, None) when there is none."""
        numbers = self.numbers()
        return (numbers[-1], json.loads(self.text(numbers[-1]))) if numbers else (0, None)

    def create(self, number: int, text: str) -> bool:
        """Write the commit with this number; False if there is one already."""
        self._fs.mkdirs(self._root)
        temporary, final = self._file(f"_{uuid.uuid4().hex}"), self._file(f"{number:012d}.json")
        out = self._fs.create(temporary, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            return self._place(temporary, final)
        finally:
            self._fs.delete(temporary, False)

    def _place(self, temporary, final) -> bool:
        if self._fs.getScheme() == "file":
            def local(p):
                return self._jvm.java.io.File(p.toUri().getPath()).toPath()

            return _unless_taken(lambda: self._jvm.java.nio.file.Files.createLink(local(final), local(temporary)))
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        no_options = self.spark.sparkContext._gateway.new_array(options, 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._root.toUri(), self._conf)
        return _unless_taken(lambda: context.rename(temporary, final, no_options))

    def update(self, change: Callable[[dict | None], dict | None], tries: int = 100) -> tuple[int, dict | None]:
        """Commit ``change`` of the last content after it; again from the new last if another writer came first.

        No commit is made where ``change`` returns None.
        """
        for _ in range(tries):
            number, last = self.latest()
            new = change(last)
            if new is None:
                return number, last
            if self.create(number + 1, json.dumps(new)):
                return number + 1, new
        raise RuntimeError(f"{self.path}: {tries} commits in a row were lost to other writers")


def _unless_taken(place: Callable) -> bool:
    try:
        place()
        return True
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getSimpleName():
            return False
        raise


#: Conditions of files that cannot be read and of paths that are not there, as Spark names them.
UNREADABLE, UNMERGEABLE, MISSING = "FAILED_READ_FILE", "CANNOT_MERGE_SCHEMAS", "PATH_NOT_FOUND"


def conditions(error: BaseException) -> list[str]:
    """The error conditions that Spark gives an exception and its causes, outermost first."""
    if isinstance(error, PySparkException):
        return [c for c in [error.getCondition()] if c]
    found, cause = [], getattr(error, "java_exception", None)
    while cause is not None:
        try:
            found.append(cause.getCondition())
        except Exception:  # a Java exception without conditions
            pass
        cause = cause.getCause()
    return [c for c in found if c]


def has_condition(error: BaseException, *names: str) -> bool:
    return any(c.split(".")[0] in names for c in conditions(error))


def is_missing(error: BaseException) -> bool:
    return has_condition(error, MISSING)
