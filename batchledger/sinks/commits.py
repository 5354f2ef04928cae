"""Numbered commits to a folder of text files.

A commit is the folder ``batch=<n>``. Data is written to a hidden folder, the number is taken by
creating ``_commits/<n>``, which fails if it is there, and the folder is renamed: readers see all of
a commit or nothing, and its place follows from the number, not from anyone's clock. A writer that
dies in between leaves an unused number.

A ``token`` names an append (a streaming batch, say). It is bound to its number before the data shows
up, so the same append done again takes the same number, or finds it published and leaves it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class _Folder:
    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.files = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.files.exists(self.path(name))

    def numbers(self, folder: str, pattern: str) -> list[int]:
        if not self.exists(folder):
            return []
        names = [status.getPath().getName() for status in self.files.listStatus(self.path(folder))]
        return [int(m[1]) for m in map(re.compile(pattern).fullmatch, names) if m]

    def create(self, name: str, text: str) -> bool:
        """Create a file; False if it is there."""
        try:
            out = self.files.create(self.path(name), False)
        except Py4JJavaError as error:
            if "AlreadyExists" in str(error.java_exception):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def read(self, name: str) -> str:
        source = self.files.open(self.path(name))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def publish(self, hidden: str, name: str) -> None:
        if self.exists(name):
            self.files.delete(self.path(hidden), True)
        elif not self.files.rename(self.path(hidden), self.path(name)):
            raise OSError(f"cannot rename {hidden} to {name} in {self.root}")


def published(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the commits that can be read, ascending."""
    return sorted(_Folder(spark, path).numbers("", r"batch=(\d+)"))


def commit(spark: SparkSession, path: str, write: Callable[[str], None], token: str | None = None, number: int | None = None) -> int:
    """Let ``write`` fill a folder and publish it as the next commit, or as ``number`` if that is free."""
    folder = _Folder(spark, path)
    bound = f"_tokens/{quote(token, safe='')}" if token is not None else None
    if bound and folder.exists(bound):
        taken = int(folder.read(bound))
        if folder.exists(f"batch={taken}"):
            return taken
    hidden = f"_writing-{uuid.uuid4().hex}"
    write(f"{folder.root}/{hidden}")
    taken = _take(folder, bound, number)
    folder.publish(hidden, f"batch={taken}")
    return taken


def _take(folder: _Folder, bound: str | None, number: int | None) -> int:
    if bound and folder.exists(bound):
        return int(folder.read(bound))
    if number is not None:
        free = not folder.exists(f"batch={number}") and folder.create(f"_commits/{number}", bound or "")
        # Taken by the same append, which died before the token was bound.
        if not free and not (bound and not folder.exists(f"batch={number}") and folder.read(f"_commits/{number}") == bound):
            raise ValueError(f"commit {number} is taken")
    else:
        known = folder.numbers("", r"batch=(\d+)") + folder.numbers("_commits", r"(\d+)")
        number = max(known, default=0) + 1
        while not folder.create(f"_commits/{number}", bound or ""):
            number += 1
    if bound and not folder.create(bound, str(number)):
        return int(folder.read(bound))  # the same append came first from elsewhere
    return number
