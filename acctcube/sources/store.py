"""Files through Spark's own file systems, and numbered commits below a folder.

A commit is one small file ``_commits/<number>`` that appears whole or not at all: it is written
beside and renamed to a name that must not exist yet. Data are written first, into folders
of their own; readers ask the last commit which folders count. So a job that fails leaves what
was there, and of two writers that started from the same commit the second one is refused.
Names that begin with ``_`` are passed over by Spark's readers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer committed first."""


class Store:
    """One folder and what lies below it."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        """What a folder holds, in order of the names; nothing if there is no such folder."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(name)))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def move(self, old: str, new: str) -> None:
        """Rename; an existing ``new`` is an error."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self._conf)
        self._fs.mkdirs(self._path(new).getParent())
        mode = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        modes = self._jvm.java.lang.reflect.Array.newInstance(mode.getClass(), 1)
        self._jvm.java.lang.reflect.Array.set(modes, 0, mode)
        context.rename(self._path(old), self._path(new), modes)


class Commits:
    """The numbered commits of a folder; each holds a JSON object."""

    FOLDER, DATA = "_commits", "_data"

    def __init__(self, spark: SparkSession, root: str):
        self.store = Store(spark, root)

    def numbers(self) -> list[int]:
        return sorted(int(n) for n in self.store.names(self.FOLDER) if n.isdigit())

    def last(self) -> int:
        """The number of the last commit, 0 before the first one."""
        return max(self.numbers(), default=0)

    def load(self, number: int) -> dict:
        return json.loads(self.store.read(f"{self.FOLDER}/{number:08d}"))

    def new_folder(self) -> str:
        """Name of an unused folder for the data of a commit to come."""
        return f"{self.DATA}/{uuid.uuid4().hex}"

    def commit(self, after: int, content: Mapping) -> int:
        """Make ``content`` commit ``after + 1``, or raise if there is one already."""
        draft, final = f"{self.FOLDER}/.{uuid.uuid4().hex}", f"{self.FOLDER}/{after + 1:08d}"
        self.store.write(draft, json.dumps(content))
        if self.last() == after:
            try:
                self.store.move(draft, final)
                return after + 1
            except Exception:
                if not self.store.exists(final):
                    raise
        self.store.delete(draft)
        raise CommitConflict(f"{self.store.root} was saved by another writer after commit {after}")

    def keep(self, n: int) -> None:
        """Delete all but the last ``n`` commits and their data; folders of no commit stay: a
        writer may still be at work there."""
        numbers = self.numbers()
        kept = {f for k in numbers[-n:] for f in self.load(k)["folders"]}
        for k in numbers[:-n]:
            for folder in set(self.load(k)["folders"]) - kept:
                # "": the plain files beside the commits
                plain = [n for n in self.store.names() if n not in (self.FOLDER, self.DATA)]
                for name in [folder] if folder else plain:
                    self.store.delete(name)
            self.store.delete(f"{self.FOLDER}/{k:08d}")
