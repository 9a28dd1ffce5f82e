"""Commits of a table that is made of files: a numbered log of manifests in the table's folder.

Data files are written first, each commit's in a folder of its own, and then one manifest, which is created whole and
only if its number is still free. So readers see a commit or do not, an import that broke off
is never seen, and of two writers at once one has to look again at what the other did.

On HDFS a rename does not replace a file, and on a local or mounted disk a hard link does not, so both are
atomic. Object stores need a file system client whose rename or create refuses to overwrite.
"""

from __future__ import annotations

import contextlib
import json
import os
import time
from collections.abc import Callable
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Storage:
    """Small files below a folder of any file system that Spark reaches; used by the driver only."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.files = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _names(self, folder: str, wanted: Callable) -> list[str]:
        path = self._path(folder)
        if not self.files.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self.files.listStatus(path) if wanted(s))

    def names(self, folder: str) -> list[str]:
        """Finished files in a folder; none if there is no such folder."""
        return [n for n in self._names(folder, lambda s: s.isFile()) if not n.startswith(".")]

    def folders(self, folder: str, untouched_seconds: float = 0) -> list[str]:
        """Folders in a folder, those that were last changed so long ago."""
        before = (time.time() - untouched_seconds) * 1000
        return self._names(folder, lambda s: s.isDirectory() and s.getModificationTime() <= before)

    def read(self, name: str) -> str:
        stream = self.files.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_once(self, name: str, text: str) -> bool:
        """Create a file with all of its text, or leave the one that is there alone and return False."""
        folder, _, last = name.rpartition("/")
        draft, final = self._path(f"{folder}/.{last}-{uuid4().hex}"), self._path(name)
        stream = self.files.create(draft, True)
        stream.write(text.encode())
        stream.close()
        try:
            if self.files.getScheme() == "file":
                try:
                    os.link(draft.toUri().getPath(), final.toUri().getPath())
                except FileExistsError:
                    return False
                return True
            fs = self._jvm.org.apache.hadoop.fs
            options = self._jvm.org.apache.hadoop.fs.Options.Rename
            keep = self._jvm.java.lang.reflect.Array.newInstance(options.NONE.getClass(), 1)
            keep[0] = options.NONE
            try:
                fs.FileContext.getFileContext(draft.toUri(), self._conf).rename(draft, final, keep)
            except Py4JJavaError as error:
                if "FileAlreadyExists" in error.java_exception.getClass().getName():
                    return False
                raise
            return True
        finally:
            with contextlib.suppress(Py4JJavaError):
                self.files.delete(draft, False)

    def delete(self, name: str) -> None:
        self.files.delete(self._path(name), True)


class CommitLog:
    """The states of a table by version; a state is what a manifest says, as plain JSON."""

    FOLDER = "_commits"

    def __init__(self, storage: Storage) -> None:
        self.storage = storage

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.storage.names(self.FOLDER)]

    def newest(self) -> tuple[int, dict]:
        """Version and state; 0 and an empty state before the first commit."""
        found = self.versions()
        return (found[-1], self.at(found[-1])) if found else (0, {})

    def at(self, version: int) -> dict:
        return json.loads(self.storage.read(f"{self.FOLDER}/{version:020d}.json"))["state"]

    def try_commit(self, version: int, state: dict) -> bool:
        """Make ``state`` the given version, unless another writer was first."""
        text = json.dumps({"version": version, "written": time.time(), "state": state}, sort_keys=True)
        return self.storage.create_once(f"{self.FOLDER}/{version:020d}.json", text)

    def commit(self, change: Callable[[dict], dict]) -> int:
        """Apply a change that holds whatever others did meanwhile; returns the version."""
        while True:
            version, state = self.newest()
            if self.try_commit(version + 1, change(state)):
                return version + 1

    def forget_before(self, version: int) -> None:
        """Drop older versions; the newest always stays."""
        for old in self.versions()[:-1]:
            if old < version:
                self.storage.delete(f"{self.FOLDER}/{old:020d}.json")
