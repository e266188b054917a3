"""The current state of a set of tables, as numbered files of which the last counts.

A commit writes the next number, and only if there is no file of that number yet. So of two commits that
overlap one fails, reads what the other wrote, and tries again. How a file is put only if it is absent
depends on where it is, see ``RenameStore`` and ``CreateStore``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Protocol

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Older states that are kept for readers that are just opening them.
KEPT = 20


class Store(Protocol):
    """Named texts in one folder."""

    def names(self) -> list[str]: ...

    def read(self, name: str) -> str | None:
        """The text, or None if it has been deleted meanwhile."""

    def put_if_absent(self, name: str, text: str) -> bool:
        """Whether the text was put; readers see all of it or nothing."""

    def delete(self, name: str) -> None: ...


class _Files:
    """Texts as files of a Hadoop file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._files = self._path().getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), conf)

    def _path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self) -> list[str]:
        if not self._files.exists(self._path()):
            return []
        return [s.getPath().getName() for s in self._files.listStatus(self._path())]

    def read(self, name: str) -> str | None:
        try:
            stream = self._files.open(self._path(name))
        except Py4JJavaError as e:
            if "FileNotFoundException" in e.java_exception.getClass().getName():
                return None
            raise
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._files.delete(self._path(name), False)

    def delete_folder(self, path: str) -> None:
        self._files.delete(self._jvm.org.apache.hadoop.fs.Path(path), True)

    def _create(self, name: str, text: str) -> None:
        stream = self._files.create(self._path(name), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()


class RenameStore(_Files):
    """For file systems on which a rename that replaces nothing is atomic, as HDFS and local disks."""

    def put_if_absent(self, name: str, text: str) -> bool:
        draft = f"_draft-{uuid.uuid4().hex}"
        self._create(draft, text)
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        plain = self._gateway.new_array(options, 1)
        plain[0] = getattr(options, "NONE")
        try:
            self._context.rename(self._path(draft), self._path(name), plain)
        except Py4JJavaError as e:
            self.delete(draft)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        return True


class CreateStore(_Files):
    """For object stores: a file appears when it is closed, and creating one that is there fails.

    The store's connector must have conditional writes on; a rename would copy and could overwrite.
    """

    def put_if_absent(self, name: str, text: str) -> bool:
        try:
            self._create(name, text)
        except Py4JJavaError as e:
            kind = e.java_exception.getClass().getName()
            if "FileAlreadyExistsException" in kind or "RemoteFileChangedException" in kind:
                return False
            raise
        return True


#: Schemes whose files appear when they are closed and cannot be renamed atomically.
OBJECT_STORES = ("s3a", "s3", "gs", "abfs", "abfss", "oss", "cosn")


class Manifest:
    def __init__(self, spark: SparkSession | None, root: str, store: Store | None = None):
        self.root = root.rstrip("/")
        if store is None:
            kind = CreateStore if self.root.partition("://")[0] in OBJECT_STORES else RenameStore
            store = kind(spark, f"{self.root}/_manifests")
        self._store = store

    @staticmethod
    def _name(number: int) -> str:
        return f"{number:012d}.json"

    def _last(self) -> tuple[list[int], dict]:
        """Numbers that are there, and the content of the last."""
        while True:
            numbers = sorted(int(n[:-5]) for n in self._store.names() if n.endswith(".json") and n[:-5].isdigit())
            if not numbers:
                return [], {}
            text = self._store.read(self._name(numbers[-1]))
            if text is not None:  # or so many commits came in between that it is gone already
                return numbers, json.loads(text)

    def read(self) -> dict:
        """Current content; empty before the first commit."""
        return self._last()[1]

    def commit(self, change: Callable[[dict], dict]) -> None:
        """Make ``change(current content)`` the current content; it may be called again on newer content."""
        while True:
            numbers, content = self._last()
            number = numbers[-1] + 1 if numbers else 1
            if self._store.put_if_absent(self._name(number), json.dumps(change(content), indent=1)):
                break
        for old in numbers[: -KEPT + 1]:
            self._store.delete(self._name(old))

    def delete_folder(self, path: str) -> None:
        self._store.delete_folder(path)
