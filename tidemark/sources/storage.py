"""File operations on whatever storage the session's Hadoop configuration reaches."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


class Storage:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, name: str) -> JavaObject:
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _on(self, name: str) -> tuple[JavaObject, JavaObject]:
        path = self._path(name)
        return path.getFileSystem(self._conf), path

    def qualified(self, name: str) -> str:
        fs, path = self._on(name)
        return fs.makeQualified(path).toString()

    def from_uri(self, uri: str) -> str:
        """The plain path of a percent-encoded ``_metadata.file_path``."""
        return self._jvm.org.apache.hadoop.fs.Path(self._jvm.java.net.URI(uri)).toString()

    def exists(self, name: str) -> bool:
        fs, path = self._on(name)
        return fs.exists(path)

    def make_folder(self, name: str) -> None:
        fs, path = self._on(name)
        fs.mkdirs(path)

    def children(self, name: str) -> list[str]:
        fs, path = self._on(name)
        if not fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(path))

    def has_data(self, folder: str) -> bool:
        """Whether a folder holds something that a table scan would see."""
        return any("=" in name or not name.startswith(("_", ".")) for name in self.children(folder))

    def move(self, source: str, target: str) -> None:
        fs, path = self._on(source)
        goal = self._path(target)
        if not fs.rename(path, goal):
            raise OSError(f"cannot move {source} to {target}")

    def remove(self, name: str, whole_folder: bool = False) -> None:
        fs, path = self._on(name)
        fs.delete(path, whole_folder)

    def read_text(self, name: str) -> str:
        fs, path = self._on(name)
        stream = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def first_bytes(self, name: str, count: int) -> bytes:
        fs, path = self._on(name)
        stream = fs.open(path)
        try:
            found = [stream.read() for _ in range(count)]
        finally:
            stream.close()
        return bytes(b for b in found if b >= 0)

    def write_text(self, name: str, text: str) -> None:
        """Appears whole or not at all: written beside and moved into place."""
        beside = f"{name}.part"
        fs, path = self._on(beside)
        stream = fs.create(path, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        self.move(beside, name)
