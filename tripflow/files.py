"""Files of any store that Spark reaches: existence, listing, small texts, moves and deletions."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import SparkSession


def plain(uri: str) -> str:
    """A file's path as listings write it and readers take it: decoded, and ``file:/`` for a local one."""
    return re.sub(r"^file:/+", "file:/", unquote(uri))


class Store:
    """The file system of the session's Hadoop configuration, addressed by paths or URIs."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """Names of the entries of a folder, sorted; none if it does not exist."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def move(self, source: str, target: str) -> None:
        fs, s = self._at(source)
        _, t = self._at(target)
        fs.mkdirs(t.getParent())
        if not fs.rename(s, t):
            raise OSError(f"cannot move {source} to {target}")

    def write_text(self, path: str, text: str) -> None:
        """Write a small file so that it appears whole or not at all."""
        fs, p = self._at(path)
        _, part = self._at(path + ".part")
        out = fs.create(part, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        fs.delete(p, False)
        if not fs.rename(part, p):
            raise OSError(f"cannot write {path}")

    def read_text(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def fingerprint(self, path: str) -> str:
        """Size and time of a file or folder; empty if it does not exist."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return ""
        return f"{fs.getContentSummary(p).getLength()}:{fs.getFileStatus(p).getModificationTime()}"
