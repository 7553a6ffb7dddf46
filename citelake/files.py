"""Files of any file system Spark knows, from the driver: names, small contents, moves.  A path without a scheme is of the session's default one."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at(root).getFileSystem(conf)
        if self._fs.getUri().getScheme() == "file":  # without checksum files beside exports
            self._fs = self._jvm.org.apache.hadoop.fs.RawLocalFileSystem()
            self._fs.initialize(self._jvm.java.net.URI("file:///"), conf)

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(str(path))

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._at(path))

    def list(self, path: str) -> list[tuple[str, bool, int]]:
        """(name, whether a folder, bytes) of what stands in a folder, by name, without hidden names; nothing for a folder that doesn't exist."""
        if not self.exists(path):
            return []
        every = [(s.getPath().getName(), s.isDirectory(), s.getLen()) for s in self._fs.listStatus(self._at(path))]
        return sorted(x for x in every if not x[0].startswith("."))

    def names(self, path: str) -> list[str]:
        """The names ``list`` gives, in one call to the JVM however many there are."""
        if not self.exists(path):
            return []
        found = self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(self._fs.listStatus(self._at(path)))
        every = self._jvm.scala.collection.mutable.ArraySeq.make(found).mkString("//\n")  # no path has this
        return sorted(n for n in (p.rsplit("/", 1)[-1] for p in every.split("//\n")) if n and not n.startswith("."))

    def mean(self, folders: set[str]) -> int:
        """The average number of bytes of the files below the folders."""
        found = [self._fs.getContentSummary(self._at(f)) for f in folders]
        return sum(s.getLength() for s in found) // max(1, sum(s.getFileCount() for s in found))

    def uri(self, path: str) -> str:
        """The path with its scheme."""
        return self._fs.makeQualified(self._at(path)).toString()

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._at(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._at(path), True)

    def move(self, source: str, target: str) -> None:
        """Rename; what stands at the target goes first."""
        self.delete(target)
        if not self._fs.rename(self._at(source), self._at(target)):
            raise OSError(f"can't move {source} to {target}")

    def read(self, path: str) -> bytes:
        stream = self._fs.open(self._at(path))
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def write(self, path: str, content: bytes) -> None:
        stream = self._fs.create(self._at(path), True)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()

    def claim(self, path: str, content: bytes) -> bool:
        """Write a small file if nobody has; False if it exists."""
        try:
            stream = self._fs.create(self._at(path), False)
        except Py4JJavaError as e:
            if "AlreadyExists" in str(e.java_exception.getClass().getName()) or "already exists" in str(e.java_exception.getMessage()):
                return False
            raise
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()
        return True

    def concat(self, parts: list[str], target: str) -> None:
        """The parts' bytes one after the other in a new file, without passing through Python."""
        stream = self._fs.create(self._at(target), True)
        try:
            for p in parts:
                source = self._fs.open(self._at(p))
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, stream, 1 << 16, False)
                finally:
                    source.close()
        finally:
            stream.close()
