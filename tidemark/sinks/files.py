"""Small files beside a table, through Hadoop's file system: the driver writes and lists them, nothing is scanned."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder of whatever store ``path`` names."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._store = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}") if name else self._root

    def exists(self, name: str = "") -> bool:
        return self._store.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Names of what lies directly in the folder, in order."""
        return [n for n, _, _ in self.listing(name)]

    def listing(self, name: str = "") -> list[tuple[str, int, int]]:
        """Name, bytes and time of change of what lies directly in the folder, by name."""
        if not self.exists(name):
            return []
        found = self._store.listStatus(self._at(name))
        return sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found)

    def read(self, name: str) -> str:
        stream = self._store.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str = "") -> bool:
        """Write a file that must not be there yet; false if it is, which tells two writers apart."""
        try:
            stream = self._store.create(self._at(name), False)
        except Exception as e:
            if self.exists(name):
                return False
            raise e
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        return True

    def drop(self, name: str = "") -> None:
        self._store.delete(self._at(name), True)
