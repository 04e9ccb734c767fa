"""Small files next to tables, on whatever file system Spark writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder of small text files that appear whole or not at all."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        root = self._path("")
        self._files = root.getFileSystem(self._conf)
        # Renames through a file context fail where there is a file already, on every file system.
        qualified = self._files.makeQualified(root)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _qualified(self, name: str):
        return self._files.makeQualified(self._path(name))

    def names(self, below: str = "") -> list[str]:
        """What lies in the folder, or in one below it; nothing if it is not there."""
        path = self._path(below)
        if not self._files.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(path))

    def read(self, name: str) -> str:
        stream = self._files.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """Add a file under a name that no other writer has taken; raises ``FileExistsError`` if one has."""
        hidden = f".{name}-{uuid.uuid4().hex}"
        stream = self._files.create(self._path(hidden), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        no_options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._context.rename(self._qualified(hidden), self._qualified(name), no_options)
        except Exception as error:
            self._files.delete(self._path(hidden), False)
            if "FileAlreadyExists" in str(error):
                raise FileExistsError(f"{self.path}/{name}") from error
            raise

    def delete(self, name: str) -> None:
        """Remove a file, or a folder with all in it."""
        self._files.delete(self._path(name), True)
