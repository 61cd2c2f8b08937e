"""Files and folders of whatever store a path names, through Spark's own file systems."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Store:
    """The few operations a publisher needs; nothing here reads or writes rows."""

    spark: SparkSession

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def exists(self, path: str) -> bool:
        where, files = self._at(path)
        return files.exists(where)

    def delete(self, path: str) -> None:
        """Remove a file, or a folder with all in it; nothing happens if there is none."""
        where, files = self._at(path)
        files.delete(where, True)

    def rename(self, source: str, target: str) -> None:
        """Give a file or folder another name; the target must not exist."""
        where, files = self._at(source)
        to, _ = self._at(target)
        files.mkdirs(to.getParent())
        if not files.rename(where, to):
            raise OSError(f"{source} cannot be renamed to {target}")

    def put(self, path: str, text: str) -> None:
        """Write a small file that appears whole or not at all."""
        where, files = self._at(path)
        beside, _ = self._at(f"{path.rsplit('/', 1)[0]}/.{path.rsplit('/', 1)[1]}.new")
        stream = files.create(beside, True)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        files.delete(where, False)
        if not files.rename(beside, where):
            raise OSError(f"{path} cannot be written")

    def text(self, path: str) -> str | None:
        """What a small file holds; None if there is none."""
        where, files = self._at(path)
        if not files.exists(where):
            return None
        stream = files.open(where)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def files(self, folder: str) -> list[str]:
        """All files below a folder, relative to it."""
        where, files = self._at(folder)
        if not files.exists(where):
            return []
        base = len(files.makeQualified(where).toString().rstrip("/")) + 1
        found, listed = [], files.listFiles(where, True)
        while listed.hasNext():
            found.append(listed.next().getPath().toString()[base:])
        return sorted(found)
