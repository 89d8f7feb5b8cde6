"""The file system of a path, through Spark's JVM, so that any store that Spark reads will do."""

from __future__ import annotations

from pyspark.sql import SparkSession

from loomgraph.errors import GraphIOError
from loomgraph.sources import layout


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def put(self, path: str, content: bytes) -> None:
        out = self.fs.create(self.path(path), True)
        try:
            out.write(bytearray(content))
        finally:
            out.close()

    def get(self, path: str) -> bytes | None:
        """The content of a small file; None if there is none. Other errors, as of permissions, are raised."""
        at = self.path(path)
        if not self.fs.exists(at):
            return None
        source = self.fs.open(at)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(source))
        finally:
            source.close()

    def count(self, path: str) -> int | None:
        """How many files lie under a folder, in one call; None if there is no such folder."""
        at = self.path(path)
        return int(self.fs.getContentSummary(at).getFileCount()) if self.fs.exists(at) else None

    def settle(self, tmp: str, to: str) -> None:
        """Move the one file of each _d0=i/_d1=j folder under tmp to its place under to. Two files for one place are an error: the second would replace the first."""
        files = self.fs.listFiles(self.path(tmp), True)
        made: set[str] = set()
        moved: set[str] = set()
        while files.hasNext():
            f = files.next().getPath()
            if not f.getName().startswith("part-"):
                continue
            places = [s.split("=")[1] for s in f.toString().split("/") if s.startswith("_d")]
            folder = f"{to}{layout.PART}{places[0]}/" if len(places) == 2 else to
            if folder not in made:
                made.add(folder)
                self.fs.mkdirs(self.path(folder))
            place = f"{folder}{layout.CHUNK}{places[-1]}"
            if place in moved:
                raise GraphIOError(f"Two tasks wrote one chunk: {place}")
            moved.add(place)
            target = self.path(place)
            if not self.fs.rename(f, target):  # an older file is there
                self.fs.delete(target, False)
                self.fs.rename(f, target)
        self.fs.delete(self.path(tmp), True)
