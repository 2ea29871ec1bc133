"""Small files and folders of a table, on any file system that Spark reaches."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _is(e: Py4JJavaError, name: str) -> bool:
    return e.java_exception.getClass().getName().endswith(name)


@dataclass(frozen=True)
class Entry:
    name: str
    modified: float  # seconds since the epoch
    folder: bool


class Store:
    """The folder ``root``, through Hadoop's ``FileSystem``: the same calls for
    HDFS, object stores and mounted folders, with Spark's own settings."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        # Looked up once: each step of such a name is a round trip to the JVM.
        self._make_path, self._files = self._jvm.org.apache.hadoop.fs.Path, self._jvm.java.nio.file.Files
        self.root = root.rstrip("/") or "/"
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._make_path(f"{self.root}/{name}" if name else self.root)

    def _local(self, path):
        return self._jvm.java.nio.file.Paths.get(path.toUri().getPath(), self._gateway.new_array(self._jvm.String, 0))

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def entries(self, name: str = "") -> list[Entry]:
        """What the folder holds, hidden ``.`` names left out; nothing, if it
        is not there."""
        try:
            found = self._fs.listStatus(self._path(name))
        except Py4JJavaError as e:
            if _is(e, "FileNotFoundException"):
                return []
            raise
        out = [Entry(f.getPath().getName(), f.getModificationTime() / 1000, f.isDirectory()) for f in found]
        return sorted((e for e in out if not e.name.startswith(".")), key=lambda e: e.name)

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> bool:
        """Write a file whole, and only if there is none of that name: of
        several writers exactly one gets true.

        The text goes to a hidden file first, which then takes the name by a
        rename that refuses to overwrite (on a local or mounted folder, where
        rename can't refuse, by a hard link).  That is atomic on HDFS and
        mounted folders; an object store must offer such a rename itself.
        """
        folder, _, leaf = name.rpartition("/")
        hidden = f"{folder + '/' if folder else ''}.{leaf}-{uuid.uuid4().hex}"
        source, target = self._path(hidden), self._path(name)
        data = bytearray(text.encode())
        if self._fs.getUri().getScheme() == "file":
            # Without Hadoop's file system, which starts a process to set each new file's mode.
            return self._link_new(self._local(source), self._local(target), data)
        out = self._fs.create(source, True)
        try:
            out.write(data)
        finally:
            out.close()
        try:
            fs = self._jvm.org.apache.hadoop.fs
            rename = getattr(fs, "Options$Rename")
            keep = self._gateway.new_array(rename, 1)
            keep[0] = rename.NONE
            fs.FileContext.getFileContext(self._fs.makeQualified(target).toUri(), self._conf).rename(source, target, keep)
            return True
        except Py4JJavaError as e:
            if _is(e, "FileAlreadyExistsException"):
                return False
            raise
        finally:
            self._fs.delete(source, False)

    def _link_new(self, source, target, data: bytearray) -> bool:
        self._files.createDirectories(target.getParent(), self._gateway.new_array(self._jvm.java.nio.file.attribute.FileAttribute, 0))
        try:
            self._files.write(source, data, self._gateway.new_array(self._jvm.java.nio.file.OpenOption, 0))
            self._files.createLink(target, source)
            return True
        except Py4JJavaError as e:
            if _is(e, "FileAlreadyExistsException"):
                return False
            raise
        finally:
            self._files.deleteIfExists(source)

    def rename(self, old: str, new: str) -> None:
        try:
            done = self._fs.rename(self._path(old), self._path(new))
        except Py4JJavaError as e:
            if _is(e, "FileNotFoundException"):
                raise FileNotFoundError(f"{self.root}/{old}") from e
            raise
        if not done:
            raise OSError(f"could not rename {self.root}/{old} to {new}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
