"""Paths: the shared work folder, and listing through Hadoop's file systems."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder of the cluster.

    The folder is the one named in ``spark.checkpoint.dir``. Where that is unset, it
    lies in the warehouse. On a cluster that must be a folder which executors share: one of
    the driver's machine is refused.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        local = spark.sparkContext.master.startswith("local")
        if not local and urlsplit(warehouse).scheme in ("", "file"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a shared folder: {warehouse} is on the driver's machine")
        base = f"{warehouse}/_work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Storage:
    """The few file operations a table needs, on any file system Spark can read."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def names(self, path: str) -> list[str]:
        """Names directly under a folder; none when it is missing."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(p))

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Write a small file so that readers see all of it or nothing."""
        fs, p = self._at(path)
        if fs.exists(p):
            raise FileExistsError(path)
        draft = self._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not fs.rename(draft, p):
            raise FileExistsError(path)

    def size(self, path: str) -> int:
        """Bytes under a folder."""
        fs, p = self._at(path)
        return fs.getContentSummary(p).getLength()

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)
