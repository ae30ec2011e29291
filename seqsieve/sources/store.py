"""Files below a URI: paths of this machine's file systems directly, any other store through pyarrow."""

from __future__ import annotations

import fnmatch
import glob
import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


class Store:
    """The store that a URI or path is in. Names are whole URIs or paths of that store."""

    def __init__(self, uri: str):
        self.local = urlparse(uri).scheme in ("", "file")
        if not self.local:
            from pyarrow import fs

            self.fs, _ = fs.FileSystem.from_uri(uri)

    def _path(self, uri: str) -> str:
        if self.local:
            return urlparse(uri).path
        from pyarrow import fs

        return fs.FileSystem.from_uri(uri)[1]

    def read(self, uri: str):
        return open(self._path(uri), "rb") if self.local else self.fs.open_input_stream(self._path(uri), compression=None)

    def open(self, uri: str):
        """As read(), for reading at any place."""
        return open(self._path(uri), "rb") if self.local else self.fs.open_input_file(self._path(uri))

    def stamp(self, uri: str) -> tuple[int, int]:
        """Size in bytes, and when the file was changed (in microseconds)."""
        if self.local:
            found = os.stat(self._path(uri))
            return found.st_size, found.st_mtime_ns // 1000
        info = self.fs.get_file_info(self._path(uri))
        return info.size, (info.mtime_ns or 0) // 1000

    def create(self, uri: str):
        path = self._path(uri)
        if self.local:
            os.makedirs(os.path.dirname(path), exist_ok=True)
            return open(path, "wb")
        self.fs.create_dir(os.path.dirname(path), recursive=True)
        return self.fs.open_output_stream(path, compression=None)

    def rename(self, old: str, new: str) -> None:
        if self.local:
            os.replace(self._path(old), self._path(new))
        else:
            self.fs.move(self._path(old), self._path(new))

    def remove(self, uri: str) -> None:
        path = self._path(uri)
        if self.local:
            if os.path.exists(path):
                os.remove(path)
        elif self.fs.get_file_info(path).is_file:
            self.fs.delete_file(path)

    def find(self, pattern: str) -> list[str]:
        """Files that fit a pattern, in order of their names."""
        if self.local:
            return sorted(p for p in glob.glob(self._path(pattern)) if os.path.isfile(p))
        from pyarrow import fs

        scheme, netloc, wanted, *_ = urlparse(pattern)
        # a store's own path begins with a bucket's name, or is the URI's path
        whole = self._path(f"{scheme}://{netloc}/x")
        wanted = whole[: -len("x")].rstrip("/") + wanted
        folder = wanted[: min(wanted.find(c) % (len(wanted) + 1) for c in "*?[")].rsplit("/", 1)[0]
        prefix = pattern[: len(pattern) - len(wanted)]
        found = self.fs.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
        return sorted(prefix + f.path for f in found if f.is_file and _fits(f.path, wanted))


def _fits(path: str, pattern: str) -> bool:
    """A star stands for no slash, as in a shell."""
    parts, wanted = path.split("/"), pattern.split("/")
    return len(parts) == len(wanted) and all(fnmatch.fnmatchcase(a, b) for a, b in zip(parts, wanted, strict=True))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI below spark.checkpoint.dir, which driver and executors share. Only where the session names none
    and runs on this machine alone (tests), one is made."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="seqsieve-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: plans that go on from it begin there, and it outlives lost executors."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
