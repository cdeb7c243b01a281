"""The manifest of a lake: which folders make up each layer, version by version.

Every version is one small JSON file with the whole state, so a start reads one
file however many runs there were.  A version is committed by writing a
temporary file and renaming it to its number, which fails if that number is
there: of two writers that began from one version, the second one's commit is
refused.  (The file system's rename must refuse an existing target, as HDFS'
does.)  Data is written before, to folders that no other attempt uses, so a
run that dies leaves the version before it as it was.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import SparkSession

KEPT = 20  # versions that stay readable


class LostCommit(RuntimeError):
    """Another writer committed this version first; open the lake again."""


class Files:
    """The few file operations a lake needs, on any file system Spark reads."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def glob(self, pattern: str) -> list[str]:
        fs, p = self._at(pattern)
        return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])

    def age(self, path: str) -> float:
        """Seconds since the path was last written."""
        import time

        fs, p = self._at(path)
        return time.time() - fs.getFileStatus(p).getModificationTime() / 1000

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write the file whole, or leave what is there: false if it exists."""
        folder, name = path.rsplit("/", 1)
        fs, scratch = self._at(f"{folder}/.{name}-{uuid.uuid4().hex}")
        stream = fs.create(scratch, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(scratch.toUri(), self._conf)
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        never_replace = self._gateway.new_array(kind, 1)
        never_replace[0] = kind.NONE
        try:
            context.rename(scratch, self._jvm.org.apache.hadoop.fs.Path(path), never_replace)
            return True
        except (self._gateway_error(), PySparkException) as e:
            fs.delete(scratch, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise

    @staticmethod
    def _gateway_error():
        from py4j.protocol import Py4JJavaError

        return Py4JJavaError

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)


class Manifest:
    """The versions under `<base>/_manifest`."""

    def __init__(self, spark: SparkSession, base: str, kept: int = KEPT):
        self.files, self.folder, self.kept = Files(spark), f"{base.rstrip('/')}/_manifest", kept
        self.version = 0

    def versions(self) -> list[int]:
        found = (re.search(r"/v(\d+)\.json$", p) for p in self.files.glob(f"{self.folder}/v*.json"))
        return sorted(int(m[1]) for m in found if m)

    def _path(self, version: int) -> str:
        return f"{self.folder}/v{version:012d}.json"

    def load(self, version: int | None = None) -> dict:
        """The state of the newest version (or of one that is still kept); {} in a new lake."""
        there = self.versions()
        self.version = version if version is not None else there[-1] if there else 0
        return json.loads(self.files.read(self._path(self.version))) if self.version else {}

    def commit(self, state: dict) -> int:
        """Make `state` the version after the one loaded or committed last."""
        if not self.files.create(self._path(self.version + 1), json.dumps(state)):
            raise LostCommit(f"version {self.version + 1} of {self.folder} was committed by another writer")
        self.version += 1
        for old in self.versions():
            if old <= self.version - self.kept:
                self.files.delete(self._path(old))
        return self.version
