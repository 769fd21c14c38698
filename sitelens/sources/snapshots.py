"""Versions of a table, each published at once or not at all.

A version's rows are written to a folder of their own; then a manifest that names
the folder is written beside its place and renamed into it.  A reader takes
what manifests name, so a half-written version is never read, and of two writers of
one version the first to publish wins: writing a version again, as a restarted job or
a replayed micro-batch does, changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._base = self._path(f"{self.root}/manifests")
        self._fs = self._base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._base)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _manifest(self, version: int):
        return self._path(f"{self.root}/manifests/{version:010d}.json")

    def versions(self) -> list[int]:
        """The published versions, ascending."""
        names = [f.getPath().getName() for f in self._fs.listStatus(self._base)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def facts(self, version: int) -> dict:
        """What ``save`` was given besides the rows."""
        return self._load(version)["facts"]

    def _load(self, version: int) -> dict:
        stream = self._fs.open(self._manifest(version))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def save(self, version: int, df: DataFrame, **facts) -> DataFrame:
        """Publishes ``df`` as the version, unless it is published; reads it back."""
        if not self._fs.exists(self._manifest(version)):
            folder = f"{self.root}/data/{version:010d}-{uuid.uuid4().hex[:12]}"
            df.write.parquet(folder)
            self._publish(version, {"folder": folder, "schema": df.schema.json(), "facts": facts})
        return self.read(version)

    def _publish(self, version: int, manifest: dict) -> bool:
        draft = self._path(f"{self.root}/manifests/.{version:010d}-{uuid.uuid4().hex}")
        stream = self._fs.create(draft)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        # a rename onto an existing file fails or is refused: the first manifest stays
        if self._fs.exists(self._manifest(version)) or not self._fs.rename(draft, self._manifest(version)):
            self._fs.delete(draft, False)
            return False
        return True

    def read(self, *versions: int) -> DataFrame:
        """The rows of the named versions, or of all."""
        found = [self._load(v) for v in versions or self.versions()]
        schema = T.StructType.fromJson(json.loads(found[0]["schema"]))
        return self.spark.read.schema(schema).parquet(*[m["folder"] for m in found])
