"""Models stored as snapshots: all tables of a write become visible together.

A commit writes its tables to folders of their own and, last, one manifest that names the folder of every table. Readers
take one manifest and stay with it; nothing that a manifest names is ever overwritten. A write that fails leaves the
last manifest, so the old model, in place. A manifest's number can be taken once: of two writers that
started from the same snapshot, the second gets :class:`Conflict`.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from .writers import arranged


class Conflict(RuntimeError):
    """Another writer committed meanwhile."""


class Snapshots:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))

    def _files(self):
        return self._path().getFileSystem(self._conf)

    def versions(self) -> list[int]:
        """Numbers of the snapshots, oldest first."""
        place = self._path("manifests")
        if not self._files().exists(place):
            return []
        names = [status.getPath().getName() for status in self._files().listStatus(place)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("."))

    def manifest(self, version: int | None = None) -> dict:
        """Version and table folders of one snapshot, the last one unless told."""
        known = self.versions()
        if version is None:
            if not known:
                return {"version": 0, "tables": {}}
            version = known[-1]
        text = self.spark.read.text(f"{self.folder}/manifests/{version:09d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def read(self, version: int | None = None) -> dict[str, DataFrame]:
        """The tables of one snapshot; later commits do not touch them."""
        return {name: self.spark.read.parquet(f"{self.folder}/{path}") for name, path in self.manifest(version)["tables"].items()}

    def commit(self, tables: dict[str, DataFrame], base: dict | None = None) -> int:
        """Write ``tables`` as the next snapshot; tables of the ``base`` manifest that are not given are kept by name.

        ``base`` is the manifest that the new tables were made from, the present one unless told.
        """
        base = self.manifest() if base is None else base
        data = f"data/{uuid4().hex}"
        named = dict(base["tables"])
        for name, table in tables.items():
            arranged(name, table).write.parquet(f"{self.folder}/{data}/{name}")
            named[name] = f"{data}/{name}"
        version = base["version"] + 1
        self._publish({"version": version, "tables": named})
        return version

    def _publish(self, manifest: dict) -> None:
        """Write the manifest beside its place and move it there in one step, unless the place is taken."""
        ready = self._path("manifests", f".{uuid4().hex}")
        out = self._files().create(ready)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        place = self._path("manifests", f"{manifest['version']:09d}.json")
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path().toUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._files().makeQualified(ready), self._files().makeQualified(place), options)
        except Exception as error:
            self._files().delete(ready, False)
            if self._files().exists(place):
                raise Conflict(f"snapshot {manifest['version']} was committed by another writer") from error
            raise

    def expire(self, keep: int = 1) -> None:
        """Delete all but the last ``keep`` snapshots, and table folders that none of those names."""
        known = self.versions()
        kept = known[-keep:] if keep else []
        named = {path for version in kept for path in self.manifest(version)["tables"].values()}
        for version in known:
            if version not in kept:
                self._files().delete(self._path("manifests", f"{version:09d}.json"), False)
        for writes in self._files().listStatus(self._path("data")):
            for table in self._files().listStatus(writes.getPath()):
                if f"data/{writes.getPath().getName()}/{table.getPath().getName()}" not in named:
                    self._files().delete(table.getPath(), True)

    def drop(self) -> None:
        self._files().delete(self._path(), True)
