"""Sinks of a batch that appear together, and reference tables as they were when a batch first ran (SNK-3 to SNK-7, SRC-10).

A batch writes each sink to a folder of its own attempt. One small manifest, put in place by a rename once all are written,
makes them count; readers follow manifests, so a batch that was killed between two sinks is not seen, and one that comes
again after its manifest is left alone. Sinks that another stream reads as files wait in a hidden folder and are moved after
the manifest; a batch that comes again finishes such a move.

Snapshots keep numbered versions of a table. The version that a batch meets first is recorded under its number and holds
for every later run of that batch, whatever has been published since.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Folder:
    """Small files and renames through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str) -> tuple:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def exists(self, name: str) -> bool:
        fs, at = self._at(name)
        return fs.exists(at)

    def names(self, name: str) -> list[str]:
        fs, at = self._at(name)
        return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []

    def move(self, name: str, to: str) -> None:
        fs, at = self._at(name)
        target = self._at(to)[1]
        fs.mkdirs(target.getParent())
        if not fs.rename(at, target):
            raise OSError(f"{name} can't be moved to {to} in {self.path}")

    def delete(self, name: str) -> None:
        fs, at = self._at(name)
        fs.delete(at, True)

    def put(self, name: str, text: str) -> None:
        """Writes a whole file or none. One driver writes a name."""
        draft = f"_drafts/{uuid.uuid4().hex}"
        fs, at = self._at(draft)
        out = fs.create(at, True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        self.move(draft, name)

    def get(self, name: str) -> str:
        fs, at = self._at(name)
        data = fs.open(at)
        try:
            return bytes(data.readAllBytes()).decode()
        finally:
            data.close()


class CommitLog(Folder):
    """Batches of several sinks under one path."""

    def write(self, batch_id: int, sinks: dict[str, Callable[[str], None]], streamed: Iterable[str] = ()) -> bool:
        """Runs each sink's writer with the folder that it has to fill. False: the batch was whole already.

        streamed: sinks that file streams read, from the sink's folder under the path.
        """
        name = f"_commits/{batch_id:020d}.json"
        done = self.exists(name)
        if not done:
            attempt = uuid.uuid4().hex
            folders = {s: f"{'_waiting/' if s in set(streamed) else ''}{s}/batch={batch_id}-{attempt}" for s in sinks}
            for s, write in sinks.items():
                write(f"{self.path}/{folders[s]}")
            self.put(name, json.dumps(folders))
        self._publish(json.loads(self.get(name)))
        return not done

    def _publish(self, folders: dict[str, str]) -> None:
        for folder in folders.values():
            if folder.startswith("_waiting/") and self.exists(folder):
                self.move(folder, folder.removeprefix("_waiting/"))

    def batches(self) -> list[int]:
        return [int(x.split(".")[0]) for x in self.names("_commits")]

    def folders(self, sink: str) -> list[str]:
        """Of whole batches, in their order."""
        found = []
        for b in self.names("_commits"):
            folders = json.loads(self.get(f"_commits/{b}"))
            if sink in folders:
                plain = folders[sink].removeprefix("_waiting/")
                found.append(plain if self.exists(plain) else folders[sink])
        return [f"{self.path}/{x}" for x in found]

    def read(self, sink: str, schema: T.StructType | str, kind: str = "parquet") -> DataFrame:
        """The sink's rows of whole batches."""
        folders = self.folders(sink)
        return self.spark.read.schema(schema).format(kind).load(folders) if folders else self.spark.createDataFrame([], schema)

    def sweep(self) -> int:
        """Deletes what batches left that never became whole; how many folders. Not while a batch runs."""
        named = {x for b in self.names("_commits") for x in json.loads(self.get(f"_commits/{b}")).values()}
        named |= {x.removeprefix("_waiting/") for x in named}
        tops = [t for t in self.names(".") if t[0] not in "_."]
        found = [f"{top}/{x}" for top in [*tops, *(f"_waiting/{t}" for t in self.names("_waiting"))] for x in self.names(top) if x.startswith("batch=")]
        lost = [x for x in found if x not in named]
        for x in lost:
            self.delete(x)
        return len(lost)


class Snapshots(Folder):
    """Versions of one table."""

    def publish(self, rows: DataFrame) -> int:
        version = self.latest() + 1
        folder = f"v={version}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        self.put(f"_versions/{version:020d}", folder)
        return version

    def latest(self) -> int:
        """0: there is none yet."""
        return max((int(x) for x in self.names("_versions")), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self.get(f'_versions/{version or self.latest():020d}')}")

    def pinned(self, reader: str, batch_id: int) -> DataFrame:
        """The version that this batch of a reader (a stream's name) has, from its first call on."""
        name = f"_pins/{reader}-{batch_id:020d}"
        if not self.exists(name):
            self.put(name, str(self.latest()))
        return self.read(int(self.get(name)))


def at_batch(table: DataFrame | Snapshots, reader: str, batch_id: int) -> DataFrame:
    return table.pinned(reader, batch_id) if isinstance(table, Snapshots) else table
