"""Manifests: which files make up a stored table, one small JSON document for each version.

A version is written beside the others under a temporary name and renamed, so readers see the old list or the new one. The
list has an entry for each file or folder of the table, never for rows; the driver holds it as it holds the listing of any scan.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass
class Version:
    """One state of a table: its number, the last batch it contains, its entries, facts that hold for the table."""

    number: int
    batch: int | None = None
    entries: list[dict] = field(default_factory=list)
    facts: dict = field(default_factory=dict)


class Manifest:
    """The versions below ``root``/_manifest."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.path = self._path(f"{root}/_manifest")
        self.files = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def numbers(self) -> list[int]:
        """Versions that exist, ascending."""
        found = self.files.globStatus(self._path(f"{self.path.toString()}/*.json"))
        return sorted(int(status.getPath().getName().removesuffix(".json")) for status in found or [])

    def read(self, number: int) -> Version:
        stream = self.files.open(self._path(f"{self.path.toString()}/{number:09d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(number, **json.loads(text))

    def latest(self, before: int | None = None) -> Version | None:
        """The newest version, or the newest that holds only batches below ``before``."""
        for number in reversed(self.numbers()):
            version = self.read(number)
            if before is None or version.batch is None or version.batch < before:
                return version
        return None

    def commit(self, version: Version) -> None:
        """Write a version; fails if another writer has taken its number."""
        text = json.dumps({"batch": version.batch, "entries": version.entries, "facts": version.facts})
        target = self._path(f"{self.path.toString()}/{version.number:09d}.json")
        temporary = self._path(f"{self.path.toString()}/_{version.number:09d}.tmp")
        stream = self.files.create(temporary, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.files.exists(target) or not self.files.rename(temporary, target):
            raise FileExistsError(f"version {version.number} of {self.root} was written by someone else")

    def forget(self, keep: int = 2) -> int:
        """Drop all but the newest ``keep`` versions and the data folders that none of those names; gives the number of folders."""
        numbers = self.numbers()
        for number in numbers[:-keep]:
            self.files.delete(self._path(f"{self.path.toString()}/{number:09d}.json"), False)
        used = {entry["folder"] for number in numbers[-keep:] for entry in self.read(number).entries}
        dropped = 0
        for status in self.files.globStatus(self._path(f"{self.root}/data/*")) or []:
            if status.getPath().getName() not in used:
                self.files.delete(status.getPath(), True)
                dropped += 1
        return dropped
