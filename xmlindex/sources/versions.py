"""Tables that are replaced as a whole: every version has its own folder.

A writer fills a folder that only it knows, then claims the next number with a marker that
names the folder. Markers are only ever created, never changed, so of two writers one
fails and leaves the other's rows alone, a reader sees either the old version or the new one, and
a path is never rewritten while it is read.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

from xmlindex.sources import files

# Seconds that a superseded version stays, for those who still read it.
GRACE = 24 * 3600.0


class VersionedFolder:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _markers(self) -> list[int]:
        names = files.list_names(self.spark, f"{self.path}/_versions")
        return sorted(int(n[1:]) for n in names if n[1:].isdigit())

    def _marker(self, version: int) -> str:
        return f"{self.path}/_versions/v{version}"

    def current(self) -> int:
        """Number of the newest published version, 0 if there is none."""
        return max(self._markers(), default=0)

    def folder(self, version: int) -> str:
        """Where a version's rows are; before the first one is published, a folder to start with."""
        return f"{self.path}/{files.read_text(self.spark, self._marker(version)) if version else 'first'}"

    def new_folder(self) -> str:
        """A folder no other writer uses."""
        return f"{self.path}/data-{uuid.uuid4().hex}"

    def publish(self, version: int, folder: str) -> None:
        """Make `folder` this version; fails if another writer has claimed the number."""
        if not self.claim(version, folder):
            raise FileExistsError(f"version {version} of {self.path} exists already")

    def claim(self, version: int, folder: str) -> bool:
        """Make `folder` this version; False if another writer has claimed the number."""
        return files.publish_text(self.spark, self._marker(version), folder.rsplit("/", 1)[1])

    def drop_superseded(self, grace: float = GRACE) -> None:
        """Delete versions that were replaced more than `grace` seconds ago."""
        versions = [0, *self._markers()]
        for old, newer in zip(versions, versions[1:]):
            replaced_at = files.modified(self.spark, self._marker(newer))
            if time.time() - replaced_at >= grace:
                files.delete(self.spark, self.folder(old))
                if old:
                    files.delete(self.spark, self._marker(old))
