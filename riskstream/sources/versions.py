"""A small state on shared storage whose versions replace each other in one step."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_KEPT_VERSIONS = 20
_TRIES = 50


class Versions:
    """JSON texts ``v1.json``, ``v2.json``, ... in a folder; the highest one counts.

    A version is written beside and renamed, so a reader sees all of it or the one before. Of two
    writers that make the same version one starts again from the other's.
    """

    def __init__(self, spark: SparkSession, folder: str, empty: dict) -> None:
        self.spark, self._folder, self._empty = spark, folder, empty

    def exists(self) -> bool:
        return self._version() is not None

    def state(self) -> dict:
        version = self._version()
        return dict(self._empty) if version is None else json.loads(self._read(version))

    def change(self, change: Callable[[dict], dict]) -> dict:
        """Write the next version; what another writer wrote in between is taken in."""
        for _ in range(_TRIES):
            version = self._version()
            now = dict(self._empty) if version is None else json.loads(self._read(version))
            state = change(now)
            if self._write((version or 0) + 1, json.dumps(state)):
                return state
        raise RuntimeError(f"{self._folder} is changed by too many writers")

    def path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def names(self, pattern: str) -> list[str]:
        """Paths that a pattern matches."""
        found = self.path(pattern)
        return [s.getPath().toString() for s in self.fs(found).globStatus(found) or []]

    def delete(self, folder: str) -> None:
        path = self.path(folder)
        self.fs(path).delete(path, True)

    def _version(self) -> int | None:
        names = [n.rsplit("/", 1)[1] for n in self.names(f"{self._folder}/v*.json")]
        return max((int(n[1:-5]) for n in names), default=None)

    def _file(self, version: int):
        return self.path(f"{self._folder}/v{version}.json")

    def _read(self, version: int) -> str:
        file = self._file(version)
        stream = self.fs(file).open(file)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _write(self, version: int, text: str) -> bool:
        file, draft = self._file(version), self.path(f"{self._folder}/.{uuid.uuid4().hex}")
        fs = self.fs(file)
        stream = fs.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if fs.exists(file) or not fs.rename(draft, file):
            fs.delete(draft, False)
            return False
        old = self._file(version - _KEPT_VERSIONS)
        if fs.exists(old):
            fs.delete(old, False)
        return True
