"""Versions of a set of tables below one folder, and a pointer to the one in use.

A version is written whole to a folder of its own, checked there, and published by one
small file that names it. Readers follow the newest such file, so all tables change at
once, and a version that fails its checks changes nothing.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from transitlake.sources import tables

POINTERS = "_published"


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = tables.Files(spark, self.root)

    def _pointers(self) -> list[int]:
        names = self.files.names(POINTERS)
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"(\d+)\.json", n)))

    def _folders(self) -> dict[str, int]:
        names = self.files.names("")
        return {n: int(m[1]) for n in names if (m := re.fullmatch(r"version-(\d+)-\w+", n))}

    def current(self) -> dict | None:
        """The published version: its folder and the names of its tables."""
        pointers = self._pointers()
        if not pointers:
            return None
        return json.loads(self.files.read_text(f"{POINTERS}/{pointers[-1]}.json"))

    def begin(self) -> str:
        """A folder name for a new version; two that are written at once do not meet."""
        number = max(self._folders().values(), default=0) + 1
        return f"version-{number}-{uuid.uuid4().hex[:8]}"

    def path(self, version: str, name: str) -> str:
        return f"{self.root}/{version}/{name}"

    def publish(self, version: str, names: list[str], keep: int = 2) -> None:
        """Point readers to ``version`` and remove all but the last ``keep`` published.

        Versions newer than this one stay: they may be in the making.
        """
        pointers = self._pointers()
        number = pointers[-1] + 1 if pointers else 0
        self.files.write_text(
            f"{POINTERS}/{number}.json", json.dumps({"version": version, "tables": names})
        )
        kept = set()
        for n in (*pointers, number)[-keep:]:
            kept.add(json.loads(self.files.read_text(f"{POINTERS}/{n}.json"))["version"])
        folders = self._folders()
        for folder, n in folders.items():
            if folder not in kept and n < folders.get(version, 0):
                self.files.delete(folder)

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """A table of the published version."""
        current = self.current()
        if current is None:
            raise FileNotFoundError(f"nothing is published below {self.root}")
        return tables.read(self.spark, self.path(current["version"], name), schema)


def published(
    spark: SparkSession, root: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """A published table below ``root``."""
    return Versions(spark, root).read(name, schema)
