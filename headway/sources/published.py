"""Views published in one step.

All views of a run are written below ``<root>/version=<name>/``; then the small
file ``<root>/CURRENT`` is replaced, which makes them current together. A reader
resolves the version once and reads every view from it, so it never sees the views
of two runs, nor one half written. The last ``KEEP`` versions stay for readers that
resolved one of them before.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from headway.sources import files

POINTER = "CURRENT"
KEEP = 3


def version_root(spark: SparkSession, root: str) -> str | None:
    """Folder of the current version, or None before the first publication."""
    current = files.read_pointer(spark, os.path.join(root, POINTER))
    return None if current is None else os.path.join(root, current["version"])


class Version:
    """The next version of a root's views: write each at its path, then commit all of them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.before = files.read_pointer(spark, os.path.join(self.root, POINTER)) or {"number": 0, "kept": []}
        self.number = self.before["number"] + 1
        self.name = f"version={self.number:012d}-{uuid.uuid4().hex[:8]}"

    def path(self, view: str) -> str:
        return os.path.join(self.root, self.name, view)

    def previous(self, view: str) -> DataFrame | None:
        """The view as the version before has it."""
        old = self.before.get("version")
        path = os.path.join(self.root, old, view) if old else ""
        return self.spark.read.parquet(path) if old and files.exists(self.spark, path) else None

    def write(self, view: str, rows: DataFrame) -> DataFrame:
        """Write a view and read it back."""
        rows.write.parquet(self.path(view))
        return self.spark.read.parquet(self.path(view))

    def abandon(self) -> None:
        files.drop_folder(self.spark, os.path.join(self.root, self.name))

    def commit(self) -> None:
        """Make this version current, and drop those that are no longer kept."""
        kept = [*self.before["kept"], self.name][-KEEP:]
        files.write_pointer(self.spark, os.path.join(self.root, POINTER),
                            {"number": self.number, "version": self.name, "kept": kept})
        # an unfinished run's folder goes with the old versions once its number has passed
        for old in files.folders(self.spark, self.root):
            if old.startswith("version=") and old not in kept and old < self.name:
                files.drop_folder(self.spark, os.path.join(self.root, old))


def view_path(spark: SparkSession, path: str) -> str:
    """Where a view is now: ``<root>/<view>`` names the current version's, any other path itself."""
    root, view = os.path.split(path.rstrip("/"))
    current = version_root(spark, root)
    return path if current is None else os.path.join(current, view)


def read_view(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published view, or the plain table at ``path``."""
    return spark.read.parquet(view_path(spark, path))
