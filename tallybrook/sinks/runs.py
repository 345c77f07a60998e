"""A table that grows by batches, folded in levels.

Every batch adds one run, a folder of its own. When a level holds ``fan`` runs they are folded into one of the next level, so the number of runs that a reader meets
grows with the logarithm of the batches, and each row is written again as often as there are levels. Which runs count says a list that
is replaced as a whole; a batch that is written again replaces its run.

A run may carry bounds (least and greatest value of a column), by which readers leave out whole runs before any file is opened.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallybrook.sinks.listing import Listing, delete_folder, folders

FAN = 4


class Runs:
    def __init__(self, spark: SparkSession, path: str, schema, fold: Callable[[DataFrame], DataFrame], place: Callable[[DataFrame], DataFrame], fan: int = FAN):
        """fold: rows of several runs to rows of one; place: how the rows of a run are laid out in files."""
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.fold, self.place, self.fan = fold, place, fan
        self.listing = Listing(spark, f"{self.path}/_lists")

    def parts(self) -> list[dict]:
        return self.listing.read() or []

    def read(self, parts: list[dict] | None = None) -> DataFrame:
        parts = self.parts() if parts is None else parts
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{p['run']}" for p in parts])

    def _write(self, rows: DataFrame) -> str:
        run = f"run-{uuid.uuid4().hex}"
        self.place(rows).write.parquet(f"{self.path}/{run}")
        return run

    def add(self, rows: DataFrame, batch: int, bounds: Callable[[DataFrame], list] | None = None) -> None:
        """Store a batch's rows under its number, in place of what it stored before."""
        run = self._write(rows)
        part = {"run": run, "level": 0, "first": batch, "last": batch}
        if bounds is not None:
            part["bounds"] = bounds(self.read([part]))
        before = self.parts()
        gone = [p for p in before if p["first"] == batch == p["last"]]
        self.listing.replace([p for p in before if p not in gone] + [part])
        self._drop(gone)

    def fold_up(self, before: int) -> None:
        """Fold full levels of runs whose batches are all smaller than ``before``: those are finished for good."""
        level = 0
        while True:
            parts = self.parts()
            if level > max((p["level"] for p in parts), default=-1):
                return
            full = sorted((p for p in parts if p["level"] == level and p["last"] < before), key=lambda p: p["first"])
            if len(full) >= self.fan:
                run = self._write(self.fold(self.read(full)))
                part = {"run": run, "level": level + 1, "first": full[0]["first"], "last": full[-1]["last"]}
                known = [p["bounds"] for p in full if p.get("bounds")]
                if known:
                    part["bounds"] = [min(b[0] for b in known), max(b[1] for b in known)]
                self.listing.replace([p for p in parts if p not in full] + [part])
                self._drop(full)
            level += 1

    def _drop(self, parts: list[dict]) -> None:
        for p in parts:
            delete_folder(self.spark, f"{self.path}/{p['run']}")

    def sweep(self) -> None:
        """Delete runs that no list names: what a job left that died."""
        named = {p["run"] for p in self.parts()}
        for path in folders(self.spark, f"{self.path}/run-*"):
            if path.rsplit("/", 1)[1] not in named:
                delete_folder(self.spark, path)
