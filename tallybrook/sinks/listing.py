"""A list of the finished parts of a table, replaced as a whole.

Parts are written to folders nobody reads yet; the list then names them, and only then are the parts they replace deleted. A reader takes
the newest list and reads what it names, so it sees all of a change or nothing of it, and a job that dies between the steps leaves
folders that no list names (``sweep`` removes them), never a table with a gap.

Lists are small JSON files with rising numbers, one line for each part at most: the driver's size is that of the number of parts. One
writer at a time changes a list.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

# Older lists stay for readers that have just looked them up.
KEPT_LISTS = 5


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def delete_folder(spark: SparkSession, path: str) -> None:
    files, where = _place(spark, path)
    files.delete(where, True)


def move_folder(spark: SparkSession, path: str, to: str) -> bool:
    """Give a folder another place; false if there is none."""
    files, where = _place(spark, path)
    if not files.exists(where):
        return False
    _, new = _place(spark, to)
    files.mkdirs(new.getParent())
    if not files.rename(where, new):
        raise OSError(f"{path} could not be moved to {to}")
    return True


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, without their file system's name."""
    files, where = _place(spark, pattern)
    return sorted(s.getPath().toUri().getPath() for s in files.globStatus(where) or [])


class Listing:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self) -> list[int]:
        names = [p.rsplit("/", 1)[1] for p in folders(self.spark, f"{self.path}/list-*.json")]
        return sorted(int(n[5:-5]) for n in names)

    def read(self) -> list[dict] | None:
        """The parts of the newest list; None where there has never been one."""
        numbers = self._numbers()
        if not numbers:
            return None
        files, where = _place(self.spark, f"{self.path}/list-{numbers[-1]:012d}.json")
        stream = files.open(where)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def replace(self, parts: list[dict]) -> None:
        """Make this the newest list: written under another name first, so that nobody reads half of it."""
        numbers = self._numbers()
        number = numbers[-1] + 1 if numbers else 0
        files, draft = _place(self.spark, f"{self.path}/.draft-{uuid.uuid4().hex}")
        stream = files.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(parts).encode()))
        finally:
            stream.close()
        _, final = _place(self.spark, f"{self.path}/list-{number:012d}.json")
        if not files.rename(draft, final):
            raise OSError(f"somebody else has written list {number} of {self.path}")
        for old in numbers[: max(0, len(numbers) + 1 - KEPT_LISTS)]:
            delete_folder(self.spark, f"{self.path}/list-{old:012d}.json")
