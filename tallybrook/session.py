"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the expressions in this package depend on. All are runtime SQL
# settings, so they can be applied to a session somebody else has built.
SEMANTICS = {
    # stored times are UTC wall clock
    "spark.sql.session.timeZone": "UTC",
    # a repeated key in one JSON object: the last one counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}

SCALING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in {**SEMANTICS, **SCALING}.items():
        spark.conf.set(name, value)
    return spark


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def own_shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of what is written within, as soon as it is written."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def local_session(app: str, cores: int | str = 8, memory: str = "8g") -> SparkSession:
    """One-machine session for tests and bench.py; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        # call sites in error messages cost several calls per expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_OWN_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for staged tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. A local session without
    that setting gets a folder of its own, the same for the whole application; a cluster without it is an error,
    since a machine-local folder would be lost with its machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    # the setting is fixed once a session runs, so the folder is remembered here
    application = spark.sparkContext.applicationId
    if application not in _OWN_FOLDERS:
        _OWN_FOLDERS[application] = tempfile.mkdtemp(prefix="tallybrook-")
    return _OWN_FOLDERS[application]
