"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.session import CLEANUP as _CLEANUP
from tallybrook.session import own_shuffles_dropped, shared_dir

#: Input text that is worked on at once in a Python worker; one longer text is a group of its own.
GROUP_BYTES = 4 << 20


#: Bytes of a batch of rows on its way to or from a Python worker, where the session names none.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Ten thousand long texts, Spark's usual batch, would take much of a worker's memory."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared one, so that no run sees another's files."""
    return f"{shared_dir(bounded_batches(spark))}/llm-{uuid.uuid4().hex}"


def stage(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write a table into the shared folder and read it back: cuts the lineage, survives lost executors, and leaves no shuffle files."""
    path = run_folder(df.sparkSession)
    with own_shuffles_dropped(df.sparkSession):
        df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, column: str) -> DataFrame:
    """``stage`` in as many buckets as a shuffle has partitions: a later grouping by ``column`` does not move these rows again."""
    name = f"llm_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(shuffle_width(df.sparkSession), column).option("compression", "zstd").option("path", run_folder(df.sparkSession))
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def lowest_hashes(known: DataFrame, group: str, hash_col: str, rows: int) -> DataFrame:
    """For every value of ``group``, its ``rows`` smallest distinct hashes; a hash is any long that spreads evenly.

    Ranked are only hashes below a bound that some four times ``rows`` of a group's are expected to keep, so ranking does
    not grow with the table. Groups are label values: few.
    """
    counts = known.groupBy(group).agg(F.approx_count_distinct(hash_col)).collect()
    near = F.lit(False)
    for value, count in counts:
        bound = -(1 << 63) + int(min(1.0, 4 * rows / max(count, 1)) * ((1 << 64) - 2048))
        near = near | ((F.col(group) == value) & (F.col(hash_col) <= bound))
    order = Window.partitionBy(group).orderBy(hash_col)
    ranked = known.filter(near).select(group, hash_col).distinct().withColumn("_n", F.row_number().over(order))
    return ranked.filter(F.col("_n") <= rows).select(group, hash_col)


#: Bits for each wanted key, and the most bits that a table of them has (32 MB).
KEY_BITS, MOST_BITS = 16, 1 << 28


def likely_among(rows: DataFrame, column: str, keys: DataFrame, then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None, schema: str | None = None) -> DataFrame:
    """Rows whose long ``column`` is in ``keys`` (distinct, one column), and a few more: for a join that would else shuffle all rows.

    Every task holds a table of bits, one of which is set for each key. It has ``KEY_BITS`` bits a key and ``MOST_BITS`` at most; with many more keys it
    lets more rows pass, and at last all. The bits are put together by the tasks; the driver gets the finished table. What is to be done ``then`` with these rows,
    giving rows of ``schema``, the same Python worker does: a second one for each task would stay in the executor's memory.
    """
    spark = rows.sparkSession
    bits = 1 << 15
    wanted = keys.count()
    while bits < min(MOST_BITS, KEY_BITS * wanted):
        bits *= 2
    place = lambda c: F.xxhash64(c).bitwiseAND(F.lit(bits - 1))
    name = keys.columns[0]
    at = place(F.col(name)) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    whole = np.zeros((bits >> 15, 4096), np.uint8)
    for part, own in parts:
        whole[part - 1] = np.frombuffer(own, np.uint8)
    shared = spark.sparkContext.broadcast(whole.ravel())

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = shared.value
        for batch in batches:
            v = batch.column(batch.num_columns - 1).to_numpy()
            set_ = ((table_[v >> 3] >> (v & 7).astype(np.uint8)) & 1).astype(bool)
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(set_))

    # a null key is in no table
    placed = rows.filter(F.col(column).isNotNull()).select("*", place(F.col(column)).alias("_place"))
    return placed.mapInArrow(held if then is None else lambda batches: then(held(batches)), rows.schema if then is None else schema)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column) -> Column:
    """The fold that no label is learned from; a null id is never learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else, unlike lower()."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def groups(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = GROUP_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut batches into runs of rows with about ``limit`` bytes of text. Only the run at hand is turned into Python objects.

    Workers are used again by other tasks, so what this one has freed goes back to the system at its end.
    """
    for batch in batches:
        column = batch.column(text)
        start = size = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
            if size and size + n > limit:
                yield batch.slice(start, i - start), texts_of(column.slice(start, i - start))
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start), texts_of(column.slice(start))
        del batch, column
    give_back()


def drop_shuffles(spark: SparkSession) -> None:
    """Shuffle files of finished steps go when the driver collects its garbage, which by itself it does every half hour only."""
    gc.collect()
    spark._jvm.System.gc()


def give_back() -> None:
    """Free memory of a Python worker to the system, as far as it lets itself be freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def carried(docs: DataFrame, text_col: str, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """The text as ``text`` with the columns to keep, and their names there; a text that is kept itself goes to the workers once."""
    bounded_batches(docs.sparkSession)
    names = ["text" if c == text_col else f"k{i}" for i, c in enumerate(keep)]
    return docs.select(docs[text_col].alias("text"), *[docs[c].alias(n) for c, n in zip(keep, names) if n != "text"]), names


def exclusive_sum(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate flat[start:start + length] for every pair."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(total)
    return flat[at]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
