"""Helpers that several operators share: words, hashes, blocks of texts, shared folders."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.session import SHUFFLE_CLEANUP as _CLEANUP  # noqa: F401
from reelstat.session import drop_folder, ensure_checkpoint_dir, shuffles_removed  # noqa: F401

#: Texts are worked on in blocks of about this many characters, so that a task's
#: memory does not follow the number or the length of the rows of a batch.
BLOCK_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """The UTF-8 words of a text: runs without space, tab, line feed, VT, FF, CR."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """The same with A-Z in lower case (no other letter changes)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def hashes(items: list[bytes]) -> np.ndarray:
    """64-bit hashes of byte strings, the same in every process."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, items), np.uint64, len(items))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix, so that every output bit follows every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None


def release_memory() -> None:
    """Hand freed memory back to the system: workers live on between tasks, beside the executor's JVM."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def bound_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Arrow batches of at most ``rows`` rows, as rows hold whole texts; a setting of the user's stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # Spark's default
        spark.conf.set(key, str(rows))


def gathered(batches, column: str, limit: int) -> Iterator[list]:
    """Lists of the column's values with about ``limit`` characters, across batches."""
    held, size = [], 0
    for batch in batches:
        for _, _, texts in text_blocks(batch, column):
            held += texts
            size += sum(len(t) for t in texts if t)
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def text_blocks(batch: pa.RecordBatch, text: str, limit: int = BLOCK_CHARS, sizes: np.ndarray | None = None) -> Iterator[tuple[int, int, list]]:
    """(from, to, texts) for runs of rows with about ``limit`` characters (or as ``sizes`` has them); one longer text is a run of its own."""
    column = batch.column(batch.schema.get_field_index(text))
    if sizes is None:
        sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_string(column.type) else np.int32,
                                      len(column) + 1 + column.offset)[column.offset:]) if len(column) else []
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i, column.slice(start, i - start).to_pylist()
            start, held = i, 0
        held += int(size)
    if start < len(column):
        yield start, len(column), column.slice(start).to_pylist()
    release_memory()


def crc_of_id(doc_id) -> int:
    """crc32 of an id written as text."""
    return crc32(str(doc_id).encode())


def held_out(doc_id, modulus: int, remainder: int):
    """Column: whether crc32 of the id as text leaves this remainder (null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the session's checkpoint folder, which all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, written to the shared folder and read back: cuts lineage and is computed once."""
    path = shared_folder(df.sparkSession, purpose)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def smallest_hashes(df: DataFrame, column: str, size: int) -> list[str]:
    """The ``size`` different non-null texts of the smallest hashes, in their order; all if there are fewer.

    Only texts under a threshold leave a task, about twice as many as are
    wanted over the whole table, however many partitions it has. Copies
    combine before the shuffle. Where too few are found (nulls, copies) the
    threshold grows eightfold.
    """
    share = 2 * size / max(df.count(), 1)
    hashed = df.select(F.col(column).alias("t"), F.xxhash64(column).alias("h")).where("t is not null")
    while True:
        among = hashed if share >= 1 else hashed.where(F.col("h") < int(share * 2 ** 64) - 2 ** 63)
        rows = among.groupBy("h").agg(F.first("t").alias("t")).orderBy("h").limit(size).collect()
        if len(rows) == size or share >= 1:
            return [r["t"] for r in rows]
        share *= 8


def flat(parts: Iterable[np.ndarray], dtype) -> np.ndarray:
    parts = list(parts)
    return np.concatenate(parts) if parts else np.empty(0, dtype)


def int_arrays(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list array of the values, ``counts`` of them in each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))



def most_frequent(counts: DataFrame, key: str, count: str, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) by key of at most ``most`` rows (long key, positive long count): all rows whose count reaches
    the least power of 2^(1/8) that so few rows reach. A histogram of at most 512 rows finds it, so no task or
    driver ever holds more than ``most`` rows.
    """
    level = F.floor(F.log2(F.col(count)) * 8)
    held, least = 0, None
    for row in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True):
        held += row["n"]
        if held > most:
            break
        least = row["level"]
    if least is None:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rows = counts.where(level >= least).select(F.col(key).alias("k"), F.col(count).alias("c")).toPandas().sort_values("k")
    return rows["k"].to_numpy(np.int64), rows["c"].to_numpy(np.int64)


def marked(rows: DataFrame, slot) -> np.ndarray:
    """The different values of a column of small whole numbers (0 or more), ascending. They come to the driver as bitmaps
    of at most 4 KB for 32,768 numbers."""
    place = slot.cast("long") + 1
    found = rows.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    parts = [np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")) + (r["bucket"] - 1) * 32_768 for r in found]
    return np.sort(np.concatenate(parts)) if parts else np.empty(0, np.int64)
