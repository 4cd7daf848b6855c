"""What the operators share: reading a text column as bytes, hashes of words, running Arrow code.

Words are runs of bytes other than space and 09 to 0D; bytes below 80 never occur inside a longer
UTF-8 character, so words of bytes are words of characters.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.session import fresh_dir

WORD = r"[^\x20\x09-\x0D]+"

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Odd multipliers of the hashes below.
BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(column: str | Column = "text") -> Column:
    """A text as UTF-8 bytes; a null text is an empty one."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def fold(column: str, modulus: int) -> Column:
    """The remainder of crc32 over a number written as text; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def map_arrow(
    df: DataFrame, rows: Callable[[pa.RecordBatch], dict | list], schema: str
) -> DataFrame:
    """Applies ``rows``, which gives columns in the schema's order, to each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for out in _batches(rows(batch)):
                    yield out

    return df.mapInArrow(run, schema)


def _batches(found) -> Iterator[pa.RecordBatch]:
    if isinstance(found, dict):
        found = [found]
    for columns in found:
        yield pa.RecordBatch.from_arrays([as_arrow(x) for x in columns.values()], list(columns))


def as_arrow(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _MIX_A
    h = (h ^ (h >> np.uint64(27))) * _MIX_B
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
_POWERS = np.ones(1, dtype=np.uint64)
_INVERSES = np.ones(1, dtype=np.uint64)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse modulo 2 to the 64, to the powers 0 to n."""
    global _POWERS, _INVERSES
    if len(_POWERS) <= n:
        size = max(n + 1, 2 * len(_POWERS), 1 << 16)
        steps = np.full(size, BASE)
        back = np.full(size, _INVERSE)
        steps[0] = back[0] = 1
        _POWERS, _INVERSES = np.cumprod(steps), np.cumprod(back)
    return _POWERS, _INVERSES


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words of a text."""
    codes = np.frombuffer(data, dtype=np.uint8)
    space = SPACE[codes]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return starts, ends, np.zeros(0, dtype=np.uint64)
    powers, inverses = _powers(len(codes))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[codes] * powers[: len(codes)])))
    hashes = (sums[ends] - sums[starts]) * inverses[starts]
    return starts, ends, mix(hashes + (ends - starts).astype(np.uint64))


def windows_of(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; empty when there are fewer."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    last = len(words) - n + 1
    found = words[:last].copy()
    for k in range(1, n):
        found = found * BASE + words[k : last + k]
    return mix(found)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from each start to its end."""
    codes = np.frombuffer(data, dtype=np.uint8)
    powers, inverses = _powers(len(codes))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[codes] * powers[: len(codes)])))
    hashes = (sums[ends] - sums[starts]) * inverses[starts]
    return mix(hashes + (ends - starts).astype(np.uint64))


def gram_hashes(data: bytes, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` bytes, by doubling."""
    codes = np.frombuffer(data, dtype=np.uint8)
    last = len(codes) - length + 1
    if last < 1:
        return np.zeros(0, dtype=np.uint64)
    found, done = np.zeros(last, dtype=np.uint64), 0
    grams, size, step = _BYTE[codes], 1, BASE
    while True:
        if length & size:
            # The runs of this size that follow those already taken.
            found = found * step + grams[done : done + last]
            done += size
        if done == length:
            return mix(found)
        grams = grams[:-size] * step + grams[size:]
        size, step = 2 * size, np.uint64(int(step) ** 2 % (1 << 64))


def written_by(df: DataFrame, name: str, column: str) -> DataFrame:
    """The rows, written to the shared folder with a folder for each value, and read back."""
    path = fresh_dir(df.sparkSession, name)
    df.write.partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes the files of tables that ``written`` made, and lets Spark drop the shuffle files that
    nothing refers to any more."""
    jvm = spark._jvm
    for folder in {path.rpartition("/")[0] for df in tables for path in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    jvm.System.gc()
