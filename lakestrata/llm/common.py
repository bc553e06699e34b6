"""What the corpus operators share: text as bytes, ASCII lower case, word tables, batches of bounded size."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROWS_PER_BATCH = 1000       # rows that Spark hands to a Python worker at once
BYTES_PER_BATCH = 16 << 20  # and their size, which one longer row may exceed
BYTES_PER_BLOCK = 8 << 20   # text that a kernel works on at once


def prepare(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small, so that long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BYTES_PER_BATCH}b")
    return spark


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else. Pure ASCII text takes the fast path of ``lower``."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BYTES_PER_BLOCK) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose ``column`` holds about ``limit`` bytes at most; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if batch.num_rows > start:
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a binary column; null is empty, and bytes that are no UTF-8 count as U+FFFD."""
    return [x.decode("utf-8", "replace") if x else "" for x in batch.column(column).to_pylist()]


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, case aside."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hash64(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


class WordHashes(dict):
    """64-bit hash of a word, remembered for the words seen lately."""

    LIMIT = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = hash64(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
