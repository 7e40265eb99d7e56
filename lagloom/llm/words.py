"""Words of many texts as flat arrays, hashes of stretches of them, and tables dealt by a column."""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from lagloom.session import _own_folder

A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)  # odd constants of the usual 64-bit mixers
MOST = 1 << 20  # words a worker remembers


class Hashes(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in their order."""
    out = left * A + right
    out ^= out >> np.uint64(29)
    out *= B
    out ^= out >> np.uint64(32)
    return out


def rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from every place on."""
    count = max(len(hashes) - size + 1, 0)
    out, done, power, step = None, 0, hashes, 1
    while step <= size and count:
        if size & step:
            part = power[done : done + count]
            out = part if out is None else mix(out, part)
            done += step
        power = mix(power[:-step], power[step:])
        step *= 2
    return hashes[:0] if out is None else out


def first_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of the ``width`` values from every place on, the first of equal ones."""
    at, step = np.arange(len(values)), 1

    def merge(values: np.ndarray, at: np.ndarray, by: int) -> tuple[np.ndarray, np.ndarray]:
        later = values[by:] < values[:-by]
        return np.where(later, values[by:], values[:-by]), np.where(later, at[by:], at[:-by])

    if len(values) < width:
        return at[:0]
    while step * 2 <= width:
        values, at = merge(values, at, step)
        step *= 2
    return merge(values, at, width - step)[1] if width > step else at


def bucketed(df: DataFrame, column: str) -> DataFrame:
    """``df`` as a table of the shared folder, dealt by ``column``: a join on it moves the other side only."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"t{uuid.uuid4().hex}"
    (
        df.repartition(n, column).write.bucketBy(n, column).format("parquet").option("compression", "zstd")
        .option("path", f"{_own_folder(spark)}/{name}").saveAsTable(name)
    )
    return spark.table(name)
