"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from meridian.session import fresh_path

_U = np.uint64
#: splitmix64 finaliser constants (fixed values)
_MIX1, _MIX2, _STEP = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15)


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` under the shared folder and read it back."""
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_path = path
    return back


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove tables of ``written`` whose successors are written and that no later plan reads."""
    for df in tables:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (splitmix64 finaliser), wrapping on overflow."""
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (order matters); empty when too short."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    mult = 1
    for j in range(k):
        out += hashes[j:j + n] * _U(mult)
        mult = mult * int(_STEP) & 0xFFFFFFFFFFFFFFFF
    return mix64(out + _U(k))


def digest16(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def utf8_values(column: pa.Array) -> list[bytes | None]:
    """Text column of an Arrow batch as UTF-8 bytes, nulls kept."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return values.view(np.int64)
