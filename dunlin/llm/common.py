"""Helpers of the corpus operators: text blocks out of Arrow batches, joins of a checked size."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dunlin.sources.checkpoints import new_folder

# Largest staged table (bytes of its files) that is sent to every executor instead of being
# joined by a shuffle. Results are the same either way.
BROADCAST_BYTES = 32 << 20

BLOCK_BYTES = 1 << 20


def let_workers_import(spark: SparkSession) -> None:
    """Put this checkout on the import path of Python workers that see its folder. On a cluster
    whose executors don't, submit the package with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def stage(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, kept when executors go."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def path_exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def staged_bytes(df: DataFrame) -> int:
    """Bytes of the files of a frame returned by ``stage``."""
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._staged_at)
    fs = path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    return fs.getContentSummary(path).getLength()


def sized(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a staged frame for broadcast if its files are small enough; otherwise leave the
    choice to the shuffle join."""
    return F.broadcast(df) if staged_bytes(df) <= limit else df


def drop_stage(*frames: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for df in frames:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._staged_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES
                ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of ``batch`` whose texts hold at most ``limit`` bytes (one row at least), each
    with its UTF-8 bytes and the row offsets in them. NULL texts are empty."""
    col = batch.column(column).cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if not n:
        return
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64, count=col.offset + n + 1)[col.offset:]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        b = min(b, n)
        yield batch.slice(a, b - a), data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_MULTIPLIER = 0x9E3779B97F4A7C13  # odd and 3 modulo 4
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}


def byte_codes() -> np.ndarray:
    """One fixed 64-bit code for each byte value."""
    if "codes" not in _tables:
        _tables["codes"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _tables["codes"]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the multiplier and of its inverse, modulo 2**64."""
    if len(_tables.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 4096)
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            out = np.empty(size, np.uint64)
            out[0], done, step = 1, 1, base
            while done < size:  # doubling: the next part is the first times base**done
                take = min(done, size - done)
                out[done:done + take] = out[:take] * np.uint64(step)
                step = step * step % (1 << 64)
                done += take
            _tables[name] = out
    return _tables["up"], _tables["down"]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums that give the hash of any piece of ``data``; see ``piece_hash``."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_codes()[data] * up[:len(data)], out=out[1:])
    return out


def piece_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal for equal pieces wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
