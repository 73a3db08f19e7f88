"""Helpers shared by the training-data operators: shared storage, sizing and text basics."""

from __future__ import annotations

import atexit
import math
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that end a word: space, and tab to carriage return. ``bytes.split()`` splits on these six.
WS_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
WS_TABLE = np.isin(np.arange(256), list(WS_BYTES))
WS_CLASS = r"[\x20\x09-\x0D]"

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Only a session within one process may do without: it gets one of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="lakeweave-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; ``cleanup`` (also run at exit) removes it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def cleanup() -> None:
    """Remove every scratch path made so far; results that still read them become unusable."""
    while _made:
        spark, path = _made.pop()
        try:
            drop_path(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone at exit
            return


atexit.register(cleanup)


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends at files that outlive executors."""
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan out evenly when it has fewer splits than the cluster has cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_bucket(col: Column, n: int) -> Column:
    """crc32 of the id's decimal text, mod n; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(col.cast("string"), F.lit("")), "UTF-8")) % F.lit(n)


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def open_fs(uri: str):
    """(filesystem, path) of a URI, for workers that write or read files in the shared folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith(("file:", "/")) else (fs.LocalFileSystem(), uri)


def byte_slices(column: pa.Array, most: int = 8 << 20):
    """(first row, string array) slices of about ``most`` bytes; a longer text is alone in its slice."""
    column = column.cast(pa.large_string()).fill_null("")
    sizes = np.diff(offsets_of(column))
    ends = np.cumsum(sizes)
    at, n = 0, len(column)
    while at < n:
        base = ends[at] - sizes[at]
        stop = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield at, column.slice(at, stop - at)
        at = stop


def offsets_of(column: pa.Array) -> np.ndarray:
    """int64 offsets of a large_string/large_binary array, slices included."""
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(uint8 data, offsets from 0) of a large_string array."""
    off = offsets_of(column)
    data = column.buffers()[2] if len(column) else None
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices that concatenate the ranges [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def log2ceil(n: int) -> int:
    return max(0, math.ceil(math.log2(max(1, n))))
