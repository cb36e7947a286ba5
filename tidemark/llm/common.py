"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The word pattern of the contracts and the letters that are lower-cased.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def fold(c: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % mod


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only a local session (one process, as in tests) may fall back on a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidemark-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors, computes once."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def binary_list(col: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return col.cast(pa.binary() if col.type in (pa.string(), pa.binary()) else pa.large_binary()).to_pylist()


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased: bytes.split() cuts at exactly x20 and x09-x0D."""
    return text.lower().split() if text else []


def batches_of(it: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Cut incoming batches to at most ``rows`` rows."""
    for b in it:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def list_array(flat: np.ndarray, lengths: np.ndarray | list[int], kind: pa.DataType) -> pa.ListArray:
    off = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, kind))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (uint64 in, uint64 out); multiplications wrap around."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
