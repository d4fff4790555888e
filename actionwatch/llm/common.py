"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text handled at once inside a task; a longer single text is handled alone.
PIECE_BYTES = 2 << 20


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is used only where that is unset and Spark runs
    in this process alone, as in tests; on a cluster it is an error, as executors would write to disks of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = _own_folder()
    return folder.rstrip("/")


_SCOPES: list[list[str]] = []


@contextmanager
def removing_intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what operators have written to the shared folder inside; their results must be stored by then."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)
        for path in paths:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _SCOPES[-1:]:
        paths.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def pieces(batches: Iterable[pa.RecordBatch], column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of a piece hold about ``most`` bytes at the most.

    Arrow's pool keeps what a piece has freed, tens of MB a worker; it is given back after each piece.
    """
    pool = pa.default_memory_pool()
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        at = 0
        ends = np.cumsum(lengths, dtype=np.int64)
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, to - at)
            pool.release_unused()
            at = to


def byte_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    return texts.fill_null("").cast(pa.binary()).to_pylist()


def coded_words(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts: codes in order, distinct words, words of each text."""
    whole = pc.ascii_trim_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
    lists = pc.ascii_split_whitespace(whole)
    counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    words = lists.flatten()
    if (empty := pc.binary_length(whole).to_numpy(zero_copy_only=False) == 0).any():
        # An empty text gives one empty word.
        words = words.filter(pa.array(~np.repeat(empty, counts)))
        counts[empty] = 0
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, counts


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Exclusive prefix sums."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start, start + count)``."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(total)


def segment_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of ``counts`` values."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    at = starts_of(counts)
    return total[at[1:]] - total[at[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer on unsigned 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself where printable, else the next free code point from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return {chr(b if b in own else next(free)): b for b in range(256)}
