"""Token-id output: Parquet files with an id list for each document, in ascending document order.

Columns: doc_id, part (the file's number), rel_start (ids before the document in its file), n_tokens, ids. Small
integers are delta-coded (writer version 2, no dictionary); ids are dictionary-coded. Row groups, pages and rows a
page are bounded, and every page has an entry in the column and offset index, so readers can fetch a few documents
or only the metadata columns. A manifest (one row a file) holds where each file begins in the whole sequence.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import byte_texts, materialize, pieces, starts_of, text_of
from .encoder import word_encoder

DATA = "doc_id long, part int, rel_start long, n_tokens long, ids array<int>"
MANIFEST = "part int, first_doc_id long, last_doc_id long, documents long, tokens long, start long"


def write_options(row_group_mb: int = 64, page_kb: int = 256, page_rows: int = 2000) -> dict[str, str]:
    """Options of the Parquet writer: encodings by column, row groups, pages."""
    plain = {f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "part", "rel_start", "n_tokens")}
    return plain | {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "true", "parquet.block.size": str(row_group_mb << 20), "parquet.page.size": str(page_kb << 10), "parquet.dictionary.page.size": str(1 << 20), "parquet.page.row.count.limit": str(page_rows), "compression": "zstd"}


def _encode(tokenizer_path: str, end_id: int):
    def run(batches):
        encoder, before, part = word_encoder(tokenizer_path), 0, TaskContext.get().partitionId()
        for batch in pieces(batches, "text"):
            ids, counts = encoder.encode(byte_texts(batch, "text"))
            at = starts_of(counts)
            ids, counts = np.insert(ids, at[1:], end_id), counts + 1
            at = starts_of(counts)
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(n, part, np.int32)), pa.array(before + at[:-1]), pa.array(counts), lists], ["doc_id", "part", "rel_start", "n_tokens", "ids"])
            before += int(at[-1])

    return run


def write_tokens(docs: DataFrame, path: str, *, tokenizer_path: str, end_id: int, options: dict[str, str] | None = None) -> None:
    """Encode the whole texts and write them, with ``end_id`` after each, under ``path``.

    Documents are dealt by ranges of doc_id (null first; an id of very many rows goes over many files), one file a range. A null text is
    empty and gives only the end id. Repeated rows are all written. An empty table gives an empty data folder.
    Columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # Ranges are cut by the id alone, so that a task that runs again deals its rows to the same files. Ids of so many
    # rows that they would fill much of a file, null among them, get a number a row, written once.
    counts = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    size = counts.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    most = max(1, (size["rows"] or 0) // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    if (size["most"] or 0) <= most:
        dealt = rows.repartitionByRange("doc_id")
    else:
        hot = counts.where(F.col("n") > most).select(F.col("doc_id").alias("hot"))
        same = F.col("doc_id").eqNullSafe(F.col("hot"))
        numbered = materialize(rows.join(hot, same, "left_semi").withColumn("order", F.monotonically_increasing_id()), "rows-of-large-ids")
        rest = rows.join(hot, same, "left_anti").withColumn("order", F.lit(0).cast("long"))
        dealt = rest.unionByName(numbered).repartitionByRange("doc_id", "order").drop("order")
    dealt = dealt.sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(_encode(tokenizer_path, end_id), DATA).write.options(**(options or write_options())).parquet(f"{path}/data")
    meta = read_tokens(spark, path).select("doc_id", "part", "n_tokens")
    files = meta.groupBy("part").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last_doc_id"), F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("tokens"))
    # One row a file: a window over all of them stays small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))).write.parquet(f"{path}/manifest")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The data files; select metadata columns or filter by doc_id to read only what is needed."""
    return spark.read.schema(DATA).parquet(f"{path}/data")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _digest(batches):
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("ids"))
        values, at = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(4)] + [pa.array(crc, pa.int64())], ["doc_id", "part", "rel_start", "n_tokens", "ids_crc32"])


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part), from the files: start counts the ids of all documents before."""
    found = read_tokens(spark, path).mapInArrow(_digest, "doc_id long, part int, rel_start long, n_tokens long, ids_crc32 long")
    files = read_manifest(spark, path).select("part", F.col("start").alias("file_start"))
    return found.join(files, "part").select("doc_id", (F.col("file_start") + F.col("rel_start")).alias("start"), "n_tokens", "ids_crc32", "part")
