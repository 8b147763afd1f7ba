"""Token ids as Parquet list columns.

Files hold consecutive ranges of documents in ascending order.  Ids are a list column
in pages with dictionary or delta encoding; counts and offsets are plain columns
beside it, so metadata can be read without the ids, and the page indexes let a reader
skip to some documents.  `before` counts the ids of the documents before it in its part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidemark.llm.bpe import ROWS, encoder
from tidemark.llm.spans import release

STORED = "part int, before long, doc_id long, n_tokens long, ids array<int>"


def _encode(path: str, pattern: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before, enc = TaskContext.get().partitionId(), 0, encoder(path, pattern)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            for lo, hi, ids, n in enc.column(batch.column("text")):
                ends = np.cumsum(n)
                closed = np.insert(ids, ends, end_id).astype(np.int32)
                n = n + 1
                at = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                rows = hi - lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows, part, np.int32)), pa.array(before + at[:-1].astype(np.int64)), batch.column("doc_id").slice(lo, rows), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(closed))],
                    names=["part", "before", "doc_id", "n_tokens", "ids"],
                )
                before += len(closed)
        release()

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str, pattern: str, end_id: int = 2, encoding: str = "dictionary", row_group_bytes: int = 16 << 20, page_bytes: int = 1 << 20) -> None:
    """Write the ids of all whole texts in ascending doc_id order, each followed by `end_id`.

    Null texts are empty: their end id alone.  Rows with a null id come first.  Equal ids
    stay neighbours, in the order of their texts' hashes.  Other columns are not stored.
    """
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", "tie"]
    ranged = slim.withColumn("tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = ranged.select("doc_id", "text").mapInArrow(_encode(vocabulary, pattern, end_id), STORED)
    writer = rows.write.mode("overwrite").option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
    writer = writer.option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
    if encoding == "delta":
        writer = writer.option("parquet.writer.version", "PARQUET_2_0")
    writer.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path)


def with_starts(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of stored documents with `start` (ids of all documents before) in place of part and before.

    Files hold the sums inside each part; one row for each part, read from the metadata
    columns alone, meets in one task for the parts' own starts.
    """
    earlier = F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("total")).select(F.col("part").alias("__part"), F.coalesce(earlier, F.lit(0)).alias("__earlier"))
    kept = [c for c in rows.columns if c not in ("part", "before")]
    return rows.join(parts, F.col("part") == F.col("__part")).select(*kept, (F.col("__earlier") + F.col("before")).alias("start"))


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("ids"))
        flat, at = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        names = [n for n in batch.schema.names if n != "ids"]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(crc, pa.int64())], names=[*names, "ids_crc32"])


def with_crc(stored: DataFrame) -> DataFrame:
    """`ids_crc32` of the stored ids as little-endian unsigned 32-bit integers, in place of the ids."""
    kept = [f for f in stored.schema.fields if f.name != "ids"]
    return stored.mapInArrow(_crc, T.StructType([*kept, T.StructField("ids_crc32", T.LongType())]))


def token_file_query(documents: DataFrame, path: str, vocabulary: str, pattern: str) -> DataFrame:
    write_tokens(documents, path, vocabulary, pattern)
    stored = read_tokens(documents.sparkSession, path)
    return with_starts(with_crc(stored), stored).select("doc_id", "start", "n_tokens", "ids_crc32")
