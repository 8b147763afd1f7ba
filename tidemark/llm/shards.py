"""Sharding by a two-pass external shuffle.

Pass one scatters whole records uniformly over memory-sized buckets by a seeded hash;
pass two shuffles each bucket in memory (Spark's `shuffle` is a seeded Fisher-Yates).
The buckets, one after the other, are one random permutation of the table, which is
dealt to the shards in turn, so their counts differ by one row at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of a text (null: none) plus 16."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16


def shuffle_records(df: DataFrame, seed: int, size: Column, bucket_bytes: int = 16 << 20, index: str = "position") -> DataFrame:
    """All rows with their place (from 0, without gaps) in one random permutation.

    `size` is a row's size in bytes; a bucket holds about `bucket_bytes` of them, so set
    it to a share of a task's memory.  The hash covers every column: equal ids with
    other content part, and only rows equal in every column share a bucket for sure.
    The result depends on the rows and the seed alone.  Rows with nulls are rows like
    others; an empty table stays empty; a longer row than a bucket is a bucket's only
    excess.  A column called like `index` is replaced.  Columns must be orderable.
    """
    df = df.drop(index)
    place = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns])
    total = df.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    bucket = F.pmod(place, F.lit(buckets)).cast("int")
    counts = df.select(bucket.alias("bucket")).groupBy("bucket").count()
    before = F.sum("count").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    # One row for each bucket: where it begins.  It travels with the bucket's records, so nothing is joined.
    record = F.struct(place.alias("place"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    records = df.select(bucket.alias("bucket"), F.lit(None).cast("long").alias("before"), record.alias("record"))
    begins = counts.select("bucket", F.coalesce(before, F.lit(0)).alias("before"), F.lit(None).cast(records.schema["record"].dataType).alias("record"))
    whole = (
        records.unionByName(begins)
        .repartitionById(buckets, F.col("bucket"))
        .groupBy("bucket")
        .agg(F.max("before").alias("before"), F.collect_list("record").alias("records"))
    )
    shuffled = whole.select("before", F.shuffle(F.sort_array("records"), seed).alias("records"))
    rows = shuffled.select("before", F.posexplode("records").alias("at", "record"))
    return rows.select("record.row.*", (F.col("before") + F.col("at")).alias(index))


def shard_records(df: DataFrame, shards: int, seed: int, size: Column, bucket_bytes: int = 16 << 20) -> DataFrame:
    """All rows with `shard` (0 to shards - 1) and `slot` (from 0, without gaps, in each shard)."""
    placed = shuffle_records(df.drop("shard", "slot"), seed, size, bucket_bytes, "__position")
    at = F.col("__position")
    return placed.select(
        *[F.col(f"`{c}`") for c in placed.columns if c != "__position"], F.pmod(at, F.lit(shards)).cast("int").alias("shard"), F.expr(f"__position div {shards}").alias("slot")
    )


def write_shards(df: DataFrame, path: str, shards: int, seed: int, size: Column, bucket_bytes: int = 16 << 20) -> None:
    """Write one folder for each shard, its rows in the order of `slot`."""
    placed = shard_records(df, shards, seed, size, bucket_bytes)
    placed.repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def shard_query(documents: DataFrame, shards: int = 40, seed: int = 20250607) -> DataFrame:
    placed = shard_records(documents, shards, seed, text_size())
    return placed.select(
        "doc_id", text_size().alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast(T.IntegerType()).alias("grown_shard"),
    )
