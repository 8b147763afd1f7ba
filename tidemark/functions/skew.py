"""Building blocks that keep a hot key from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import as_col

SALTS = 32


def top_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    *,
    rank: str | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """The first n rows of every key, exactly, in two steps.

    Step one ranks inside (key, map partition mod salts), so even a key that owns a
    third of the input is spread over `salts` tasks, each of which has already been
    cut to n rows per map task before its shuffle (Catalyst's window group limit).
    Step two ranks the at most n * salts survivors of each key.
    """
    keys = list(keys)
    salted = df.withColumn("_salt", F.spark_partition_id() % salts)
    local = Window.partitionBy(*keys, "_salt").orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order) if keys else Window.partitionBy(F.lit(0)).orderBy(*order)
    name = rank or "_rank"
    out = (
        salted.withColumn("_local", F.row_number().over(local))
        .filter(F.col("_local") <= n)
        .drop("_local", "_salt")
        .withColumn(name, F.row_number().over(final))
        .filter(F.col(name) <= n)
    )
    return out if rank else out.drop(name)


def tag_first(
    df: DataFrame, key: str, order: str, *, flag: str = "is_first", salts: int = SALTS
) -> DataFrame:
    """Mark the first row of every key without gathering the copies of a key.

    The first position comes from a partial aggregate; only keys that do repeat are
    joined back, spread over `salts`, so a key with a third of all rows is split.
    `order` is the row's position and must be unique.
    """
    repeated = (
        df.groupBy(key)
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .select(key, "_first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    )
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(as_col(order)), F.lit(salts)).cast("int"))
    return (
        salted.join(repeated, [key, "_salt"], "left")
        .withColumn(flag, F.col("_first").isNull() | (as_col(order) == F.col("_first")))
        .drop("_salt", "_first")
    )


def attach_totals(df: DataFrame, by: Sequence[str], *aggs: Column) -> DataFrame:
    """Add per-group (or, without keys, global) aggregates to every row.

    The totals are a partial aggregate.  Without keys they come back as one scalar
    struct; with keys they are joined, one row per group, so the rows themselves are
    never gathered per group as `over(partitionBy(...))` would do.
    """
    by = list(by)
    if not by:
        totals = df.agg(F.struct(*aggs).alias("_t")).scalar()
        names = df.agg(*aggs).columns
        return df.withColumn("_t", totals).select(
            *df.columns, *[F.col("_t")[n].alias(n) for n in names]
        )
    keyed = df.groupBy(*by).agg(*aggs)
    names = [c for c in keyed.columns if c not in by]
    keyed = keyed.select(*[F.col(c).alias(f"_k_{c}") for c in by], *names)
    cond = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]
    joined = df.join(keyed, cond, "left")
    return joined.select(*df.columns, *names)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys of the same name, null equal to null; the left keys stay."""
    named = right.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return left.join(named, same, how).drop(*[f"_of_{k}" for k in keys])


def newest_rows(df: DataFrame, ts: str, tie: str, n: int, unit: str = "minute") -> DataFrame:
    """The newest n rows of a large table, exactly, without sorting it.

    Counts per time unit tell where the n-th newest row lies; only rows from that unit
    on (a filter the scan can use) take part in the final sort and limit.
    """
    per_unit = df.groupBy(F.date_trunc(unit, ts).alias("_u")).agg(F.count(F.lit(1)).alias("_n"))
    newer = Window.partitionBy().orderBy(F.desc("_u")).rowsBetween(Window.unboundedPreceding, -1)
    needed = per_unit.withColumn("_newer", F.coalesce(F.sum("_n").over(newer), F.lit(0))).filter(F.col("_newer") < n)
    cut = needed.agg(F.min("_u")).scalar()
    return df.filter(F.col(ts) >= cut).orderBy(F.desc(ts), F.desc(tie)).limit(n)


def with_position(
    df: DataFrame, by: Sequence[str], ts: str, ties: Sequence[str] = (), *, segment: int = 3600, out: str = "pos"
) -> DataFrame:
    """0-based position in time order per group, without one task per group.

    Rows are numbered inside (group, time segment); segment offsets come from a running
    sum over per-segment counts, one row per segment.
    """
    by = list(by)
    seconds = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(ts))
    rows = df.withColumn("_seg", F.floor(seconds / F.lit(segment)))
    counts = rows.groupBy(*by, "_seg").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_seg", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*by, "_seg").orderBy(ts, *ties)
    numbered = rows.withColumn("_r", F.row_number().over(inside) - 1)
    return join_null_safe(numbered, offsets, [*by, "_seg"]).withColumn(out, F.col("_off") + F.col("_r")).drop("_seg", "_r", "_off")
