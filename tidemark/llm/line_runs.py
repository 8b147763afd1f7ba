"""Line removal over levelled sorted runs of line hashes.

A run is a sorted table with one row for each line key: its two hashes, the number of
documents that hold it, and the largest of them.  Each batch of documents makes a run;
keys that earlier runs have settled are taken out by an anti-join before it is
written.  When a level has `fanout` runs, they are compacted into one of the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import cut_lineage, work_dir

BLANK = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEY = ["h1", "h2"]


def lines_of(text: str) -> Column:
    """Lines of a text; null or empty: one empty line."""
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, UPPER.lower())


def with_hashes(lines: DataFrame, min_chars: int) -> DataFrame:
    """Long enough lines with two independent 64-bit hashes of their keys."""
    keyed = lines.withColumn("key", key_of(F.col("line"))).where(F.char_length("key") >= min_chars)
    return keyed.withColumn("h1", F.xxhash64("key")).withColumn("h2", F.xxhash64(F.lit("line"), F.col("key"))).drop("key", "line")


class LineRuns:
    """Runs of line hashes in the shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int = 3, min_chars: int = 20, fanout: int = 4, path: str | None = None):
        self.spark, self.min_docs, self.min_chars, self.fanout = spark, min_docs, min_chars, fanout
        self.path = path or work_dir(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.made = 0

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, n long, top long").parquet(*paths)

    def _write(self, run: DataFrame, level: int) -> None:
        path = f"{self.path}/level-{level}-run-{self.made}"
        self.made += 1
        run.select("h1", "h2", "n", "top").sortWithinPartitions(*KEY).write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merged(full), level + 1)

    def _merged(self, paths: list[str]) -> DataFrame:
        return self._read(paths).groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("top").alias("top"))

    def _paths(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def add(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> None:
        """Add a batch.  A document's rows must all lie in one batch; rows of one id count once."""
        lines = docs.select(F.col(doc_id).alias("doc"), F.explode(lines_of(text)).alias("line"))
        held = with_hashes(lines, self.min_chars).distinct()
        run = held.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("top"))
        if paths := self._paths():
            # Settled: enough documents, and this batch has no larger one.
            settled = self._read(paths).where(F.col("n") >= self.min_docs).alias("s")
            run = run.alias("r").join(settled, F.expr("r.h1 = s.h1 and r.h2 = s.h2 and (r.top is null or r.top <= s.top)"), "left_anti")
        self._write(run, 0)

    def common(self) -> DataFrame:
        """h1, h2 and top (the largest document) of the keys in at least `min_docs` documents."""
        if not (paths := self._paths()):
            return self.spark.createDataFrame([], "h1 long, h2 long, top long")
        return self._merged(paths).where(F.col("n") >= self.min_docs).select(*KEY, "top")

    def drop_common(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Docs with `__kept` (text without the common lines) and `__lines`, `__dropped` (counts)."""
        row = [F.col(doc_id).alias("doc"), F.xxhash64(text).alias("version")]
        lines = with_hashes(docs.select(*row, F.posexplode(lines_of(text)).alias("pos", "line")), self.min_chars)
        # Written first: a line in very many documents is then a skewed join that Spark can split.
        common = cut_lineage(self.common(), "common-lines")
        gone = lines.join(common, KEY).where(~F.col("doc").eqNullSafe(F.col("top")))
        gone = gone.groupBy(F.col("doc").alias("__doc"), F.col("version").alias("__of")).agg(F.collect_set("pos").alias("__gone"))
        own = docs.withColumn("__version", F.xxhash64(text))
        joined = own.join(gone, F.col(f"`{doc_id}`").eqNullSafe(F.col("__doc")) & (F.col("__version") == F.col("__of")), "left").drop("__doc", "__of", "__version")
        every = F.sequence(F.lit(0), F.size("__all") - 1)
        kept = F.when(F.col("__gone").isNull(), every).otherwise(F.array_except(every, "__gone"))
        out = joined.withColumn("__all", lines_of(text)).withColumn("__at", kept)
        text_of = F.when(F.col("__gone").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(F.transform("__at", lambda i: F.get("__all", i)), "\n"))
        return (
            out.withColumn("__kept", text_of).withColumn("__lines", F.size("__all").cast("long"))
            .withColumn("__dropped", (F.size("__all") - F.size("__at")).cast("long")).drop("__all", "__at", "__gone")
        )


def dedup_lines(docs: DataFrame, batches: int = 4, min_docs: int = 3, min_chars: int = 20, fanout: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines whose key is in at least `min_docs` documents stay in the largest id only.

    Returns the table with `__kept`, `__lines` and `__dropped`.  Batches are id ranges
    from the largest down, so most repeated keys are settled early.  Rows with a null id
    are one document below all others; null text is one empty line; repeated rows of one
    id count as one document and lose the same lines; an empty table stays empty.  A
    column called doc, version, h1, h2, top or pos does no harm.
    """
    spark = docs.sparkSession
    runs = LineRuns(spark, min_docs, min_chars, fanout)
    cuts = docs.agg(F.percentile_approx(doc_id, [i / batches for i in range(1, batches)], 10_000)).first()[0] if batches > 1 else None
    cuts = sorted(set(cuts or []), reverse=True)
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    bounds = [None, *cuts, None]
    for above, below in zip(bounds, bounds[1:], strict=False):
        own = F.lit(True) if above is None else F.col("doc_id") < above
        if below is not None:
            own = own & (F.col("doc_id") >= below)
        elif above is not None:  # the last batch has the null ids
            own = own | F.col("doc_id").isNull()
        runs.add(slim.where(own))
    return runs.drop_common(docs, doc_id, text)


def line_query(documents: DataFrame) -> DataFrame:
    out = dedup_lines(documents.select("doc_id", "text"))
    return out.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"), F.sha2("__kept", 256).alias("kept_sha256"))
