"""Benchmark decontamination by winnowing.

Of every `window - gram + 1` consecutive k-grams the smallest hash is a fingerprint, so
each span of `window` words has one, at the same place wherever the span stands.
Fingerprints of documents and test items are joined, and each hit is extended word by
word as far as a window can reach around it: all windows shared with an item are found.
Items shorter than a window are one gram of their own length.

A bit map of fixed size of the items' fingerprints goes to all tasks and drops most of
the documents' fingerprints before the join.  It only lets more through when it fills.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spans import NOT_ALNUM, grams, mix, releasing, words_of
from tidemark.sources.scratch import cut_lineage

#: 2**23 bits: 1 MB.
FILTER_BITS = 23
SEED = "array<struct<fp: long, at: long, size: int, around: binary>>"


def fingerprints(words: np.ndarray, rows: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the winnowed k-grams of rows' words, and all k-gram hashes."""
    span = window - gram + 1
    h = grams(words, gram)
    n = len(h) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), h
    inside = rows[:n] == rows[window - 1 : window - 1 + n]
    views = np.lib.stride_tricks.sliding_window_view(h, span)[inside]
    return np.unique(np.flatnonzero(inside) + views.argmin(axis=1)), h


def _around(words: np.ndarray, rows: np.ndarray, at: np.ndarray, gram: int, window: int, none: int) -> np.ndarray:
    """Words around each place, as far as windows over it reach; `none` beyond the row."""
    reach = window - gram
    index = at[:, None] + np.arange(-reach, gram + reach)
    valid = (index >= 0) & (index < len(words))
    index = np.clip(index, 0, max(len(words) - 1, 0))
    return np.where(valid & (rows[index] == rows[at][:, None]), words[index], np.uint64(none))


def _slot(fp: np.ndarray) -> np.ndarray:
    return (fp >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _seeds(words: np.ndarray, rows: np.ndarray, sizes: list[int], gram: int, window: int, none: int, bits: np.ndarray | None):
    """(fp, place, size, around) of winnowed and of short grams, as far as the filter has them."""
    found = []
    at, h = fingerprints(words, rows, gram, window)
    for size in [0, *sizes]:
        if size:
            h = mix(grams(words, size) + np.uint64(size))
            at = np.flatnonzero(rows[: len(h)] == rows[size - 1 :][: len(h)])
        fp = h[at]
        if bits is not None and len(at):
            keep = bits[_slot(fp)]
            at, fp = at[keep], fp[keep]
        if len(at):
            around = _around(words, rows, at, gram, window, none) if not size else np.zeros((len(at), 0), np.uint64)
            found += zip(fp.view(np.int64).tolist(), at.tolist(), [size] * len(at), map(np.ndarray.tobytes, around), strict=True)
    return found


def _items(gram: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id")
            for lo, hi, w in words_of(batch.column("text"), NOT_ALNUM):
                out = []
                for r in range(hi - lo):
                    a, b = int(w.first[r]), int(w.first[r + 1])
                    own = w.hash[a:b]
                    rows = np.zeros(b - a, np.int64)
                    if b - a >= window:
                        out += [(lo + r, *s) for s in _seeds(own, rows, [], gram, window, 1, None)]
                    elif b > a:
                        out += [(lo + r, *s) for s in _seeds(own, rows, [b - a], gram, window, 1, None) if s[2]]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array([o[0] for o in out], pa.int64())), *(pa.array([o[i] for o in out], t) for i, t in ((1, pa.int64()), (3, pa.int32()), (4, pa.binary())))],
                    names=["item_id", "fp", "size", "around"],
                )

    return run


def _documents(sizes: list[int], bits: bytes, gram: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        have = np.unpackbits(np.frombuffer(bits, np.uint8)).view(bool)
        kind = pa.list_(pa.struct([("fp", pa.int64()), ("at", pa.int64()), ("size", pa.int32()), ("around", pa.binary())]))
        for batch in batches:
            for lo, hi, w in words_of(batch.column("text"), NOT_ALNUM):
                seeds: list[list[tuple]] = [[] for _ in range(hi - lo)]
                for fp, at, size, around in _seeds(w.hash, w.row, sizes, gram, window, 0, have):
                    r = int(w.row[at])
                    seeds[r].append({"fp": fp, "at": at - int(w.first[r]), "size": size, "around": around})
                n = hi - lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), batch.column("doc_id").slice(lo, n), pa.array(np.diff(w.first)), pa.array(seeds, kind)],
                    names=["row", "doc_id", "n_words", "seeds"],
                )
                row += n

    return run


def _extend(gram: int, window: int):
    reach = window - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("size").to_numpy()
            at = batch.column("at").to_numpy()
            lo, hi = at.copy(), at + size
            long = np.flatnonzero(size == 0)
            if len(long):
                pick = pa.array(long)
                doc, item = (np.frombuffer(b"".join(batch.column(c).take(pick).to_pylist()), np.uint64).reshape(len(long), -1) for c in ("around", "item_around"))
                same = doc == item
                left = np.cumprod(same[:, reach - 1 :: -1], axis=1).sum(axis=1) if reach else np.zeros(len(long), np.int64)
                right = np.cumprod(same[:, reach + gram :], axis=1).sum(axis=1)
                whole = same[:, reach : reach + gram].all(axis=1) & (left + gram + right >= window)
                lo[long] = np.where(whole, at[long] - left, 0)
                hi[long] = np.where(whole, at[long] + gram + right, 0)
            ok = pa.array(hi > lo)
            out = pa.RecordBatch.from_arrays([batch.column("row"), batch.column("item_id"), pa.array(lo), pa.array(hi)], names=["row", "item_id", "lo", "hi"])
            yield out.filter(ok)

    return run


def contamination(docs: DataFrame, items: DataFrame, gram: int = 5, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted id strings) of every row of docs.

    `docs` has doc_id and text, `items` item_id and text; other columns are ignored.
    Null and empty texts have no words.  Repeated rows are judged one by one.  Items
    with equal windows are all listed, each id once; an item without an id marks words
    but is not listed.  Without items nothing is hit.
    """
    tests = cut_lineage(
        items.select("item_id", "text").mapInArrow(_items(gram, window), f"item_id {items.schema['item_id'].dataType.simpleString()}, fp long, size int, around binary").distinct(), "test-fingerprints"
    )
    # At most 2**FILTER_BITS / 64 rows, and at most window - 1 sizes.
    slots = tests.select(F.shiftrightunsigned("fp", 64 - FILTER_BITS).alias("slot"))
    words = slots.groupBy(F.expr("slot div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("mask")).collect()
    sizes = sorted(r[0] for r in tests.where("size > 0").select("size").distinct().collect())
    have = np.zeros(1 << FILTER_BITS, bool)
    for word, mask in words:
        have[word * 64 : word * 64 + 64] = [mask >> i & 1 for i in range(64)]
    bits = np.packbits(have).tobytes()
    docs_type = docs.schema["doc_id"].dataType.simpleString()
    found = cut_lineage(docs.select("doc_id", "text").mapInArrow(releasing(_documents(sizes, bits, gram, window)), f"row long, doc_id {docs_type}, n_words long, seeds {SEED}"), "document-fingerprints")
    seeds = found.where(F.size("seeds") > 0).select("row", F.inline("seeds"))
    pairs = seeds.join(tests.withColumnRenamed("around", "item_around"), ["fp", "size"]).select("row", "at", "size", "around", "item_id", "item_around")
    hits = pairs.mapInArrow(_extend(gram, window), f"row long, item_id {items.schema['item_id'].dataType.simpleString()}, lo long, hi long")
    hits = cut_lineage(hits.distinct(), "hits")
    marked = hits.select("row", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)).alias("word")).distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    listed = hits.select("row", "item_id").distinct().groupBy("row").agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    out = found.select("row", "doc_id", "n_words").join(marked, "row", "left").join(listed, "row", "left")
    names = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(names).cast("long").alias("n_items"), names.alias("items"))


def decontamination_query(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    out = contamination(documents, benchmark)
    return out.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )
