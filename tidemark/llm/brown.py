"""Class-based bigram model: P(word | class) * P(class | class before).

Words are assigned to classes by exchange: each word moves to the class that raises the
likelihood of the class bigrams most, all other words standing still; each half
round moves one half of the words, until they gain next to nothing.  The corpus is kept as blocks of tokens that point into a sorted word list of the block, so what travels
between tasks is one entry for each word of a block, not each token.  The vocabulary lies
in shards by ranges of the word hash.  Half rounds read counts of word pairs, made once; the
exchanged words, their counts and their classes are on the driver (17 bytes a word).
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spans import SPACE, mix, words_of
from tidemark.sources.scratch import cut_lineage

END = mix(np.array([0x656E64], np.uint64))[0]
BLOCK_TOKENS = 2_500_000
#: Half rounds without a gain that end the exchange: every word was moved twice.
PATIENCE = 4
_ZSTD = pa.Codec("zstd")
log = logging.getLogger(__name__)


def pack(x: np.ndarray) -> bytes:
    raw = x.tobytes()
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def unpack(blob: bytes, kind) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    return np.frombuffer(_ZSTD.decompress(blob[8:], size, asbytes=True), kind) if size else np.zeros(0, kind)


def held_out(doc_id: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds)) == fold, F.lit(False))


def _block(name: int, parts: list[tuple]) -> pa.RecordBatch:
    hashes, lengths, held, ids = (np.concatenate([p[i] for p in parts]) if i < 3 else pa.concat_arrays([p[3] for p in parts]) for i in range(4))
    parts.clear()
    words, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    # Frequent words get small numbers, which pack well.
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(words), np.uint32)
    rank[order] = np.arange(len(words), dtype=np.uint32)
    learned = np.bincount(inverse[~np.repeat(held, lengths)], minlength=len(words)).astype(np.uint32)
    columns = [pa.array([name])] + [pa.array([b], pa.binary()) for b in (words.tobytes(), pack(learned), pack(order.astype(np.uint32)), pack(rank[inverse]), pack(lengths), pack(held))]
    at = pa.array([0, len(ids)], pa.int32())
    return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(at, ids)], names=["block", "words", "learned", "order", "tokens", "lengths", "held", "ids"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    name = TaskContext.get().partitionId() << 32
    parts: list[tuple] = []
    held_tokens = 0
    for batch in batches:
        outside = batch.column("held").to_numpy(zero_copy_only=False)
        for lo, hi, words in words_of(batch.column("text"), SPACE):
            tokens = np.insert(words.hash, words.first[1:], END)
            parts.append((tokens, np.diff(words.first) + 1, outside[lo:hi], batch.column("doc_id").slice(lo, hi - lo)))
            held_tokens += len(tokens)
            if held_tokens >= BLOCK_TOKENS:
                yield _block(name, parts)
                name, held_tokens = name + 1, 0
    if parts:
        yield _block(name, parts)


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def _cut(hashes: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """Shards of sorted hashes with their ranges."""
    at = np.searchsorted(_shard(hashes, shards), np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(at)).tolist():
        yield s, slice(at[s], at[s + 1])


REQUEST = "shard int, block long, words binary, learned binary"


def _requests(shards: int):
    """One row for each block and shard: the block's words there, with their counts in learned documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = np.frombuffer(batch.column("words")[i].as_py(), np.uint64)
                learned = unpack(batch.column("learned")[i].as_py(), np.uint32)
                rows = [(s, words[r].tobytes(), learned[r].tobytes()) for s, r in _cut(words, shards)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([batch.column("block")[i].as_py()] * len(rows), pa.int64())]
                    + [pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2)],
                    names=["shard", "block", "words", "learned"],
                )

    return run


def _vocabulary(classes: int, min_count: int):
    """A shard of the vocabulary: words, counts and first classes."""

    def run(table: pa.Table) -> pa.Table:
        words = np.frombuffer(b"".join(table.column("words").to_pylist()), np.uint64)
        learned = np.frombuffer(b"".join(table.column("learned").to_pylist()), np.uint32)
        known, inverse = np.unique(words, return_inverse=True)
        counts = np.bincount(inverse, weights=learned, minlength=len(known)).astype(np.int64)
        known, counts = known[counts > 0], counts[counts > 0]
        kind = np.where(counts >= min_count, (mix(known) % np.uint64(classes)).astype(np.int64), classes).astype(np.uint8)
        kind[known == END] = classes + 1
        return _shard_table(table.column("shard")[0].as_py(), known, counts, kind, classes + 2)

    return run


VOCABULARY = "shard int, words binary, counts binary, classes binary, tokens array<long>, types array<long>"


def _shard_table(shard: int, words: np.ndarray, counts: np.ndarray, kind: np.ndarray, width: int) -> pa.Table:
    tokens = np.bincount(kind, weights=counts, minlength=width).astype(np.int64).tolist()
    types = np.bincount(kind, minlength=width).tolist()
    return pa.table(
        [pa.array([shard], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (words, counts, kind)), pa.array([tokens], pa.list_(pa.int64())), pa.array([types], pa.list_(pa.int64()))],
        names=["shard", "words", "counts", "classes", "tokens", "types"],
    )


def _shard_arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(table.column(c)[0].as_py() if table.num_rows else b"", t) for c, t in (("words", np.uint64), ("counts", np.int64), ("classes", np.uint8)))


ANSWER = "block long, shard int, counts binary, classes binary"


def _answer(rare: int):
    """Counts and classes of the words each block asks a shard for; unknown words have 0 and the rare class."""

    def run(key, asked: pa.Table, shard: pa.Table) -> pa.Table:
        words, counts, kind = _shard_arrays(shard)
        out = []
        for block, s, blob in zip(*(asked.column(c).to_pylist() for c in ("block", "shard", "words")), strict=True):
            want = np.frombuffer(blob, np.uint64)
            at = np.minimum(np.searchsorted(words, want), max(len(words) - 1, 0))
            hit = words[at] == want if len(words) else np.zeros(len(want), bool)
            c, k = np.zeros(len(want), np.int64), np.full(len(want), rare, np.uint8)
            c[hit], k[hit] = counts[at[hit]], kind[at[hit]]
            out.append((block, s, pack(c), pack(k)))
        return pa.table([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["block", "shard", "counts", "classes"])

    return run


def _of_block(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Counts and classes in the order of the block's word list: shards are ranges of it."""
    rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("shard", "counts", "classes")), strict=True))
    return np.concatenate([unpack(r[1], np.int64) for r in rows]), np.concatenate([unpack(r[2], np.uint8) for r in rows])


def _stream(row: dict, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of a block's tokens, their values, and the lengths of documents."""
    token = unpack(row["order"], np.uint32)[unpack(row["tokens"], np.uint32)]
    return token, values[token], unpack(row["lengths"], np.int64)


def _before(kind: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    before = np.empty_like(kind)
    before[1:] = kind[:-1]
    before[np.cumsum(lengths) - lengths] = end
    return before


EXCHANGED = "shard int, words binary, counts binary"


def _exchanged(classes: int):
    """The exchanged words of each shard, in order, and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, counts, kind = _shard_arrays(pa.Table.from_batches([batch.slice(i, 1)]))
                own = kind < classes
                columns = [pa.array([batch.column("shard")[i].as_py()], pa.int32()), *(pa.array([x[own].tobytes()], pa.binary()) for x in (words, counts))]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "words", "counts"])

    return run


def _parts(n: int, parts: int) -> np.ndarray:
    """Bounds of equal ranges of word numbers."""
    return np.arange(parts + 1) * n // parts


def _pack_pairs(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    return pack(np.diff(keys, prepend=0)), pack(counts)


def _unpack_pairs(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(unpack(keys, np.int64)), unpack(counts, np.int64)


#: side 0: pairs by their first word; 1: by their second word; -1: pairs without an exchanged word.
PAIRS = "part int, side int, keys binary, counts binary"
_PAIR_TYPES = (pa.int32(), pa.int32(), pa.binary(), pa.binary())


def _pair_table(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(_PAIR_TYPES)], names=["part", "side", "keys", "counts"])


def _word_pairs(exchanged: np.ndarray, classes: int, parts: int):
    """Counts of word pairs in a block's learned documents, by the part of each exchanged word.

    Words are numbers: those of the exchanged ones, then one for all rare words and the end.
    """
    n = len(exchanged)
    size, bounds = n + 2, _parts(n, parts)

    def run(key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        _, kinds = _of_block(answers)
        row = blocks.to_pylist()[0]
        number = np.where(kinds == classes + 1, n + 1, n)
        own = kinds < classes
        number[own] = np.searchsorted(exchanged, np.frombuffer(row["words"], np.uint64)[own])
        _, word, lengths = _stream(row, number)
        learned = ~np.repeat(unpack(row["held"], bool), lengths)
        both = _before(word, lengths, n + 1)[learned] * size + word[learned]
        del word, learned
        keys, counts = np.unique(both, return_counts=True)
        del both
        first, second = np.divmod(keys, size)
        none = (first >= n) & (second >= n)
        out = [(-1, -1, *_pack_pairs(keys[none], counts[none]))]
        for side, (own, other) in enumerate(((first, second), (second, first))):
            k = own * size + other
            order = np.argsort(k, kind="stable")
            k, c = k[order], counts[order]
            at = np.searchsorted(k, bounds * size)
            out += [(p, side, *_pack_pairs(k[at[p] : at[p + 1]], c[at[p] : at[p + 1]])) for p in np.flatnonzero(np.diff(at)).tolist()]
        return _pair_table(out)

    return run


def _merge_pairs(table: pa.Table) -> pa.Table:
    """Pair counts of a part over all blocks."""
    out = []
    for side in sorted(set(table.column("side").to_pylist())):
        held = [_unpack_pairs(r["keys"], r["counts"]) for r in table.to_pylist() if r["side"] == side]
        keys, inverse = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate([h[1] for h in held]), minlength=len(keys)).astype(np.int64)
        out.append((table.column("part")[0].as_py(), side, *_pack_pairs(keys, counts)))
    return _pair_table(out)


def _class_pairs(kind: np.ndarray, width: int):
    """Class pairs of word pairs, each word pair once."""
    size = len(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for batch in batches:
            for r in batch.to_pylist():
                keys, counts = _unpack_pairs(r["keys"], r["counts"])
                a, b = np.divmod(keys, size)
                if r["side"] == 1:  # the others are on side 0
                    late = b >= size - 2
                    a, b, counts = b[late], a[late], counts[late]
                total += np.bincount(kind[a].astype(np.int64) * width + kind[b], weights=counts, minlength=width * width).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], names=["pairs"])

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(kind: np.ndarray, after: np.ndarray, before: np.ndarray, pairs: np.ndarray, classes: int, step: int = 64) -> np.ndarray:
    """Best class of each word, all others standing still.

    The likelihood is the sum of N log N over class pairs less those of their margins; a
    word is taken out of its class and put into each in turn.
    """
    out = kind.copy()
    lead, follow = pairs.sum(axis=1), pairs.sum(axis=0)
    for lo in range(0, len(kind), step):
        k = kind[lo : lo + step]
        a, b = after[lo : lo + step].astype(float), before[lo : lo + step].astype(float)
        n, i = len(k), np.arange(len(k))
        # Without the word itself (pairs of the word with its own class count once on each side).
        base = np.repeat(pairs[None].astype(float), n, axis=0)
        base[i, k] -= a
        base[i, :, k] -= b
        base = np.maximum(base, 0)
        rows, cols = base[:, :classes], base[:, :, :classes].transpose(0, 2, 1)
        gain = (_xlogx(rows + a[:, None]) - _xlogx(rows)).sum(axis=2) + (_xlogx(cols + b[:, None]) - _xlogx(cols)).sum(axis=2)
        for margin, own in ((lead, a.sum(axis=1)), (follow, b.sum(axis=1))):
            m = np.repeat(margin[None, :classes].astype(float), n, axis=0)
            m[i, k] -= own
            m = np.maximum(m, 0)
            gain -= _xlogx(m + own[:, None]) - _xlogx(m)
        best = gain.argmax(axis=1)
        better = gain[i, best] > gain[i, k] + 1e-9
        out[lo : lo + step][better] = best[better]
    return out


def likelihood(pairs: np.ndarray) -> float:
    """Of the class bigrams over that of classes alone, in nats; what exchange raises."""
    x = pairs.astype(float)
    return float(_xlogx(x).sum() - _xlogx(x.sum(axis=0)).sum() - _xlogx(x.sum(axis=1)).sum() + _xlogx(x.sum()))


MOVED = "part int, classes binary"


def _exchange(pairs: np.ndarray, kind: np.ndarray, turn: np.ndarray, classes: int, parts: int):
    """Classes of a part's words after one half of them was moved."""
    width, size = classes + 2, len(kind)
    bounds = _parts(size - 2, parts)

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        lo, hi = bounds[part], bounds[part + 1]
        near = [np.zeros((hi - lo, width), np.int64), np.zeros((hi - lo, width), np.int64)]
        for r in table.to_pylist():
            keys, counts = _unpack_pairs(r["keys"], r["counts"])
            own, other = np.divmod(keys, size)
            near[r["side"]] += np.bincount((own - lo) * width + kind[other], weights=counts, minlength=(hi - lo) * width).astype(np.int64).reshape(-1, width)
        out, own = kind[lo:hi].copy(), np.flatnonzero(turn[lo:hi])
        out[own] = exchange(out[own], near[0][own], near[1][own], pairs, classes)
        return pa.table([pa.array([part], pa.int32()), pa.array([out.tobytes()], pa.binary())], names=["part", "classes"])

    return run


def _scores(emission: np.ndarray, transition: np.ndarray, total: int, types: int, exchanged: np.ndarray, kind_of: np.ndarray, end: int):
    """Per document; emission: tokens and types of each class that share its probability."""

    def run(key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        counts, kinds = _of_block(answers)
        row = blocks.to_pylist()[0]
        own = kinds < end - 1
        kinds[own] = kind_of[np.searchsorted(exchanged, np.frombuffer(row["words"], np.uint64)[own])]
        word = np.log10((counts + 1) / emission[kinds])
        plain = np.log10((counts + 1) / (total + types + 1))
        token, kind, lengths = _stream(row, kinds)
        each = word[token] + transition[_before(kind, lengths, end), kind]
        at = np.cumsum(lengths) - lengths
        sums = [np.add.reduceat(x, at) for x in ((counts[token] > 0).astype(np.int64), plain[token], each)]
        held = unpack(row["held"], bool)
        return pa.table(
            [blocks.column("ids").combine_chunks().flatten(), pa.array(held), pa.array(lengths), pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[2])],
            names=["doc_id", "held_out", "tokens", "known", "base", "score"],
        )

    return run


def _sum_of(table: DataFrame, column: str) -> np.ndarray:
    """Element-wise sum of an array column of fixed length."""
    rows = table.select(F.posexplode(column).alias("i", "n")).groupBy("i").agg(F.sum("n")).collect()
    out = np.zeros(max((r[0] for r in rows), default=-1) + 1, np.int64)
    for i, n in rows:
        out[i] = n
    return out


def score_documents(docs: DataFrame, held: Column, classes: int = 64, min_count: int = 50, rounds: int | None = None, smoothing: float = 1.0, tolerance: float = 0.005) -> DataFrame:
    """doc_id, held_out, tokens, known, train_tokens, base, score of every row of docs.

    Tokens are words (A-Z lower-cased, split at ASCII white space) and one end.  The
    model learns from the rows where `held` is false.  Words seen `min_count` times are
    exchanged among `classes` classes until PATIENCE half rounds raise the best class
    likelihood met (see `likelihood`) by no more than `tolerance` of it; `rounds`, if given,
    is the largest number of half rounds.  The best classes met are used.  Other words share one class, the end has its own,
    and one more word of the rare class stands for all unknown ones, so the probabilities
    of all next tokens sum to one.  `base` is the add-one unigram, `score` the class model, both
    log10.  Null and empty texts are one end; null ids are learned from; repeated rows
    are scored and counted each; if nothing is learned, all words are unknown; an empty table stays
    empty.  Other columns are ignored.  Words are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    shards = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rare, end, width = classes, classes + 1, classes + 2
    kinds = f"block long, words binary, learned binary, order binary, tokens binary, lengths binary, held binary, ids array<{id_type}>"
    blocks = cut_lineage(docs.select("doc_id", "text", held.alias("held")).mapInArrow(_blocks, kinds), "token-blocks")
    requests = blocks.select("block", "words", "learned").mapInArrow(_requests(shards), REQUEST)
    vocabulary = cut_lineage(requests.groupBy("shard").applyInArrow(_vocabulary(classes, min_count), VOCABULARY), "vocabulary")
    asked = requests.select("shard", "block", "words")

    def answers(vocabulary: DataFrame) -> DataFrame:
        out = asked.groupBy("shard").cogroup(vocabulary.select("shard", "words", "counts", "classes").groupBy("shard")).applyInArrow(_answer(rare), ANSWER)
        return cut_lineage(out, "block-words")

    known = answers(vocabulary)
    listed = sorted(vocabulary.mapInArrow(_exchanged(classes), EXCHANGED).collect())
    words, counts = (np.frombuffer(b"".join(bytes(r[c]) for r in listed), t) for c, t in (("words", np.uint64), ("counts", np.int64)))
    parts = max(1, min(shards, len(words)))
    own = blocks.select("block", "words", "order", "tokens", "lengths", "held").groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_word_pairs(words, classes, parts), PAIRS)
    near = cut_lineage(own.groupBy("part").applyInArrow(_merge_pairs, PAIRS), "word-pairs")

    def class_pairs(kind: np.ndarray) -> np.ndarray:
        return _square(_sum_of(near.mapInArrow(_class_pairs(kind, width), "pairs array<long>"), "pairs"), width)

    kind = np.concatenate([mix(words) % np.uint64(classes), [rare, end]]).astype(np.uint8)
    pairs = class_pairs(kind)
    bounds, best, now = _parts(len(words), parts), (kind, pairs), pairs
    trail = [likelihood(pairs)]
    log.info("first classes: class likelihood %.0f", trail[0])
    while len(words) and (rounds is None or len(trail) <= rounds):
        moving, kind = words % np.uint64(2) == (len(trail) - 1) % 2, kind.copy()
        for part, moved in near.where("part >= 0").groupBy("part").applyInArrow(_exchange(now, kind, moving, classes, parts), MOVED).collect():
            kind[bounds[part] : bounds[part + 1]] = np.frombuffer(bytes(moved), np.uint8)
        now = class_pairs(kind)
        trail.append(likelihood(now))
        log.info("half round %d: class likelihood %.0f", len(trail) - 1, trail[-1])
        if trail[-1] > max(trail[:-1]):
            best = kind, now
        # Words that move at once can be in each other's way, so one lower turn is no end.
        if len(trail) > PATIENCE and max(trail) - max(trail[:-PATIENCE]) <= tolerance * max(trail):
            break
    kind, pairs = best
    tokens, types = (np.pad(x := _sum_of(vocabulary, c), (0, width - len(x))) for c in ("tokens", "types"))
    tokens[:classes] = np.bincount(kind[:-2], weights=counts, minlength=classes)
    types[:classes] = np.bincount(kind[:-2], minlength=classes)
    total, distinct = int(tokens.sum()), int(types.sum())
    share = (tokens + 1) / (total + width)
    transition = np.log10((pairs + smoothing * share) / (pairs.sum(axis=1, keepdims=True) + smoothing))
    emission = tokens + types + (np.arange(width) == rare)
    scored = f"doc_id {id_type}, held_out boolean, tokens long, known long, base double, score double"
    out = blocks.select("block", "words", "order", "tokens", "lengths", "held", "ids").groupBy("block").cogroup(known.groupBy("block"))
    out = out.applyInArrow(_scores(emission.astype(float), transition, total, distinct, words, kind, end), scored)
    return out.withColumn("train_tokens", F.lit(total).cast("long"))


def _square(flat: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(width * width, np.int64)
    out[: len(flat)] = flat
    return out.reshape(width, width)


def brown_query(documents: DataFrame) -> DataFrame:
    out = score_documents(documents, held_out())
    return out.select("doc_id", "held_out", F.col("tokens").alias("n_tokens"), F.col("known").alias("n_known"), "train_tokens", F.col("base").alias("base_score"), "score")
