"""N-gram Jaccard self-join by T-occurrence search.

Sets at least `threshold` alike share at least T elements, T a share of either set's
size.  Elements of one set alone cannot count, so sets with too few shared elements go
first, by exact counts over all sets.  What is left falls into small candidate
components (sets that share one of their rarest shared elements); in each, a set looks
for the earlier sets that share T elements with it: the short inverted lists are merged,
the long ones are probed by binary search for what is then left (DivideSkip).  Lists are
spans of one array, so both are steps over whole arrays.

Only pivots, sets without an earlier partner, are indexed; the others are members of a
pivot.  Jaccard distance is a metric, so a set linked to a member of a pivot is not
further from the pivot than the threshold plus the pivot's radius: a wider search finds
that pivot, and its members are compared only if they may join two components.  So a
group of many near copies costs a search of its pivots, and no link that joins
components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.spans import SPACE, grams, mix, releasing, releasing_groups, words_of
from tidemark.sources.scratch import cut_lineage

#: Elements of all sets that one task of the search holds, and those times its sets, to which its steps are in proportion.
UNIT = 4_000_000
WORK = 40_000_000_000


def shingles(words: np.ndarray, row: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles, by row and hash; rows of fewer words have one of all their words."""
    rows, hashes = [], []
    counts = np.diff(first)
    h = grams(words, size)
    inside = np.flatnonzero(row[: len(h)] == row[size - 1 :][: len(h)])
    rows.append(row[inside])
    hashes.append(h[inside])
    for m in range(1, size):
        if len(short := np.flatnonzero(counts == m)):
            rows.append(short)
            hashes.append(grams(words, m)[first[:-1][short]])
    r, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, r))
    r, h = r[order], h[order]
    keep = np.ones(len(r), bool)
    keep[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return r[keep], h[keep]


class Sets:
    """Shingle sets of a slice of a text column: bounds, hashes, and a hash of each set."""

    def __init__(self, words, rows: int, size: int):
        r, self.hash = shingles(words.hash, words.row, words.first, size)
        self.at = np.searchsorted(r, np.arange(rows + 1))
        self.n = np.diff(self.at)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(self.hash + np.uint64(1)))])
        self.node = mix(sums[self.at[1:]] - sums[self.at[:-1]] + self.n.astype(np.uint64)).view(np.int64)


def _overlap(n, threshold: tuple[int, int]):
    """Least number of elements shared with any partner."""
    return -(-n * threshold[0] // threshold[1])


def _nodes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words in words_of(batch.column("text"), SPACE):
                sets = Sets(words, hi - lo, size)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(sets.n), pa.array(sets.node)], names=["doc_id", "n", "node"])

    return run


def _dealt(nodes: np.ndarray, hashes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row for each bucket of hashes."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    cuts = [*first.tolist(), len(order)]
    nodes, hashes = nodes[order], hashes[order]
    parts = list(zip(cuts, cuts[1:], strict=False))
    return pa.RecordBatch.from_arrays(
        [pa.array(names), *(pa.array([x[a:b].tobytes() for a, b in parts], pa.binary()) for x in (hashes, nodes))], names=["bucket", "hashes", "nodes"]
    )


BUCKETS = "bucket int, hashes binary, nodes binary"


def _prefixes(size: int, buckets: int, threshold: tuple[int, int]):
    """The smallest hashes of each set, more than its unshared elements can fill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, hashes = [], []
            for lo, hi, words in words_of(batch.column("text"), SPACE):
                sets = Sets(words, hi - lo, size)
                length = np.minimum(sets.n, sets.n - _overlap(sets.n, threshold) + _spare(sets.n))
                place = np.arange(len(sets.hash)) - np.repeat(sets.at[:-1], sets.n)
                take = place < np.repeat(length, sets.n)
                nodes.append(np.repeat(sets.node, sets.n)[take])
                hashes.append(sets.hash[take])
            if nodes:
                yield _dealt(np.concatenate(nodes), np.concatenate(hashes), buckets)

    return run


def _spare(n):
    return -(-n // 10)


def _joined(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, node) pairs by hash, and how many nodes each hash has."""
    h = np.frombuffer(b"".join(table.column("hashes").to_pylist()), np.uint64)
    v = np.frombuffer(b"".join(table.column("nodes").to_pylist()), np.int64)
    order = np.lexsort((v, h))
    h, v = h[order], v[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (v[1:] != v[:-1])
    h, v = h[keep], v[keep]
    _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
    return h, v, counts[inverse]


def _shared_counts(table: pa.Table) -> pa.Table:
    _, v, df = _joined(table)
    nodes, counts = np.unique(v[df > 1], return_counts=True)
    return pa.table({"node": nodes, "shared": counts.astype(np.int64)})


def _rebuilt(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("node").to_numpy()
            for lo, hi, words in words_of(batch.column("text"), SPACE):
                sets = Sets(words, hi - lo, size)
                rows = np.flatnonzero(sets.node == wanted[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets.node[rows]), pa.array(sets.n[rows]), pa.array([sets.hash[sets.at[r] : sets.at[r + 1]].tobytes() for r in rows], pa.binary())],
                    names=["node", "n", "hashes"],
                )

    return run


def _deal_sets(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                blobs = part.column("hashes").to_pylist()
                n = np.array([len(b) // 8 for b in blobs])
                yield _dealt(np.repeat(part.column("node").to_numpy(), n), np.frombuffer(b"".join(blobs), np.uint64), buckets)

    return run


def _frequencies(parts: int):
    """Shared hashes with their numbers of sets, dealt by node."""

    def run(table: pa.Table) -> pa.Table:
        h, v, df = _joined(table)
        many = df > 1
        h, v, df = h[many], v[many], df[many].astype(np.int64)
        part = _part(v, parts)
        order = np.argsort(part, kind="stable")
        names, first = np.unique(part[order], return_index=True)
        cuts = [*first.tolist(), len(order)]
        columns = [[x[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)] for x in (v[order], h[order], df[order])]
        return pa.table([pa.array(names, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], names=["part", "nodes", "hashes", "dfs"])

    return run


def _part(nodes: np.ndarray, parts: int) -> np.ndarray:
    return (mix(nodes.view(np.uint64)) % np.uint64(parts)).astype(np.int32)


def _ranked(threshold: tuple[int, int]):
    """Sets with enough shared elements: those elements, and the rarest of them."""

    def run(key, sets: pa.Table, shared: pa.Table) -> pa.Table:
        v = np.frombuffer(b"".join(shared.column("nodes").to_pylist()), np.int64)
        h = np.frombuffer(b"".join(shared.column("hashes").to_pylist()), np.uint64)
        df = np.frombuffer(b"".join(shared.column("dfs").to_pylist()), np.int64)
        order = np.lexsort((h, df, v))
        v, h = v[order], h[order]
        sizes = dict(zip(sets.column("node").to_pylist(), sets.column("n").to_pylist(), strict=True))
        nodes, first, counts = np.unique(v, return_index=True, return_counts=True)
        out = []
        for node, a, m in zip(nodes.tolist(), first.tolist(), counts.tolist(), strict=True):
            least = _overlap(sizes[node], threshold)
            if m >= least:
                own = h[a : a + m]
                out.append((node, sizes[node], np.sort(own).tobytes(), own[: m - least + 1].view(np.int64).tolist()))
        return pa.table(
            [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())))], names=["node", "n", "hashes", "rare"]
        )

    return run


def _spans(flat: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The spans flat[lo:hi], one after the other."""
    size = hi - lo
    total = int(size.sum())
    if total > 32 * len(size):
        return np.concatenate([flat[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)])
    return flat[np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(total)]


def _merged(flat: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of the lists flat[lo:hi], ascending, and how many lists hold each."""
    entries = _spans(flat, lo, hi)
    if len(entries) and entries.max() < 8 * len(entries):
        counts = np.bincount(entries)
        found = np.flatnonzero(counts)
        return found, counts[found]
    return np.unique(entries, return_counts=True)


def _probed(flat: np.ndarray, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """How many of the ascending lists flat[lo:hi] hold each wanted entry: a binary search of all in all."""
    last = len(flat) - 1
    a, b = (np.repeat(x[:, None], len(wanted), axis=1) for x in (lo, hi))
    while (left := a < b).any():
        middle = (a + b) >> 1
        below = flat[np.minimum(middle, last)] < wanted
        a, b = np.where(left & below, middle + 1, a), np.where(left & ~below, middle, b)
    return ((a < hi[:, None]) & (flat[np.minimum(a, last)] == wanted)).sum(axis=0)


def occurrences(flat: np.ndarray, lo: np.ndarray, hi: np.ndarray, least: int, mu: float = 0.0085) -> tuple[np.ndarray, np.ndarray]:
    """Entries (from 0 on) found in at least `least` of the ascending lists flat[lo:hi], ascending, with their counts.

    The short lists are merged, and what enough of them hold is looked up in the long ones:
    by binary search, or all at once where the searches would be more steps than the lists
    have entries.
    """
    size = hi - lo
    if len(size) < least or least < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(-size, kind="stable")
    lo, hi, steps = lo[order], hi[order], log2(int(size[order[0]]) + 1)
    probed = min(least - 1, int(least / (mu * steps + 1)))
    found, counts = _merged(flat, lo[probed:], hi[probed:])
    enough = counts >= least - probed
    found, counts = found[enough], counts[enough]
    if probed and len(found):
        lo, hi = lo[:probed], hi[:probed]
        if 8 * steps * probed * len(found) < int((hi - lo).sum()):
            counts = counts + _probed(flat, lo, hi, found)
        else:
            counts = counts + np.bincount(_spans(flat, lo, hi), minlength=int(found[-1]) + 1)[found]
        enough = counts >= least
        found, counts = found[enough], counts[enough]
    return found, counts


def divide_skip(lists: list[list[int]], least: int) -> dict[int, int]:
    """Entries found in at least `least` of the ascending lists, with their counts."""
    ends = np.cumsum([0, *map(len, lists)])
    flat = np.array([x for entries in lists for x in entries], np.int64)
    return dict(zip(*(x.tolist() for x in occurrences(flat, ends[:-1], ends[1:], least)), strict=True))


class Search:
    """Sets (node, n, tokens) in the order they come, the pivots among them indexed."""

    def __init__(self, threshold: tuple[int, int], sets: list[tuple[int, int, np.ndarray]]):
        self.threshold = threshold
        self.alike = threshold[0] / threshold[1]
        self.nodes = np.array([s[0] for s in sets], np.int64)
        self.n = np.array([s[1] for s in sets], np.int64)
        self.known, self.tokens = np.unique(np.concatenate([s[2] for s in sets]), return_inverse=True)
        self.at = np.cumsum([0, *(len(s[2]) for s in sets)])
        self.mark = np.zeros(len(self.known), np.int32)
        # Inverted lists of pivots, each with room for all sets of its token.
        room = np.bincount(self.tokens)
        self.first = np.cumsum(room) - room
        self.end = self.first.copy()
        self.lists = np.zeros(len(self.tokens), np.int64)
        self.pivots = np.zeros(len(sets), np.int64)
        self.indexed = 0
        #: of members: their pivot, by its place among the pivots, and the distance to it
        self.pivot = np.full(len(sets), -1)
        self.away = np.zeros(len(sets))
        #: sets of each component, and the component of each set
        self.parts = {i: [i] for i in range(len(sets))}
        self.label = np.arange(len(sets))
        for me in range(len(sets)):
            self._add(me)

    def _linked(self, shared: np.ndarray, n: int, m: np.ndarray) -> np.ndarray:
        return self.threshold[1] * shared >= self.threshold[0] * (n + m - shared)

    def near(self, n: int, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pivots that may be, or may have members, linked to a set; with the number of shared elements."""
        wide = max(0.0, 2 * self.alike - 1)
        lo, hi = self.first[tokens], self.end[tokens]
        some = lo < hi
        return occurrences(self.lists, lo[some], hi[some], max(1, ceil(wide * n - 1e-9)))

    def _shared(self, tokens: np.ndarray, sets: np.ndarray) -> np.ndarray:
        """Number of elements that each of the sets shares with the tokens."""
        lo, hi = self.at[sets], self.at[sets + 1]
        self.mark[tokens] = 1
        out = np.add.reduceat(self.mark[_spans(self.tokens, lo, hi)], np.cumsum(hi - lo) - (hi - lo))
        self.mark[tokens] = 0
        return out

    def partners(self, n: int, tokens: np.ndarray, apart) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """Linked sets, some at a time: first the linked pivots with their distances, then members of other pivots, as far as `apart` holds for them by then."""
        found, shared = self.near(n, tokens)
        if not len(found):
            return
        pivots = self.pivots[: self.indexed]
        m = self.n[pivots[found]]
        distance = 1 - shared / (n + m - shared)
        linked = self._linked(shared, n, m)
        yield pivots[found[linked]], distance[linked]
        far = np.full(len(pivots), np.inf)
        far[found[~linked]] = distance[~linked]
        sets = np.flatnonzero(self.pivot >= 0)
        sets = sets[far[self.pivot[sets]] <= 1 - self.alike + self.away[sets] + 1e-9]
        m = self.n[sets]
        sets = sets[np.minimum(n, m) * self.threshold[1] >= np.maximum(n, m) * self.threshold[0]]
        sets = sets[np.argsort(far[self.pivot[sets]], kind="stable")]
        step = 64
        while len(sets := sets[apart(sets)]):
            some, sets = sets[:step], sets[step:]
            yield some[self._linked(self._shared(tokens, some), n, self.n[some])], None
            step *= 2

    def _unite(self, me: int, others: np.ndarray) -> None:
        for label in set(self.label[others].tolist()):
            mine = int(self.label[me])
            if label != mine:
                small, large = sorted((label, mine), key=lambda x: len(self.parts[x]))
                moved = self.parts.pop(small)
                self.label[moved] = large
                self.parts[large] += moved

    def _add(self, me: int) -> None:
        tokens = self.tokens[self.at[me] : self.at[me + 1]]
        for sets, distances in self.partners(int(self.n[me]), tokens, lambda sets: self.label[sets] != self.label[me]):
            if distances is not None and len(sets):
                self.pivot[me], self.away[me] = np.searchsorted(self.pivots[: self.indexed], sets[0]), distances[0]
            self._unite(me, sets)
        if self.pivot[me] < 0:
            self.lists[self.end[tokens]] = self.indexed
            self.end[tokens] += 1
            self.pivots[self.indexed] = me
            self.indexed += 1


FOUND = "node long, leader long, pivot boolean"


def _by_component(table: pa.Table) -> Iterator[list[tuple]]:
    """Distinct sets (n, node, tokens, ...) of each component, small ones first."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("component", "n", "node", "hashes")), strict=True), key=lambda x: x[:3])
    lo = 0
    while lo < len(rows):
        hi = lo
        group: dict[int, tuple] = {}
        while hi < len(rows) and rows[hi][0] == rows[lo][0]:
            group[rows[hi][2]] = (rows[hi][2], rows[hi][1], np.frombuffer(rows[hi][3], np.uint64))
            hi += 1
        yield list(group.values())
        lo = hi


def _search(threshold: tuple[int, int]):
    def run(table: pa.Table) -> pa.Table:
        out = []
        for group in _by_component(table):
            search = Search(threshold, group)
            leader = np.zeros(len(group), np.int64)
            for part in search.parts.values():
                leader[part] = search.nodes[part].min()
            out.append((search.nodes, leader, search.pivot < 0))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["node", "leader", "pivot"])

    return run


def _search_rest(threshold: tuple[int, int]):
    """Links of sets outside a component's largest part to the sets of one block."""

    def run(key, asked: pa.Table, block: pa.Table) -> pa.Table:
        label_of = dict(zip(block.column("node").to_pylist(), block.column("label").to_pylist(), strict=True))
        found = []
        for group in _by_component(block) if asked.num_rows else ():
            search = Search(threshold, group)
            labels = np.array([label_of[node] for node in search.nodes.tolist()], np.int64)
            for node, n, blob, label in zip(*(asked.column(c).to_pylist() for c in ("node", "n", "hashes", "label")), strict=True):
                tokens = np.frombuffer(blob, np.uint64)
                at = np.minimum(np.searchsorted(search.known, tokens), len(search.known) - 1)
                met = {label}
                for sets, _ in search.partners(n, at[search.known[at] == tokens], lambda sets: ~np.isin(labels[sets], [*met])):  # noqa: B023
                    for i in sets.tolist():
                        if labels[i] not in met:
                            met.add(int(labels[i]))
                            found.append((node, int(search.nodes[i])))
        return pa.table([pa.array([f[i] for f in found], pa.int64()) for i in range(2)], names=["a", "b"])

    return run


def _blocks(unit: int):
    """Into how many blocks some sets go."""
    total = F.sum("elements")
    return F.greatest(F.ceil(total / unit), F.ceil(F.sqrt(total * F.count(F.lit(1)) / WORK))).cast("long")


def linked_sets(sets: DataFrame, threshold: tuple[int, int], partitions: int, unit: int) -> DataFrame:
    """node, label of the sets (node, n, hashes) that have a link; label is the same within a component."""
    dealt = sets.mapInArrow(releasing(_deal_sets(2 * partitions)), BUCKETS)
    shared = dealt.groupBy("bucket").applyInArrow(releasing_groups(_frequencies(partitions)), "part int, nodes binary, hashes binary, dfs binary")

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_part(batch.column("node").to_numpy(), partitions)), *batch.columns], names=["part", "node", "n"])

    sizes = sets.select("node", "n").mapInArrow(parted, "part int, node long, n long")
    ranked = sizes.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(_ranked(threshold), "node long, n long, hashes binary, rare array<long>")
    ranked = cut_lineage(ranked, "ranked-sets")
    rare = ranked.select("node", F.explode("rare").alias("token"))
    first = cut_lineage(rare.groupBy("token").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last").select("token", "first"), "first-sets")
    edges = rare.join(first, "token").where("node > first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    candidates = components(edges).withColumnRenamed("label", "component")
    members = ranked.select("node", "n", "hashes").join(candidates, "node")
    members = cut_lineage(members.withColumn("elements", F.octet_length("hashes") / 8), "candidate-sets")
    large = cut_lineage(members.groupBy("component").agg(_blocks(unit).alias("blocks")).where("blocks > 1"), "large-components")
    large_at_all = bool(large.limit(1).count())

    def searched(table: DataFrame, seed: int) -> DataFrame:
        many = F.col("blocks") > 1
        group = F.when(many, F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(partitions)))
        block = F.when(many, F.pmod(F.xxhash64("node", F.lit(seed)), F.col("blocks"))).otherwise(-1)
        return table.withColumn("group", group).withColumn("block", block).groupBy("group", "block").applyInArrow(releasing_groups(_search(threshold)), FOUND)

    own = members.join(large, "component", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long"))) if large_at_all else members.withColumn("blocks", F.lit(1).cast("long"))
    found = cut_lineage(searched(own.select("component", "n", "node", "hashes", "blocks"), 0), "found-links")
    if not large_at_all:
        return found.select("node", F.col("leader").alias("label"))
    # Large components: the pivots of all blocks, then what still lies apart.
    in_large = cut_lineage(members.join(large, "component"), "large-sets")
    pivots = in_large.join(found.where("pivot").select("node"), "node", "left_semi").drop("blocks")
    shares = pivots.groupBy("component").agg(_blocks(unit).alias("blocks"))
    between = searched(pivots.join(shares, "component").select("component", "n", "node", "hashes", "blocks"), 1)
    links = found.select(F.col("node").alias("a"), F.col("leader").alias("b")).union(between.select("node", "leader"))
    links = cut_lineage(links, "links")
    labels = components(links)
    sized = in_large.join(labels, "node").groupBy("component", "label").agg(F.count(F.lit(1)).alias("k"))
    main = sized.groupBy("component").agg(F.max_by("label", F.struct("k", "label")).alias("main"), F.count(F.lit(1)).alias("apart")).where("apart > 1")
    rest = cut_lineage(in_large.join(labels, "node").join(main, "component"), "large-rest")
    asked = rest.where("label != main")
    chunks = asked.groupBy("component").agg(_blocks(unit).alias("chunks"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    block = F.pmod(F.xxhash64("node", F.lit(0)), F.col("blocks")).alias("block")
    chunk = F.pmod(F.xxhash64("node", F.lit(2)), F.col("chunks")).alias("chunk")
    sides = rest.join(chunks, "component")
    asked_side = cut_lineage(sides.where("label != main").select("component", each("blocks").alias("block"), chunk, "n", "node", "hashes", "label"), "asked")
    block_side = cut_lineage(sides.select("component", block, each("chunks").alias("chunk"), "n", "node", "hashes", "label"), "blocks")
    keys = ["component", "block", "chunk"]
    more = asked_side.groupBy(*keys).cogroup(block_side.groupBy(*keys)).applyInArrow(_search_rest(threshold), "a long, b long")
    return components(cut_lineage(links.union(more), "all-links"))


def similar_documents(docs: DataFrame, size: int = 5, threshold: tuple[int, int] = (80, 100), unit: int = UNIT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id integer, text).

    Words are runs without ASCII white space, A-Z lower-cased; a set holds the distinct
    shingles of `size` words, or all words of a shorter text.  Two rows link when
    threshold[1] * intersection >= threshold[0] * union; the threshold must be above a
    half.  component_id is the smallest id reachable by links.  Null, empty and blank
    texts have no shingles and link with nothing.  Equal sets always link.  A null id
    takes part but is never a component_id unless all ids of the component are null.
    Shingles and sets are compared by 64-bit hashes.  Other columns are ignored; an
    empty table stays empty.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text")
    rows = cut_lineage(texts.mapInArrow(releasing(_nodes(size)), f"doc_id {id_type}, n long, node long"), "document-sets")
    postings = texts.mapInArrow(releasing(_prefixes(size, 2 * partitions, threshold)), BUCKETS)
    shared = postings.groupBy("bucket").applyInArrow(releasing_groups(_shared_counts), "node long, shared long").groupBy("node").agg(F.sum("shared").alias("shared"))
    nodes = cut_lineage(rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n")), "sets")
    least = f"((n * {threshold[0]} + {threshold[1] - 1}) div {threshold[1]} + 9) div 10"
    alive = nodes.join(shared, "node").where(f"shared >= {least}").select(F.col("doc_id").alias("own"), "node")
    sets = texts.join(alive, F.col("doc_id").eqNullSafe(F.col("own"))).select("text", "node").mapInArrow(releasing(_rebuilt(size)), "node long, n long, hashes binary")
    labels = linked_sets(cut_lineage(sets, "rebuilt-sets"), threshold, partitions, unit)
    named = nodes.join(labels, "node", "left").select("node", "doc_id", F.coalesce("label", "node").alias("label"))
    least_id = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    owner = cut_lineage(named.join(least_id, "label").select("node", "component_id"), "set-components")
    out = rows.join(owner, "node", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def join_query(documents: DataFrame) -> DataFrame:
    return similar_documents(documents)
