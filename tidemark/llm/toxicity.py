"""Counterfactual-regularised toxicity classifier.

Features of a text are its distinct words and word beginnings.  Counts of them by
label choose the model's features; a logistic model is fitted on a bounded sample of
labelled rows.  Sentences with an identity term are copied with the term swapped for
each other term of its group, and the fit is penalised for every change of score
between a sentence and its copies, so that a term alone moves no score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spans import NOT_LETTER, releasing, Words, words_of

#: Interchangeable terms for groups of people; "people" is the neutral term of each.
IDENTITY_TERMS = (
    ("people", "women", "men", "girls", "boys"),
    ("people", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("people", "gay", "lesbian", "straight", "transgender", "bisexual"),
    ("people", "black", "white", "asian", "latino", "arab", "african", "european"),
    ("people", "immigrants", "refugees", "foreigners", "citizens"),
    ("people", "disabled", "deaf", "blind", "autistic"),
)
#: Bytes of the word beginnings that are features, with a salt for each.
BEGINNINGS = (4, 5, 6)


def _salt(length: int) -> np.uint64:
    return np.uint64(length * 0xA24BAED4963EE407 % (1 << 64))


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word index and feature, for each word and each of its beginnings."""
    n = np.arange(len(words.start))
    which, found = [n], [words.hash]
    size = words.end - words.start
    for length in BEGINNINGS:
        has = np.flatnonzero(size > length)
        which.append(has)
        found.append(words.prefix_hash(length)[has] ^ _salt(length))
    return np.concatenate(which), np.concatenate(found)


def _of_terms(terms: list[str]) -> list[np.ndarray]:
    out = []
    for _, _, words in words_of(pa.array(terms), NOT_LETTER):
        which, found = features(words)
        out = [found[words.row[which] == r] for r in range(len(terms))]
    return out


def train_part(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Rows whose labels may be learned from; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(folds)) != 0


@dataclass
class Model:
    """Sorted features, their weights, and a bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, words: Words, rows: int) -> np.ndarray:
        which, found = features(words)
        at = np.searchsorted(self.keys, found)
        at[at == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[at] == found) if len(self.keys) else np.zeros(0, np.int64)
        pairs = np.unique(words.row[which[hit]] * len(self.keys) + at[hit]) if len(hit) else hit
        z = self.bias + np.bincount(pairs // max(1, len(self.keys)), weights=self.weights[pairs % max(1, len(self.keys))], minlength=rows)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _label_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column("label").to_numpy()
        keys, toxic = [], []
        for lo, _, words in words_of(batch.column("text"), NOT_LETTER):
            which, found = features(words)
            row = words.row[which]
            order = np.lexsort((found, row))
            row, found = row[order], found[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
            keys.append(found[new])
            toxic.append(labels[lo + row[new]])
        if keys:
            key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            label = np.concatenate(toxic)
            one = np.bincount(inverse, weights=label, minlength=len(key)).astype(np.int64)
            every = np.bincount(inverse, minlength=len(key))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(one), pa.array(every - one)], names=["feature", "toxic", "clean"])


def _examples(keys: np.ndarray):
    """Label and feature indices of each sampled text, and of its copies with swapped identity terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def index(found: np.ndarray) -> list[int]:
            at = np.searchsorted(keys, found)
            at[at == len(keys)] = 0
            return np.unique(at[keys[at] == found]).tolist() if len(keys) else []

        groups = [(terms, _of_terms(list(terms))) for terms in IDENTITY_TERMS]
        for batch in batches:
            out = []
            for lo, hi, words in words_of(batch.column("text"), NOT_LETTER):
                which, found = features(words)
                order = np.argsort(words.row[which], kind="stable")
                which, found = which[order], found[order]
                cuts = np.searchsorted(words.row[which], np.arange(hi - lo + 1))
                for r in range(hi - lo):
                    own, word = found[cuts[r] : cuts[r + 1]], which[cuts[r] : cuts[r + 1]]
                    own_words = words.hash[words.first[r] : words.first[r + 1]]
                    swapped = []
                    for _, of_terms in groups:
                        for i, term in enumerate(of_terms):
                            if term[0] in own_words:
                                rest = own[words.hash[word] != term[0]]
                                swapped += [index(np.concatenate([rest, other])) for j, other in enumerate(of_terms) if j != i]
                    out.append((index(own), swapped))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([o[0] for o in out], pa.list_(pa.int32())), pa.array([o[1] for o in out], pa.list_(pa.list_(pa.int32())))],
                names=["label", "own", "swapped"],
            )

    return run


def _matrix(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return rows, np.array([i for x in lists for i in x], np.int64)


def fit(labels: np.ndarray, own: list[list[int]], swapped: list[list[list[int]]], width: int, ridge: float, fairness: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and bias: logistic loss, ridge, and the mean squared change of score over swaps.

    Adam over the whole sample; rows are put in a fixed order first, so a fit is repeatable.
    """
    rows, cols = _matrix(own)
    pairs = [(x, y) for x, ys in zip(own, swapped, strict=True) for y in ys]
    a_rows, a_cols = _matrix([x for x, _ in pairs])
    b_rows, b_cols = _matrix([y for _, y in pairs])
    weights, bias = np.zeros(width), float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        z = bias + np.bincount(rows, weights=weights[cols], minlength=len(labels))
        wrong = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) / len(labels)
        grad = np.bincount(cols, weights=wrong[rows], minlength=width) + ridge * weights
        if pairs:
            change = np.bincount(a_rows, weights=weights[a_cols], minlength=len(pairs)) - np.bincount(b_rows, weights=weights[b_cols], minlength=len(pairs))
            change *= 2 * fairness / len(pairs)
            grad += np.bincount(a_cols, weights=change[a_rows], minlength=width) - np.bincount(b_cols, weights=change[b_rows], minlength=width)
        full = np.append(grad, wrong.sum())
        mean = 0.9 * mean + 0.1 * full
        square = 0.999 * square + 0.001 * full**2
        move = 0.05 * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
        weights, bias = weights - move[:-1], bias - float(move[-1])
    return weights, bias


def train(
    docs: DataFrame, labels: DataFrame, max_rows: int = 30_000, n_features: int = 2_048, min_count: int = 5, ridge: float = 1e-4, fairness: float = 1.0, steps: int = 400
) -> Model:
    """Fit on at most about `max_rows` labelled rows (an even hash sample of the ids that may be learned from).

    An id with several labels is toxic if one says so; null labels and ids are ignored.
    Only the chosen features, `n_features` at most, and the sampled rows' indices into
    them come to the driver.  Without labels of both kinds the model is the label's mean.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & train_part()).groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("long").alias("label"))
    total = known.count()
    sample = known.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(max(total, 1))) < max_rows)
    # The sample's bound is `max_rows` ids and labels, so it may be broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select("text", "label")
    sizes = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    n, ones = int(sizes[0]), int(sizes[1])
    empty = np.zeros(0, np.uint64)
    if not ones or ones == n:
        share = (ones + 1) / (n + 2)
        return Model(empty, np.zeros(0), float(np.log(share / (1 - share))))
    counts = rows.mapInArrow(releasing(_label_counts), "feature long, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # How far a feature's share of toxic rows is from the sample's, in standard deviations.
    share = ones / n
    seen = F.col("toxic") + F.col("clean")
    telling = F.abs(F.col("toxic") - seen * share) / F.sqrt(seen * share * (1 - share))
    chosen = counts.where(seen >= min_count).orderBy(F.desc(telling), "feature").limit(n_features).select("feature").collect()
    terms = np.concatenate([x for terms in IDENTITY_TERMS for x in _of_terms(list(terms))])
    keys = np.unique(np.concatenate([np.array([r[0] for r in chosen], np.int64).view(np.uint64), terms]))
    examples = sorted(tuple(r) for r in rows.mapInArrow(_examples(keys), "label long, own array<int>, swapped array<array<int>>").collect())
    weights, bias = fit(np.array([e[0] for e in examples], float), [e[1] for e in examples], [e[2] for e in examples], len(keys), ridge, fairness, steps)
    return Model(keys, weights, bias)


def score(docs: DataFrame, model: Model, column: str = "text", name: str = "score") -> DataFrame:
    """Docs with the model's score (0 to 1) of each whole text; null and empty texts have the bias's score.

    A column called like `name` is replaced; other columns and repeated rows stay.
    """
    from pyspark.sql import types as T

    kept = [c for c in docs.columns if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.scores(words, hi - lo) for lo, hi, words in words_of(batch.column(column), NOT_LETTER)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(np.concatenate(found) if found else np.zeros(0))], names=[*kept, name])

    return docs.mapInArrow(releasing(run), T.StructType([docs.schema[c] for c in kept] + [T.StructField(name, T.DoubleType())]))


def toxicity_query(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(documents.select("doc_id", "text"), train(documents, labels)).select("doc_id", "score")
    return scored.select("doc_id", (~train_part()).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
