"""Toxicity by cumulative-link ordinal regression on sparse text features.

A document's features are its words and the beginnings of its words, by 64-bit hash. The
severity grades 0..3 have the probabilities P(grade >= k) = sigmoid(w x - t_k) with one
weight vector for all ordered thresholds t_1 < t_2 < t_3; the expected severity is their sum.

The model is fitted on a bounded sample of labelled documents, half of them toxic if there
are enough, weighted back to the share that they have in the labels. How many documents of
either kind hold a feature is counted by Spark; only the features that are selected by these
counts reach the driver. Where the labels only say toxic or not, the toxic documents of each
half of the sample are graded by thirds of the score that a model of the other half, with
features selected on that other half, gives them. Values are log(1 + occurrences), kept sparse.

Edge cases: null, empty and all-space texts have severity 0; of several labels of a doc_id or
of one text the greatest counts; rows of labels without a document, with a null doc_id or
label don't train; without both kinds of labels every severity is 0; repeated rows get the same
answer; texts of any length are read whole; an empty table gives an empty result; only doc_id
and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import blocks, drop, keep, small_batches, text_of, utf8
from tilewright.llm.word_features import Words

PREFIXES = (4, 5, 6)
#: Bound of the training sample in documents, and of the selected features.
SAMPLE, FEATURES = 6000, 2048
#: Least likelihood ratio (G), log odds ratio and share of toxic documents of a selected feature.
LEAST_G, LEAST_ODDS, LEAST_PRECISION = 20.0, 2.5, 0.8


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) for each occurrence."""
    kinds = [words.hashes, *(words.prefixes(k) for k in PREFIXES)]
    text, hashes = np.tile(words.text, len(kinds)), np.concatenate(kinds)
    return text[hashes != 0], hashes[hashes != 0]


def _counted(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, occurrences), sorted, each feature of a text once."""
    text, hashes = features(words)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    at = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1]))) if len(text) else np.zeros(0, np.int64)
    return text[at], hashes[at], np.diff(np.append(at, len(text)))


def _terms(batches):
    """(feature, kind) for each document of kind (fold * 2 + toxic) and feature of it."""
    for batch in batches:
        for part in blocks(batch, "text"):
            text, hashes, _ = _counted(Words(*utf8(part.column(1))))
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(part.column(0).to_numpy()[text])], names=["feature", "kind"])


def _vectors(hashes: np.ndarray):
    """(grade, fold, place, value) of each document: the selected features that it holds."""

    def run(batches):
        for batch in batches:
            for part in blocks(batch, "text"):
                text, found, counts = _counted(Words(*utf8(part.column(3))))
                at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
                hit = np.flatnonzero(hashes[at] == found)
                edges = np.searchsorted(text[hit], np.arange(part.num_rows + 1))
                place, value = at[hit].astype(np.int32), np.log1p(counts[hit])
                cells = [(place[a:b].tobytes(), value[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([c[0] for c in cells], pa.binary()), pa.array([c[1] for c in cells], pa.binary())], names=["grade", "fold", "hash", "place", "value"]
                )

    return run


class Sparse:
    """A matrix by its entries."""

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, shape: tuple[int, int]):
        self.row, self.column, self.value, self.shape = row, column, value, shape

    @classmethod
    def of(cls, x) -> Sparse:
        if isinstance(x, Sparse):
            return x
        row, column = np.nonzero(x)
        return cls(row, column, x[row, column], x.shape)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * w[self.column], minlength=self.shape[0])

    def across(self, v: np.ndarray) -> np.ndarray:
        """The transposed matrix times v."""
        return np.bincount(self.column, weights=self.value * v[self.row], minlength=self.shape[1])

    def part(self, rows: np.ndarray, columns: np.ndarray) -> Sparse:
        """The chosen rows and columns (flags)."""
        some = rows[self.row] & columns[self.column]
        return Sparse((np.cumsum(rows) - 1)[self.row[some]], (np.cumsum(columns) - 1)[self.column[some]], self.value[some], (int(rows.sum()), int(columns.sum())))


def fit_ordinal(x: np.ndarray | Sparse, grade: np.ndarray, weight: np.ndarray, steps: int = 600, rate: float = 0.05, decay: float = 1e-5):
    """Shared weights and ordered thresholds of the cumulative logits, by Adam on the likelihood."""
    top, x = int(grade.max()), Sparse.of(x)
    w, first, gaps = np.zeros(x.shape[1]), 1.0, np.zeros(max(top - 1, 0))
    m = s = np.zeros(len(w) + 1 + len(gaps))
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    weight = weight / weight.sum()
    rows = np.arange(len(grade))
    for step in range(1, steps + 1):
        t = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        above = sigmoid(x.dot(w)[:, None] - t[None])  # P(grade >= k), k = 1..top
        bound = np.concatenate([np.ones((len(grade), 1)), above, np.zeros((len(grade), 1))], axis=1)
        p = np.maximum(bound[rows, grade] - bound[rows, grade + 1], 1e-9)
        slope = bound * (1 - bound)
        upper, lower = slope[rows, grade] / p * weight, slope[rows, grade + 1] / p * weight
        dw = -x.across(upper - lower) + decay * w
        dt = np.zeros(top + 2)
        np.add.at(dt, grade, upper)
        np.add.at(dt, grade + 1, -lower)
        dt = dt[1 : top + 1]
        tail = np.cumsum(dt[::-1])[::-1]
        g = np.concatenate([dw, [tail[0]], tail[1:] * np.exp(gaps)])
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        w, first, gaps = w - move[: len(w)], first - move[len(w)], gaps - move[len(w) + 1 :]
    return w, first + np.concatenate([[0], np.cumsum(np.exp(gaps))])


def select(terms: DataFrame, sizes: np.ndarray, folds: tuple[int, ...]) -> np.ndarray:
    """The hashes of the features that tell the toxic documents of these folds, sorted.

    terms(feature, k0, k1, k2, k3) has the documents of each kind that hold a feature, sizes all
    documents of each kind.
    """
    n_no, n_yes = (float(sum(sizes[2 * f + k] for f in folds)) for k in range(2))
    no, yes = (sum((F.col(f"k{2 * f + k}") for f in folds), F.lit(0)).cast("double") for k in range(2))
    held = terms.select("feature", yes.alias("yes"), no.alias("no")).where("yes > 0")
    odds = F.log((F.col("yes") + 0.5) / (n_yes + 1)) - F.log((F.col("no") + 0.5) / (n_no + 1))
    share, seen = n_yes / (n_yes + n_no), F.col("yes") + F.col("no")
    gain = F.col("yes") * F.log(F.col("yes") / (seen * share)) + F.when(F.col("no") > 0, F.col("no") * F.log(F.col("no") / (seen * (1 - share)))).otherwise(0.0)
    told = held.where((2 * gain >= LEAST_G) & (odds >= LEAST_ODDS) & (F.col("yes") >= LEAST_PRECISION * seen))
    found = told.orderBy(F.desc(F.round(gain, 6)), "feature").limit(FEATURES).select("feature").collect()  # FEATURES rows at most
    return np.sort(np.array([r["feature"] for r in found], np.int64).view(np.uint64))


def out_of_fold(x: Sparse, toxic: np.ndarray, fold: np.ndarray, weight: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """Grades 0, 1.. of the documents: toxic ones by thirds of the score by a model of the other fold, whose features are columns[of the scored fold]."""
    grade = np.zeros(len(toxic), np.int64)
    for f in range(2):
        mine, other = fold == f, fold != f
        if not (toxic & mine).any():
            continue
        score = np.zeros(len(toxic))
        if (toxic & other).any() and (~toxic & other).any() and columns[f].any():
            w, _ = fit_ordinal(x.part(other, columns[f]), toxic[other].astype(np.int64), weight[other])
            score[mine] = x.part(mine, columns[f]).dot(w)
        cuts = np.quantile(score[toxic & mine], [1 / 3, 2 / 3])
        grade[toxic & mine] = 1 + np.searchsorted(cuts, score[toxic & mine], side="left")
    return np.unique(grade, return_inverse=True)[1] if not toxic.all() else grade


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """(hashes, weights, thresholds) from docs(doc_id, text) and labels(doc_id, toxic); None without both kinds."""
    labels = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(F.max(F.col("toxic").cast("int")).alias("grade"))
    labels = keep(labels, "labels")
    counts = {r["toxic"]: r["n"] for r in labels.groupBy((F.col("grade") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    # those of least hash: sample rows at most, whatever the size of the tables
    yes, no = (labels.where(c).orderBy(F.xxhash64("l_id"), "l_id").limit(sample // 2) for c in ("grade > 0", "grade <= 0"))
    chosen = F.broadcast(yes.union(no))
    found = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text")).join(chosen, F.col("id") == F.col("l_id"))
    # one text for each doc_id; copies of one text would make all its words look telling
    found = found.groupBy("l_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "grade")).alias("one"))
    found = found.groupBy("one.text").agg(F.greatest(F.max("one.grade"), F.lit(0)).alias("grade"))
    found = keep(found.select("grade", F.pmod(F.xxhash64("text", F.lit(7)), F.lit(2)).cast("int").alias("fold"), F.xxhash64("text").alias("hash"), "text"), "sample")
    drop(labels)
    kind = F.col("fold") * 2 + (F.col("grade") > 0).cast("int")
    sizes = np.zeros(4, np.int64)
    for r in found.groupBy(kind.alias("kind")).agg(F.count("*").alias("n")).collect():
        sizes[r["kind"]] = r["n"]
    if not sizes[[1, 3]].sum() or not sizes[[0, 2]].sum():
        return None
    terms = found.select(kind.alias("kind"), "text").mapInArrow(_terms, "feature long, kind int")
    terms = keep(terms.groupBy("feature").agg(*(F.count_if(F.col("kind") == k).alias(f"k{k}") for k in range(4))), "terms")
    hashes = select(terms, sizes, (0, 1))
    if not len(hashes):
        return None
    graded = found.agg(F.max("grade")).first()[0] > 1
    others = [] if graded else [select(terms, sizes, (1 - f,)) for f in range(2)]
    drop(terms)
    every = np.unique(np.concatenate([hashes, *others]))
    # sample rows at most, each with the selected features that it holds
    table = found.mapInArrow(_vectors(every), "grade int, fold int, hash long, place binary, value binary").toArrow().sort_by([("hash", "ascending"), ("grade", "ascending")])
    drop(found)
    grade, fold = (np.array(table.column(c).to_pylist(), np.int64) for c in ("grade", "fold"))
    column, value = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("place", np.int32), ("value", np.float64)))
    row = np.repeat(np.arange(len(grade)), [len(p) // 4 for p in table.column("place").to_pylist()])
    x = Sparse(row, column, value, (len(grade), len(every)))
    toxic = grade > 0
    weight = np.where(toxic, counts[True] / toxic.sum(), counts[False] / (~toxic).sum())
    if not graded:
        grade = out_of_fold(x, toxic, fold, weight, [np.isin(every, o) for o in others])
    w, t = fit_ordinal(x.part(np.ones(len(grade), bool), np.isin(every, hashes)), grade, weight)
    return hashes, w, t


def _graded(model):
    def run(batches):
        for batch in batches:
            for part in blocks(batch, "text"):
                n = part.num_rows
                if model is None:
                    above = np.zeros((n, 1))
                else:
                    hashes, w, t = model
                    words = Words(*utf8(part.column(1)))
                    text, found = features(words)
                    at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
                    hit = np.flatnonzero(hashes[at] == found)
                    # only the selected features are counted
                    cell, counts = np.unique(text[hit] * len(hashes) + at[hit], return_counts=True)
                    eta = np.bincount(cell // len(hashes), weights=np.log1p(counts) * w[cell % len(hashes)], minlength=n)
                    above = 1 / (1 + np.exp(-np.clip(eta[:, None] - t[None], -50, 50)))
                    above[words.counts == 0] = 0
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array((above >= 0.5).sum(axis=1).astype(np.int32)), pa.array(above[:, 0] >= 0.5)],
                    names=["doc_id", "severity", "p_toxic", "grade", "toxic"],
                )

    return run


def grade(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, severity (expected), p_toxic, grade, toxic for each row of docs(doc_id, text)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_graded(fit(docs, labels, sample)), "doc_id long, severity double, p_toxic double, grade int, toxic boolean")
