"""Quality classifier: a weak-label model teaches a hashed linear scorer.

Eight heuristic labellers look at every document and vote good, bad or not at all. The
expectation-maximisation of a model in which each labeller has its own accuracies runs on the
counts of the vote patterns, at most 3**8 whatever the corpus holds, and gives each pattern's
posterior. The posteriors of a bounded sample of distinct texts, with the number of their rows
as weights, are the labels of a logistic scorer on hashed word shapes, word ends and repetitions,
which then scores every document. Lengths are in code points, and capitals are those of the Latin,
Greek, Cyrillic and Armenian scripts. Text without spaces has few words, so that most labellers
abstain and the score is that of a common document.

Edge cases: null, empty and all-space texts have no words, score 0 and are rejected; repeated
rows get the same answer; with fewer than two documents with words nothing is learned and all
of these are kept; an empty table gives an empty result; only doc_id and text are read (the
filter keeps all columns).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import SPACE, blocks, distinct_sample, mix64, small_batches, text_of, utf8
from tilewright.llm.word_features import Words

LABELLERS = ("adjacent repeats", "distinct words", "capitals", "symbols", "bars", "word length", "short words", "sentence marks")
#: Buckets of the scorer, and the bound of its sample in distinct texts.
BUCKETS, SAMPLE = 1024, 6000
#: So many words without features are added to each text, so that a few words are weak evidence.
PRIOR_WORDS = 10
#: Documents whose score is below are rejected.
REJECT_BELOW = 0.5
_PLAIN = np.zeros(256, bool)
_PLAIN[[ord(c) for c in ".,;:'\"-()?"]] = True


def votes(words: Words) -> np.ndarray:
    """A row for each text, a column for each labeller: 1 good, 0 bad, 2 abstains."""
    n, data = words.counts, words.data
    kind, lead = words.classes(), words.leads()
    # all in code points
    points = np.concatenate([[0], np.cumsum(lead)])
    size = points[words.end] - points[words.begin]
    upper = np.concatenate([[0], np.cumsum((kind == 1) & lead)])
    lower = np.concatenate([[0], np.cumsum((kind == 2) & lead)])
    symbol = np.concatenate([[0], np.cumsum((kind > 32) & ~_PLAIN[data])])
    spread = lambda c: c[words.end] - c[words.begin]
    letters = spread(upper) + spread(lower)
    total = np.maximum(np.bincount(words.text, weights=size, minlength=len(n)), 1)
    order = np.lexsort((words.hashes, words.text))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (words.hashes[order][1:] != words.hashes[order][:-1]) | (words.text[order][1:] != words.text[order][:-1])
    distinct = np.bincount(words.text[order], weights=fresh, minlength=len(n)) / np.maximum(n, 1)
    first, last = (data[words.begin], data[words.end - 1]) if len(size) else (np.zeros(0, np.uint8),) * 2
    measures = [
        # (measure, bad from / to, good below / above, least words): bad where it is high
        (words.mean(words.repeats()), 0.2, 0.05, 8),
        (-distinct, -0.25, -0.4, 25),
        (words.mean((spread(upper) >= 2) & (spread(upper) == letters)), 0.3, 0.08, 8),
        (np.bincount(words.text, weights=spread(symbol), minlength=len(n)) / total, 0.06, 0.02, 5),
        (words.mean((size == 1) & (first == ord("|"))), 0.15, 0.02, 8),
        (np.abs(words.mean(size) - 5.3), 1.6, 0.9, 15),
        (-words.mean((letters <= 3) & (letters > 0) & (size <= 5)), -0.02, -0.12, 25),
        (-words.mean((last == ord(".")) | (last == ord(","))), -0.01, -0.04, 25),
    ]
    out = np.full((len(n), len(measures)), 2, np.int64)
    for j, (value, bad, good, least) in enumerate(measures):
        enough = n >= least
        out[enough & (value >= bad), j] = 0
        out[enough & (value <= good), j] = 1
    return out


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of good for each vote pattern, and P(vote | class) by labeller, by EM."""
    m = patterns.shape[1]
    voted = (patterns != 2).sum(axis=1)
    # it starts from the share of bad votes: one bad vote in three makes a document bad
    start = np.where(voted > 0, 1 - np.minimum(1, 2.0 * (patterns == 0).sum(axis=1) / np.maximum(voted, 1)), 0.9)
    posterior = np.clip(start, 0.05, 0.95)
    table = np.zeros((2, m, 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - posterior), counts * posterior])
        prior = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
        for v in range(2):
            table[:, :, v] = weight @ (patterns == v) + 0.5
        # who abstains says nothing
        table[:, :, :2] /= table[:, :, :2].sum(axis=2, keepdims=True)
        table[:, :, 2] = 1
        log = np.log(prior)[:, None] + np.log(table[:, np.arange(m)[None], patterns]).sum(axis=2)
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(new - posterior).max() < 1e-6:
            break
        posterior = new
    return posterior, table


def vectors(words: Words) -> np.ndarray:
    """Shares of the words with each hashed feature, a row for each text; those of a few words are drawn to 0."""
    n = len(words.counts)
    out = np.zeros((n, BUCKETS), np.float32)
    if not len(words.begin):
        return out
    last = words.data[words.end - 1].astype(np.uint64)
    same = words.repeats()
    features = (words.shapes(), mix64(last + np.uint64(1 << 20)), mix64(same.astype(np.uint64) + np.uint64(1 << 21)))
    flat = np.zeros(n * BUCKETS)
    for f in features:
        flat += np.bincount(words.text * BUCKETS + (f % np.uint64(BUCKETS)).astype(np.int64), minlength=n * BUCKETS)
    return (flat.reshape(n, BUCKETS) / (words.counts + PRIOR_WORDS)[:, None]).astype(np.float32)


def fit_scorer(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 400, rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic weights for soft labels of rows with a weight, by Adam; the bias is the labels' log odds, so no evidence means the common answer."""
    weight = weight / weight.sum()
    share = float(np.clip(weight @ y, 0.6, 0.99))
    b = float(np.log(share / (1 - share)))
    w, m, s = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, steps + 1):
        g = x.T @ ((1 / (1 + np.exp(-np.clip(x @ w + b, -50, 50))) - y) * weight) + decay * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return w, b


def _patterns(batches):
    for batch in batches:
        for part in blocks(batch, "text"):
            words = Words(*utf8(part.column(0)))
            code = votes(words) @ (3 ** np.arange(len(LABELLERS)))
            yield pa.RecordBatch.from_arrays([pa.array(code[words.counts > 0])], names=["pattern"])


def _samples(batches):
    for batch in batches:
        for part in blocks(batch, "text"):
            words = Words(*utf8(part.column(2)))
            code = votes(words) @ (3 ** np.arange(len(LABELLERS)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(code), pa.array([v.tobytes() for v in vectors(words)], pa.binary())], names=["hash", "n", "pattern", "vector"])


def _scores(model):
    def run(batches):
        for batch in batches:
            for part in blocks(batch, "text"):
                index = part.schema.get_field_index("text")
                words = Words(*utf8(part.column(index)))
                score = np.ones(len(words.counts)) if model is None else 1 / (1 + np.exp(-np.clip(vectors(words) @ model[0] + model[1], -50, 50)))
                score[words.counts == 0] = 0
                columns = [c for i, c in enumerate(part.columns) if i != index]
                names = [n for n in part.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=[*names, "score"])

    return run


def fit(docs: DataFrame, sample: int = SAMPLE):
    """(weights, bias) learned from docs(text); None if there is nothing to learn from."""
    small_batches(docs.sparkSession)
    texts = docs.select(text_of().alias("text"))
    found = texts.mapInArrow(_patterns, "pattern long").groupBy("pattern").agg(F.count("*").alias("n")).collect()  # 3**8 rows at most
    total = sum(r["n"] for r in found)
    if total < 2:
        return None
    code = np.array([r["pattern"] for r in found])
    patterns = code[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    posterior = dict(zip(code.tolist(), label_model(patterns, np.array([r["n"] for r in found], float))[0].tolist(), strict=True))
    worded = texts.where(F.col("text").rlike(f"[^{SPACE}]")).select(F.lit("").alias("part"), "text")
    chosen = distinct_sample(worded, sample).select("hash", "n", "text")
    rows = chosen.mapInArrow(_samples, "hash long, n long, pattern long, vector binary").toArrow().sort_by("hash")
    x = np.frombuffer(b"".join(rows.column("vector").to_pylist()), np.float32).reshape(rows.num_rows, BUCKETS)
    return fit_scorer(x.astype(np.float64), np.array([posterior[p] for p in rows.column("pattern").to_pylist()]), rows.column("n").to_numpy().astype(np.float64))


def classify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, score (the probability of good) and kept for each row of docs(doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    scored = rows.mapInArrow(_scores(fit(docs, sample)), "doc_id long, score double")
    return scored.withColumn("kept", F.col("score") >= REJECT_BELOW)


def keep_good(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that classify() keeps, all columns as they are."""
    model = fit(docs, sample)

    def good(batches):
        score = _scores(model)
        for batch in batches:
            for part in blocks(batch, "_text_"):
                index = part.schema.get_field_index("_text_")
                found = next(score([pa.RecordBatch.from_arrays([part.column(index)], names=["text"])]), None) if part.num_rows else None
                values = [] if found is None else [found]
                kept = np.concatenate([v.column(0).to_numpy() for v in values]) >= REJECT_BELOW if values else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([c for i, c in enumerate(part.columns) if i != index], names=[n for n in part.schema.names if n != "_text_"]).filter(pa.array(kept))

    return docs.withColumn("_text_", text_of()).mapInArrow(good, docs.schema)
