"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's UTF-8 bytes in windows, forwards and backwards; at every byte both
states together give a probability for each language, and a document's probabilities are
their means over all its bytes. It is trained in numpy by backpropagation through time on a
bounded sample of distinct labelled texts, for each language those of least hash.

Edge cases: null texts and texts without a letter are und with score 0; rows with a null lang
or an excluded doc_id don't train; a null doc_id isn't held out and doesn't train; without
training rows every text is und; repeated rows get the same answer; an empty table gives an
empty result; texts of any length are read whole; only doc_id, text and lang are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import blocks, distinct_sample, ranges, small_batches, text_of, utf8

#: Bytes of a window at prediction, and in training.
WINDOW, TRAIN_WINDOW = 256, 96
#: Size of a state, steps of training, windows of a step, windows that a sampled document gives.
HIDDEN, STEPS, STEP_WINDOWS, WINDOWS_PER_DOC = 8, 260, 192, 6
#: Bound of the training sample, in distinct texts, shared by the languages.
SAMPLE = 4000
RATE = 0.02


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


class ByteGRU:
    """Two GRU directions over bytes (256 pads) and a softmax at every position."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p[f"x{d}"] = rng.normal(0, 0.3, (257, 3 * hidden)).astype(np.float32)
            self.p[f"u{d}"] = rng.normal(0, 0.7 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)
            self.p[f"o{d}"] = rng.normal(0, 0.3, (hidden, len(languages))).astype(np.float32)
        self.p["bias"] = np.zeros(len(languages), np.float32)

    def states(self, d: str, windows: np.ndarray, saved: list | None = None) -> np.ndarray:
        """All states [time, window, hidden] of a direction; saved gets what training needs."""
        k, x, u = self.hidden, self.p[f"x{d}"], self.p[f"u{d}"]
        steps = range(windows.shape[0]) if d == "f" else range(windows.shape[0] - 1, -1, -1)
        out = np.empty((*windows.shape, k), np.float32)
        h = np.zeros((windows.shape[1], k), np.float32)
        padded = windows == 256
        any_pad = padded.any(axis=1)
        for t in steps:
            a = x[windows[t]]
            b = h @ u
            gates = sigmoid(a[:, : 2 * k] + b[:, : 2 * k])
            z, r = gates[:, :k], gates[:, k:]
            n = np.tanh(a[:, 2 * k :] + r * b[:, 2 * k :])
            if saved is not None:
                saved.append((t, h, z, r, n, b[:, 2 * k :]))
            h = n + z * (h - n)
            if any_pad[t]:
                h[padded[t]] = 0
            out[t] = h
        return out

    def probabilities(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        score = forward @ self.p["of"] + backward @ self.p["ob"] + self.p["bias"]
        score -= score.max(axis=-1, keepdims=True)
        np.exp(score, out=score)
        return score / score.sum(axis=-1, keepdims=True)

    def gradients(self, windows: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions and its gradient, by backpropagation through time."""
        k, saved = self.hidden, {"f": [], "b": []}
        h = {d: self.states(d, windows, saved[d]) for d in "fb"}
        prob = self.probabilities(h["f"], h["b"])
        real = (windows != 256).astype(np.float32)[..., None]
        total = real.sum()
        target = np.eye(len(self.languages), dtype=np.float32)[label][None]
        loss = float(-(real * target * np.log(prob + 1e-9)).sum() / total)
        delta = (prob - target) * real / total
        g = {name: np.zeros_like(v) for name, v in self.p.items()}
        flat = delta.reshape(-1, delta.shape[-1])
        g["bias"] = flat.sum(axis=0)
        for d in "fb":
            g[f"o{d}"] = h[d].reshape(-1, k).T @ flat
            from_above = delta @ self.p[f"o{d}"].T
            u, dh = self.p[f"u{d}"], np.zeros((windows.shape[1], k), np.float32)
            for t, before, z, r, n, b in reversed(saved[d]):
                dh = dh + from_above[t]
                dh[windows[t] == 256] = 0
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (before - n) * z * (1 - z)
                dr = dn * b * r * (1 - r)
                da = np.concatenate([dz, dr, dn], axis=1)
                db = np.concatenate([dz, dr, dn * r], axis=1)
                np.add.at(g[f"x{d}"], windows[t], da)
                g[f"u{d}"] += before.T @ db
                dh = dh * z + db @ u.T
        return loss, g

    def train(self, windows: np.ndarray, label: np.ndarray, steps: int = STEPS, seed: int = 2) -> list[float]:
        """Adam over random windows; each language is drawn as often as the others."""
        rng = np.random.default_rng(seed)
        of = [np.flatnonzero(label == c) for c in range(len(self.languages))]
        of = [o for o in of if len(o)]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses = []
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(o, -(-STEP_WINDOWS // len(of))) for o in of])
            loss, g = self.gradients(windows[pick].T.copy(), label[pick])
            losses.append(loss)
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            rate = RATE * min(1.0, 2.5 * (1 - step / (steps + 1)))
            for k, v in g.items():
                v = v / max(1.0, norm)
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.99 * s[k] + 0.01 * v * v
                self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return losses

    def predict(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Mean probabilities of each text over all its bytes; zeros for an empty text."""
        sizes = np.diff(at)
        counts = -(-sizes // WINDOW)
        doc = np.repeat(np.arange(len(sizes)), counts)
        start = at[:-1][doc] + ranges(counts) * WINDOW
        length = np.minimum(WINDOW, at[1:][doc] - start)
        order = np.argsort(-length, kind="stable")  # windows with padding come together
        out = np.zeros((len(sizes), len(self.languages)))
        padded = np.append(data.astype(np.int16), np.full(WINDOW, 256, np.int16))
        for i in range(0, len(order), 2048):
            some = order[i : i + 2048]
            longest = int(length[some[0]])
            span = np.arange(longest)[:, None]
            windows = padded[start[some][None] + span]
            windows[span >= length[some][None]] = 256
            windows = windows.astype(np.int64)
            forward = self.states("f", windows)
            backward = self.states("b", windows)
            real = windows != 256
            total = np.zeros((len(some), len(self.languages)), np.float32)
            for t in range(longest):
                prob = self.probabilities(forward[t], backward[t])
                total += prob if real[t].all() else prob * real[t][:, None]
            np.add.at(out, doc[some], total)
        return out / np.maximum(sizes, 1)[:, None]


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _windows(per_doc: int):
    def run(batches):
        for batch in batches:
            rows = []
            for code, key, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = body.encode()
                n = -(-len(raw) // TRAIN_WINDOW)
                step = max(1, n // per_doc)
                rows += [(code, key, i, raw[i * TRAIN_WINDOW : (i + 1) * TRAIN_WINDOW]) for i in range(0, n, step)][:per_doc]
            kinds = (("lang", pa.string()), ("hash", pa.int64()), ("nth", pa.int64()), ("window", pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], names=[n for n, _ in kinds])

    return run


def fit(labelled: DataFrame, sample: int = SAMPLE) -> ByteGRU | None:
    """A network from labelled(lang, text): at most sample distinct texts (20 for each language at least), a like number for each language."""
    languages = sorted(r["lang"] for r in labelled.select("lang").distinct().collect())  # one row for each language
    if not languages:
        return None
    chosen = distinct_sample(labelled.select(F.col("lang").alias("part"), "text"), max(20, sample // len(languages)))
    windows = chosen.select("part", "hash", "text").mapInArrow(_windows(WINDOWS_PER_DOC), "lang string, hash long, nth long, window binary")
    rows = windows.toArrow().sort_by([(c, "ascending") for c in ("hash", "lang", "nth")])
    raw = rows.column("window").to_pylist()
    windows = np.full((len(raw), TRAIN_WINDOW), 256, np.int64)
    for row, body in zip(windows, raw, strict=True):
        row[: len(body)] = np.frombuffer(body, np.uint8)
    label = np.array([languages.index(x) for x in rows.column("lang").to_pylist()], np.int64)
    model = ByteGRU(languages)
    if len(raw):
        model.train(windows, label)
    return model


def _predict(languages: list[str], p: dict[str, np.ndarray]):
    def run(batches):
        model = ByteGRU(languages)
        model.p = p
        for batch in batches:
            for part in blocks(batch, "text"):
                letters = part.column(3).to_numpy(zero_copy_only=False).astype(bool)
                prob = model.predict(*utf8(part.column(2)))
                best = prob.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]),
                        pa.array(np.where(letters, np.clip(prob[np.arange(len(best)), best], 0, 1), 0.0)),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return run


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of docs(doc_id, text, lang)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_of().alias("text"), "lang")
    model = fit(rows.where("not held_out and doc_id is not null and lang is not null and text <> ''"), sample)
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = rows.select("doc_id", "held_out", "text", F.col("text").rlike(r"\p{L}").alias("letters"))
    return rows.mapInArrow(_predict(model.languages, model.p), "doc_id long, held_out boolean, lang_pred string, score double")
