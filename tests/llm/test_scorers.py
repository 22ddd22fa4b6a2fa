"""The scores of the registered learned queries against plain Python, from the fitted models."""

import math

import numpy as np
import pytest

from tests.llm.conftest import prose
from tilewright.llm import language as L
from tilewright.llm import quality as Q
from tilewright.llm import queries
from tilewright.llm import toxicity as T
from tilewright.llm.word_features import Words

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1
SPACES = " \t\n\v\f\r"


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


BYTE = [mix(i * 0x9E3779B97F4A7C15 & MASK) for i in range(1, 257)]
PLACE = [mix(i * 0xD1B54A32D192ED03 & MASK) | 1 for i in range(1, 4097)]
NTH = [mix(i * 0x8CB92BA72F3D8DD7 & MASK) | 1 for i in range(1, 65)]


def words_of(text):
    out, now = [], ""
    for c in (text or "") + " ":
        if c in SPACES:
            out += [now.encode()] if now else []
            now = ""
        else:
            now += c
    return out


def lower(word):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in word)


def word_hash(word):
    value = sum((BYTE[b] ^ (mix(i >> 12) if len(word) > 4096 else 0)) * PLACE[i & 4095] for i, b in enumerate(lower(word)))
    return mix((value + len(word)) & MASK)


def beginning(word, size):
    return mix((sum(BYTE[b] * PLACE[i] for i, b in enumerate(lower(word)[:size])) + size & MASK) ^ 0x632BE59BD9B4E019)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def logistic(z):
    return 1 / (1 + math.exp(-max(-50, min(50, z))))


def severity(text, model):
    words = words_of(text)
    if not words:
        return [0.0] * len(model[2])
    counts = {}
    for w in words:
        for f in [word_hash(w)] + [beginning(w, k) for k in T.PREFIXES if len(w) > k]:
            counts[f] = counts.get(f, 0) + 1
    eta = sum(math.log1p(counts.get(int(h), 0)) * w for h, w in zip(model[0], model[1], strict=True))
    return [logistic(eta - t) for t in model[2]]


def test_toxicity(spark, docs):
    model = T.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    found = {r.doc_id: r for r in queries.op1_toxicity(spark, SF).collect()}
    for r in docs.collect():
        above, got = severity(r.text, model), found.pop(r.doc_id)
        assert got.severity == pytest.approx(sum(above), abs=1e-9) and got.p_toxic == pytest.approx(above[0], abs=1e-9)
        assert got.grade == sum(a >= 0.5 for a in above) and got.toxic == (above[0] >= 0.5)
    assert not found


def test_toxicity_of_texts_without_words_and_very_long_ones(spark):
    docs = spark.createDataFrame([(i, f"calm words {i} here " + ("vile " * (1 + i % 5) if i % 2 else "")) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(0, 0), (1, 0)], "doc_id long, toxic int")
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "vile " * 70_000), (5, "calm words")]
    model = T.fit(docs, labels)
    asked = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in asked.mapInArrow(T._graded(model), "doc_id long, severity double, p_toxic double, grade int, toxic boolean").collect()}
    for i, text in rows:
        assert found[i].severity == pytest.approx(sum(severity(text, model)), abs=1e-9)
    assert found[1].severity == found[2].severity == found[3].severity == 0 and found[4].toxic and not found[5].toxic


def test_toxicity_does_not_depend_on_the_layout(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    a, b = T.fit(docs, labels), T.fit(docs.repartition(7, "text"), labels.unionAll(labels).repartition(5))
    assert all(np.array_equal(x, y) for x, y in zip(a, b, strict=True))


def kind_of(char):
    c = ord(char)
    if c >= 128:
        return 1 if c < 1 << 11 and char.isupper() else 2
    return 1 if 65 <= c <= 90 else 2 if 97 <= c <= 122 else 3 if 48 <= c <= 57 else c


def shape(word):
    runs = []
    for c in word.decode():
        for _ in c.encode():
            if not runs or runs[-1] != kind_of(c):
                runs.append(kind_of(c))
    return mix(sum(BYTE[k] * NTH[min(i, 62)] for i, k in enumerate(runs)) & MASK)


def quality_score(text, model):
    words = words_of(text)
    if not words:
        return 0.0
    x, before = {}, None
    for w in words:
        same = word_hash(w) == before
        before = word_hash(w)
        for f in (shape(w), mix(w[-1] + (1 << 20)), mix(same + (1 << 21))):
            x[f % Q.BUCKETS] = x.get(f % Q.BUCKETS, 0) + 1
    return logistic(sum(model[0][k] * v / (len(words) + Q.PRIOR_WORDS) for k, v in x.items()) + model[1])


def test_quality(spark, docs):
    model = Q.fit(docs)
    found = {r.doc_id: r for r in queries.op7_quality(spark, SF).collect()}
    for r in docs.collect():
        score, got = quality_score(r.text, model), found.pop(r.doc_id)
        assert got.score == pytest.approx(score, abs=1e-5) and got.kept == (got.score >= Q.REJECT_BELOW)
    assert not found


@pytest.mark.parametrize("text", ["Съешь ещё этих мягких французских булок, да выпей чаю, говорил он. " * 3, "Ταχίστη αλώπηξ βαφής ψημένη γη, δρασκελίζει υπέρ νωθρού κυνός εκεί. " * 3])
def test_votes_of_other_scripts(text):
    """Word lengths count code points, so prose in other alphabets isn't too long; its capitals are capitals."""
    raw = np.frombuffer(text.encode(), np.uint8)
    votes = dict(zip(Q.LABELLERS, Q.votes(Words(raw, np.array([0, len(raw)])))[0].tolist(), strict=True))
    assert votes["word length"] != 0 and votes["capitals"] == 1
    raw = np.frombuffer(text.upper().encode(), np.uint8)
    votes = dict(zip(Q.LABELLERS, Q.votes(Words(raw, np.array([0, len(raw)])))[0].tolist(), strict=True))
    assert votes["capitals"] == 0


def gru(p, d, k, raw):
    """All states of a direction, a number at a time."""
    out, h = [None] * len(raw), [0.0] * k
    for t in range(len(raw)) if d == "f" else range(len(raw) - 1, -1, -1):
        a = [float(v) for v in p[f"x{d}"][raw[t]]]
        b = [sum(h[i] * float(p[f"u{d}"][i, j]) for i in range(k)) for j in range(3 * k)]
        z = [logistic(a[j] + b[j]) for j in range(k)]
        r = [logistic(a[k + j] + b[k + j]) for j in range(k)]
        n = [math.tanh(a[2 * k + j] + r[j] * b[2 * k + j]) for j in range(k)]
        h = [n[j] + z[j] * (h[j] - n[j]) for j in range(k)]
        out[t] = h
    return out


def test_language(spark, docs):
    """Documents of up to two windows, and one with a long text, byte by byte."""
    rows = docs.select("doc_id", L.held_out().alias("held_out"), "text", "lang")
    model = L.fit(rows.where("not held_out and doc_id is not null and lang is not null and text <> ''"))
    found = {r.doc_id: r for r in queries.op9_language_id(spark, SF).collect()}
    texts = sorted((r for r in docs.collect() if r.text), key=lambda r: len(r.text))
    k = model.hidden
    for r in texts[5:40:5]:
        raw, total = r.text.encode(), [0.0] * len(model.languages)
        for i in range(0, len(raw), L.WINDOW):
            part = raw[i : i + L.WINDOW]
            for f, b in zip(gru(model.p, "f", k, part), gru(model.p, "b", k, part), strict=True):
                s = [sum(f[j] * float(model.p["of"][j, c]) + b[j] * float(model.p["ob"][j, c]) for j in range(k)) + float(model.p["bias"][c]) for c in range(len(total))]
                e = [math.exp(v - max(s)) for v in s]
                total = [t + v / sum(e) for t, v in zip(total, e, strict=True)]
        mean, got = [t / len(raw) for t in total], found[r.doc_id]
        if got.lang_pred != "und":
            assert got.score == pytest.approx(max(mean), abs=2e-3)
            assert mean[model.languages.index(got.lang_pred)] == pytest.approx(max(mean), abs=4e-3)


def test_learning_does_not_depend_on_the_layout(spark, docs):
    other = docs.repartition(7, "text")
    a, b = Q.fit(docs), Q.fit(other)
    assert np.allclose(a[0], b[0], atol=1e-6) and a[1] == pytest.approx(b[1])
    one, two = (L.fit(d.where("lang is not null and text <> ''").select("lang", "text"), 80) for d in (docs, other))
    assert all(np.array_equal(one.p[k], two.p[k]) for k in one.p)


def test_samples_keep_their_bounds(spark, monkeypatch):
    """Where half of the rows are one text the driver gets no more rows than the bound."""
    hot = prose(1, 80)
    docs = spark.createDataFrame([(i, hot if i % 2 else prose(i, 40), "en" if i % 3 else "de") for i in range(3000)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 2 and i % 5 == 0)) for i in range(3000)], "doc_id long, toxic int")
    from pyspark.sql.classic.dataframe import DataFrame

    real, seen = DataFrame.toArrow, []
    monkeypatch.setattr(DataFrame, "toArrow", lambda df: seen.append(real(df)) or seen[-1])
    Q.fit(docs, 100)
    T.fit(docs, labels, 100)
    L.fit(docs.select("lang", "text"), 60)
    assert seen and max(t.num_rows for t in seen) <= 60 * L.WINDOWS_PER_DOC and sorted(t.num_rows for t in seen)[0] <= 100
