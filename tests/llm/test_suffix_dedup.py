import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import prose
from tilewright.llm import suffix_dedup as D
from tilewright.llm.suffix_arrays import common_prefixes, suffix_arrays


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=60), min_size=1, max_size=6))
def test_suffix_arrays(shards):
    n = max(map(len, shards)) + 1
    text, length = np.zeros((n, len(shards)), np.int64), np.array([len(s) + 1 for s in shards])
    for b, s in enumerate(shards):
        text[: len(s), b] = s
    array = suffix_arrays(text, length)
    prefix = common_prefixes(text, length, array)
    for b, s in enumerate(shards):
        s = [*s, 0]
        order = sorted(range(len(s)), key=lambda i: s[i:])
        assert array[: len(s), b].tolist() == order
        for i in range(1, len(s)):
            x, y = s[order[i] :], s[order[i - 1] :]
            common = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
            assert prefix[order[i], b] == common


def brute(rows):
    out, seen = [], {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            s = b[k : k + 50]
            seen[s] = min(seen.get(s, D.NO_ID), D.NO_ID if i is None else i)
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if seen[b[k : k + 50]] < (D.NO_ID if i is None else i):
                gone[k : k + 50] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(map(repr, out))


def found(df):
    return sorted(map(repr, map(tuple, D.suffix_dedup(df).collect())))


def test_odd_rows(odd):
    assert found(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_empty(empty):
    assert D.suffix_dedup(empty).count() == 0


@pytest.fixture(scope="module")
def corpus():
    """Passages of 45 to 400 bytes in many documents, runs of one letter, near copies, and text of three letters."""
    r, rows = random.Random(5), []
    passages = [prose(100 + k, 60)[:n] for k, n in enumerate((45, 49, 50, 51, 80, 120, 400))]
    for i in range(150):
        parts = [prose(1000 + i, r.randrange(3, 30))]
        for p in passages:
            if r.random() < 0.4:
                a = r.randrange(0, 5)
                parts.insert(r.randrange(len(parts) + 1), p[a:])
        if i % 10 == 0:
            parts.append("z" * r.randrange(40, 140))
        if i % 7 == 0:
            parts.append("".join(r.choice("abc") for _ in range(300)) + "".join(r.choice("ab") for _ in range(200)))
        rows.append((i, " ".join(parts)))
    base = prose(9, 80)
    rows += [(500 + k, base[: k * 7] + chr(65 + k) + base[k * 7 :]) for k in range(40)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("shard", "common", "hot"), [(1 << 13, 64, 1024), (200, 3, 3), (1 << 13, 1 << 30, 2)])
def test_passages(spark, corpus, monkeypatch, shard, common, hot):
    """Small bounds part shards by longer cores and hot anchors by their places."""
    monkeypatch.setattr(D, "SHARD", shard)
    monkeypatch.setattr(D, "COMMON", common)
    monkeypatch.setattr(D, "HOT", hot)
    assert found(spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)) == brute(corpus)


def segments_of(texts):
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    place, _, start, last = D.anchors(data, at)
    doc = np.searchsorted(at, place, side="right") - 1
    stop = last + D.LENGTH
    cut = [data[a:b].tobytes() for a, b in zip(start, stop, strict=True)]
    return np.frombuffer(b"".join(cut), np.uint8), np.concatenate([[0], np.cumsum([len(c) for c in cut])]), place - start, doc


@pytest.mark.parametrize("shard", [100, 1 << 13])
def test_arrays_settle_every_shared_string(corpus, monkeypatch, shard):
    monkeypatch.setattr(D, "SHARD", shard)
    data, at, lead, ids = segments_of([t.encode() for _, t in corpus])
    told = {}
    least, offset = D.shared_strings(data, at, lead, ids, told)
    strings = [(s, data[at[s] + k : at[s] + k + 50].tobytes()) for s in range(len(ids)) for k in range(max(0, at[s + 1] - at[s] - 49))]
    times, first = {}, {}
    for s, x in strings:
        times[x] = times.get(x, 0) + 1
        first[x] = min(first.get(x, 1 << 60), int(ids[s]))
    assert least.tolist() == [first[x] for _, x in strings] and offset[-1] == len(strings)
    assert told == {"alone": sum(times[x] == 1 for _, x in strings), "arrays": sum(times[x] > 1 for _, x in strings)}


def test_hot_texts(spark, odd, monkeypatch):
    from tilewright.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 2)
    assert found(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
