import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tilewright.llm import exact_dedup as E


def body(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    """(doc_id, keep_id, group_size, kept, sha) with one row kept of each group."""
    groups = {}
    for i, t in rows:
        groups.setdefault(body(t), []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        first = min(known) if known else None
        for n, i in enumerate(sorted(ids, key=lambda i: (i is None, i or 0))):
            out.append((i, first, len(ids), n == 0, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [62, 1])
def test_odd_rows(odd, bits):
    """bits = 1: most fingerprints collide, and only the comparison of texts tells them apart."""
    found = E.exact_dedup(odd, bits).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, found), key=repr) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_collisions_of_one_length(spark):
    rows = [(i, f"text {i % 7}") for i in range(40)]
    found = E.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), 0)
    assert sorted(map(tuple, found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr) == brute(rows)


def test_empty(empty):
    assert E.exact_dedup(empty).count() == 0


def fingerprint(raw: bytes):
    return E.fingerprint_block(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), E.power_table())[0]


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000), st.binary(max_size=3000))
def test_composition(a, b):
    shift = E.powers(np.array([len(b)]))
    assert (E.combine(fingerprint(a)[None], fingerprint(b)[None], shift)[0] == fingerprint(a + b)).all()


def test_definition():
    raw = bytes(range(256)) * 9
    for k in range(4):
        p, r = int(E.PRIMES[k]), int(E.BASES[k])
        h = 0
        for c in raw:
            h = (h * r + c + 1) % p
        assert h == fingerprint(raw)[k]


def test_hot_groups(spark, odd, monkeypatch):
    """With small bounds most groups take the way of hot ones."""
    from tilewright.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 2)
    rows = [(i, f"text {i % 7}" if i % 3 else "the same") for i in range(60)]
    for df, expected in ((spark.createDataFrame(rows, "doc_id long, text string"), rows), (odd, [(r.doc_id, r.text) for r in odd.collect()])):
        assert sorted(map(tuple, E.exact_dedup(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr) == brute(expected)


def test_no_scratch_folder_on_a_cluster(spark):
    from types import SimpleNamespace

    from tilewright.llm.common import scratch_root

    away = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://somewhere:7077"))
    with pytest.raises(RuntimeError):
        scratch_root(away)
