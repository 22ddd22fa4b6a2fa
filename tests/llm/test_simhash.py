import hashlib

import numpy as np
import pytest
from tests.llm.conftest import prose
from tilewright.llm import simhash as S


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for n, (i, t) in enumerate(order):
        t, f = t or "", order[(n + 1) % len(order)][1] or ""
        e = t[: len(t) - len(t) // 3] + f[: len(t) // 3]
        p = S.fingerprints([x.encode() for x in (t, e, f)])
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), p[0].tobytes().hex(), p[1].tobytes().hex(), float(S.likeness(p[:1], p[1:2])[0]), float(S.likeness(p[:1], p[2:])[0])))
    return sorted(map(repr, out))


def test_odd_rows(odd):
    found = S.simhash(odd)
    assert sorted(map(repr, (tuple(r)[:7] for r in found.collect()))) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_rows_without_doc_id(spark):
    """A third of the rows and more share one doc_id or have none."""
    rows = [(None if i % 2 else 7 if i % 3 else i, prose(i % 150, 8 + i % 20)) for i in range(300)]
    found = S.simhash(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(repr, (tuple(r)[:7] for r in found.collect()))) == brute(rows)


def test_one_row_and_none(spark, empty):
    one = S.simhash(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).first()
    assert (one.edited_sha256, one.near_next, one.n_near) == (hashlib.sha256(b"abcdab").hexdigest(), 1.0, None)
    assert S.simhash(empty).count() == 0


def test_votes():
    text = prose(1, 40)
    words = text.split()
    from tilewright.llm.common import mix64
    from tilewright.llm.shingles import shingle_hashes, word_hashes

    raw = np.frombuffer(text.encode(), np.uint8)
    terms, _ = shingle_hashes(*word_hashes(raw, np.array([0, len(raw)])))
    assert len(terms) == len(words) - 4
    bits = np.unpackbits(np.stack([terms, mix64(terms ^ np.uint64(0xC2B2AE3D27D4EB4F))], axis=1).view(np.uint8), axis=1)
    assert (np.unpackbits(S.fingerprints([text.encode()])[0]) == (bits.mean(axis=0) > 0.5)).all()
    assert not S.fingerprints([b"", b" \n"]).any()


@pytest.mark.parametrize("radius", [0, 3, 8])
def test_within_radius(spark, radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(-(2**63), 2**63 - 1, (40, 2))
    prints = {tuple(map(int, b)) for b in base}
    for b in base:
        for k in range(10):
            bits = rng.choice(128, k, replace=False)
            flip = [sum(1 << (63 - int(x) % 64) for x in bits if x // 64 == w) for w in (0, 1)]
            prints.add(tuple(int(np.uint64(np.int64(v).view(np.uint64)) ^ np.uint64(f)) - (1 << 64) * (int(np.uint64(np.int64(v).view(np.uint64)) ^ np.uint64(f)) >> 63) for v, f in zip(b, flip, strict=True)))
    prints = sorted(prints)
    index = spark.createDataFrame([(a, b, 1 + i % 3) for i, (a, b) in enumerate(prints)], "p1 long, p2 long, n long")
    queries = spark.createDataFrame(prints[::5], "p1 long, p2 long")
    distance = lambda p, q: sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(p, q, strict=True))
    expected = {q: sum(1 + i % 3 for i, p in enumerate(prints) if distance(p, q) <= radius) for q in prints[::5]}
    assert {(r.q1, r.q2): r.n for r in S.within_radius(queries, index, radius).collect()} == expected


def test_edited_texts_are_near(spark):
    """Texts of Jaccard similarity 0.8 and more are within the radius, unrelated ones aren't."""
    from tilewright.llm.shingles import shingle_sets

    rows = []
    for k in range(20):
        words = prose(100 + k, 200).split()
        rows.append((50 * k, " ".join(words)))
        for e in range(1, 5):  # e words replaced: some 5 e of 196 shingles
            rows.append((50 * k + e, " ".join(f"new{e}" if i in range(20, 20 + 40 * e, 40) else w for i, w in enumerate(words))))
    raw = [t.encode() for _, t in rows]
    sets, _ = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    expected = {i: sum(len(np.intersect1d(a, b)) / len(np.union1d(a, b)) >= 0.8 for b in sets) - 1 for (i, _), a in zip(rows, sets, strict=True) if i % 50 == 0}
    assert set(expected.values()) == {4}
    found = S.simhash(spark.createDataFrame(rows, "doc_id long, text string")).where("n_near is not null").collect()
    assert {r.doc_id: r.n_near for r in found} == expected


def test_documents_within_radius(spark, odd):
    """near_ids and the fingerprints lead to the rows of all prints within the radius."""
    more = spark.createDataFrame([(50, prose(2, 120) + " end"), (100, prose(3, 60)), (150, "one two three"), (200, prose(4, 60) + " last")], "doc_id long, text string")
    rows = S.simhash(odd.select("doc_id", "text").union(more)).collect()
    prints = {r.fingerprint: int(r.fingerprint, 16) for r in rows}
    least = {f: min((r.doc_id for r in rows if r.fingerprint == f and r.doc_id is not None), default=None) for f in prints}
    asked = [r for r in rows if r.n_near is not None]
    assert {r.doc_id for r in asked} == {0, 50, 100, 150, 200}
    assert all(r.near_ids is None for r in rows if r.n_near is None)
    for r in asked:
        near = {f for f, p in prints.items() if (p ^ prints[r.fingerprint]).bit_count() <= S.RADIUS}
        assert r.near_ids == sorted((least[f] for f in near), key=lambda i: (i is None, i))
        members = [m for m in rows if m.fingerprint in {x.fingerprint for x in rows if x.doc_id in r.near_ids}]
        assert r.n_near == len(members) - 1


@pytest.mark.parametrize("radius", [0, 3, 7, 28, 45])
def test_tables_find_every_near_print(radius):
    """Against all distances, among prints that differ from each other in any number of bits."""
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2, (20, 128), dtype=np.uint8)
    bits = np.concatenate([base ^ (rng.random((20, 128)) < share) for share in np.linspace(0, 0.4, 40)]).astype(np.uint8)
    p1, p2 = np.packbits(np.unique(bits, axis=0), axis=1).view(np.uint64).T.copy()
    q1, q2 = p1[::3], p2[::3]
    pairs = [p for q, f in S.near_prints(q1, q2, p1, p2, radius) for p in zip(q.tolist(), f.tolist(), strict=True)]
    distance = np.bitwise_count(q1[:, None] ^ p1).astype(int) + np.bitwise_count(q2[:, None] ^ p2)
    assert len(pairs) == len(set(pairs)) and sorted(pairs) == sorted(zip(*(x.tolist() for x in np.nonzero(distance <= radius)), strict=True))
