import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tilewright.llm import packing as P
from tilewright.llm.queries import tokenizer_path


def content(patterns):
    used = {}
    for n, members in patterns:
        for s, times in members:
            used[s] = used.get(s, 0) + n * times
    return used


def fewest(sizes, capacity):
    """The least number of bins by branch and bound."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for room in sorted(set(bins)):
            if room >= sizes[i]:
                rest = list(bins)
                rest.remove(room)
                place(i + 1, [*rest, room - sizes[i]])
        place(i + 1, [*bins, capacity - sizes[i]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9), st.integers(20, 26))
def test_dominance_keeps_the_optimum(sizes, capacity):
    counts = {s: sizes.count(s) for s in set(sizes)}
    fixed, left = P.dominant_sets(counts, capacity)
    assert all(sum(s * t for s, t in m) <= capacity for _, m in fixed)
    whole = {s: content(fixed).get(s, 0) + left.get(s, 0) for s in set(content(fixed)) | set(left)}
    assert whole == counts
    rest = [s for s, c in left.items() for _ in range(c)]
    assert sum(n for n, _ in fixed) + fewest(rest, capacity) == fewest(sizes, capacity)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=30))
def test_best_fit(counts):
    patterns = P.best_fit(counts, 64)
    assert content(patterns) == counts
    assert all(sum(s * t for s, t in m) <= 64 for _, m in patterns)
    table = P.slots(patterns)
    assert (np.diff(table[:, 0]) >= 0).all()


def reference(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


@pytest.mark.parametrize("capacity", [2048, 16])
def test_odd_rows(odd, capacity):
    rows = odd.select("doc_id", "text").collect()
    expected = []
    for r, ids in zip(rows, reference([r.text for r in rows]), strict=True):
        for k in range(0, len(ids), capacity):
            part = np.array(ids[k : k + capacity], "<u4")
            expected.append((r.doc_id, k // capacity, k, len(part), zlib.crc32(part.tobytes())))
    found = P.pack(odd, tokenizer_path(), capacity).collect()
    assert sorted(map(repr, (tuple(f)[:5] for f in found))) == sorted(map(repr, expected))
    by = {}
    for f in found:
        by.setdefault(f.sequence_id, []).append((f.offset, f.length))
    for parts in by.values():
        assert [o for o, _ in sorted(parts)] == [0, *itertools.accumulate(n for _, n in sorted(parts))][:-1]
        assert sum(n for _, n in parts) <= capacity
    least = -(-sum(f.length for f in found) // capacity)
    assert least <= len(by) <= 1.1 * least + 1


def test_words_of_many_kinds():
    import pyarrow as pa

    texts = ["it's DON'T we'll", "x<|endoftext|>y", "İ ΣΑΣ áb Ünï. ß ÀÉ² x×y … 日本", "a\x1cb  c", "12ab!!34 ***x### ~ ^_^", "", "é" * 50]
    ids, at = P.WordEncoder(tokenizer_path()).encode(pa.array(texts))
    for i, expected in enumerate(reference(texts)):
        assert ids[at[i] : at[i + 1]].tolist() == expected[:-1]


def test_forgetting(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(P, "REMEMBERED", 5)
    e = P.WordEncoder(tokenizer_path())
    for texts in (["a b c d"], ["e f g", "a h"], ["a b c d e f g h i"]):
        ids, at = e.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [r[:-1] for r in reference(texts)]


def test_empty(empty):
    assert P.pack(empty, tokenizer_path()).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_any_tokenizer(name):
    """The shortcuts are used only with a tokenizer that they suit."""
    import os

    import pyarrow as pa
    from tokenizers import Tokenizer

    path = os.path.join(os.path.dirname(tokenizer_path()), name)
    encoder, plain = P.WordEncoder(path), Tokenizer.from_file(path)
    assert encoder.by_word == encoder.plain == (name == "word_bpe_49k.json")
    texts = ["", "One  two\tthree ", "It's 12,5 % of ÄRGER\n\nand e\u0301, \u4e2d\u6587", *P.PROBES]
    ids, at = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
