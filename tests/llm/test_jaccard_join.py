import random
import re

import pytest

from tests.llm.conftest import prose
from tilewright.llm import components as K
from tilewright.llm import jaccard_join as J


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """doc_id -> (n_shingles, component_id, n_links) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    distinct = list({s for _, s in sets if s})
    linked = {s: [o for o in distinct if o is not s and 100 * len(s & o) >= 80 * len(s | o)] for s in distinct}
    out = []
    for i, s in sets:
        if not s:
            out.append((i, 0, i, 0))
            continue
        seen, todo = {s}, [s]
        while todo:
            for o in linked[todo.pop()]:
                if o not in seen:
                    seen.add(o)
                    todo.append(o)
        ids = [j for j, o in sets if o in seen and j is not None]
        out.append((i, len(s), min(ids) if ids else None, len(linked[s])))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, J.jaccard_join(df).select("doc_id", "n_shingles", "component_id", "n_links").collect()), key=repr)


def test_odd_rows(odd):
    assert found(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_empty(empty):
    assert J.jaccard_join(empty).count() == 0


def edited(seed, text, edits):
    r, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = f"edit{r.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    """Groups of edited copies of short and long texts, and a passage that all of them share."""
    passage, rows = prose(99, 55), []
    for g in range(14):
        base = prose(g, [8, 30, 110, 150, 170, 400][g % 6])
        for k in range(9):
            rows.append((len(rows), edited(len(rows), base, k // 2) + (f" {passage}" if k % 3 == 0 else "")))
    base = prose(1000, 140)
    rows += [(len(rows) + k, edited(5000 + k, base, k % 6)) for k in range(60)]
    random.Random(3).shuffle(rows)
    return rows


@pytest.mark.parametrize(("block", "common", "small"), [(1000, 64, 1 << 20), (7, 3, 0)])
def test_links(spark, corpus, monkeypatch, block, common, small):
    """With small blocks clusters are parted, with a small bound many tokens are common; components by one task and by many."""
    monkeypatch.setattr(K, "SMALL", small)
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "COMMON", common)
    assert found(spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)) == brute(corpus)


def test_sets_without_enough_low_tokens(spark, monkeypatch):
    """With a tiny share of tokens most long sets meet by all their tokens."""
    monkeypatch.setattr(J, "SHARE", 0.12)
    rows = [(i, edited(i, prose(i // 3, 200), i % 3 * 2)) for i in range(30)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def chain(n, words=40, step=7):
    """Texts of which each shares most of its words with the next one, but no two are similar enough."""
    r = random.Random(8)
    pool = [f"word{r.randrange(10**9)}" for _ in range(n * step + words)]
    return [(i, " ".join(pool[i * step : i * step + words])) for i in range(n)]


def test_chain_of_weak_candidates(spark, monkeypatch):
    """A chain that prefixes tie together makes no work that grows with its square."""
    monkeypatch.setattr(J, "BLOCK", 8)
    n = 400
    rows = chain(n)
    shipped = []
    tasks = J._tasks
    monkeypatch.setattr(J, "_tasks", lambda *a: shipped.append(tasks(*a)) or shipped[0])
    monkeypatch.setattr(J, "drop", lambda df: None)
    result = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r[2] for r in result] == [r[0] for r in result] and {r[3] for r in result} == {0}
    clustered = shipped[0].select("rep").distinct().count()
    assert clustered > n / 2, "prefixes under one order tie them together"
    assert shipped[0].count() <= 8 * n


def test_long_chain_of_links(spark, monkeypatch):
    """A chain of true links goes by its pairs, not by all pairs of blocks."""
    monkeypatch.setattr(J, "BLOCK", 4)
    shipped, tasks = [], J._tasks
    monkeypatch.setattr(J, "_tasks", lambda *a: shipped.append(tasks(*a)) or shipped[0])
    monkeypatch.setattr(J, "drop", lambda df: None)
    rows = chain(400, 60, 3)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert shipped[0].count() <= 400 * 25 and shipped[0].where("i = -1").count() > 0


def test_filters_intersect():
    """Each order's filter lets through every pair that links, and all together hardly any other."""
    r, sets = random.Random(4), []
    for g in range(12):
        base = [r.randrange(1 << 64) for _ in range(60)]
        for k in range(12):
            kept = [x for x in base if r.random() > 0.03 * k]
            sets.append(J.np.unique(J.np.array(kept + [r.randrange(1 << 64) for _ in range(60 - len(kept))], J.np.uint64)))
    counted = {}
    links = J.verified(sets, counted=counted)
    expected = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 100 * len(set(sets[i]) & set(sets[j])) >= 80 * len(set(sets[i]) | set(sets[j]))]
    assert links == expected and len(links) <= counted["pairs"] < len(sets) * len(sets) / 4
    home = J.np.arange(len(sets)) % 2
    by = J.np.argsort(home, kind="stable")
    between = {tuple(sorted((int(by[i]), int(by[j])))) for i, j in J.verified([sets[i] for i in by], home[by])}
    assert between == {(i, j) for i, j in expected if home[i] != home[j]}


def test_hot_classes(spark, odd, monkeypatch):
    from tilewright.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 2)
    assert found(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_components(spark, monkeypatch):
    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1400)] + [(5, None), (None, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    expected = sorted((x, find(x)) for x in root)
    for small in (1 << 20, 0):
        monkeypatch.setattr(K, "SMALL", small)
        assert sorted(map(tuple, K.components(spark.createDataFrame(links, "a long, b long").repartition(3)).collect())) == expected
