import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import prose
from tilewright.llm import sharding as S


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("irt"), st.integers(0, 30)), max_size=80))
def test_room_tree(steps):
    tree, kept = S.RoomTree(), []
    for n, (what, size) in enumerate(steps):
        if what == "i":
            tree.insert(size, n)
            kept.append((size, n))
        else:
            found = min((k for k in kept if k[0] >= size), default=None)
            assert tree.tightest(size) == found
            if what == "r" and found:
                tree.remove(found)
                kept.remove(found)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), min_size=1, max_size=12))
def test_best_fit_decreasing(counts):
    classes = sorted(counts.items(), reverse=True)
    placed = S.best_fit_decreasing(classes, 60)
    rooms = {}
    for nth, bin_, n in placed:
        rooms[bin_] = rooms.get(bin_, 60) - n * classes[nth][0]
    assert min(rooms.values()) >= 0
    assert [sum(n for k, _, n in placed if k == i) for i in range(len(classes))] == [n for _, n in classes]
    assert len(rooms) <= 11 / 9 * -(-sum(s * n for s, n in classes) // 60) * 1.7 + 1


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 5000), st.integers(1, 300), min_size=1, max_size=30))
def test_even_bins(counts):
    classes = sorted(counts.items(), reverse=True)
    placed = S.even_bins(classes, 16)
    loads = [0] * 16
    for nth, bin_, n in placed:
        loads[bin_] += n * classes[nth][0]
    assert sum(loads) == sum(s * n for s, n in classes)
    if classes[0][0] * 100 < sum(loads):
        assert max(loads) <= sum(loads) / 16 + classes[0][0]


def check(df):
    found = S.shard(df).collect()
    rows = df.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    assert sorted(repr((f.doc_id, f.size, f.text_crc32)) for f in found) == sorted(repr((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))) for r in rows)
    slots, of = {}, {}
    for f in found:
        assert f.law == "bytes" and f.grown_shard is None and 0 <= f.shard < 16
        slots.setdefault(f.shard, []).append(f.slot)
        of.setdefault((f.text_crc32, f.size), set()).add(f.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of.values())
    return found


def test_odd_rows(odd, empty):
    check(odd)
    assert S.shard(empty).count() == 0


def test_near_equal_and_a_large_group(spark):
    rows = [(i, prose(i, 20 + i % 40)) for i in range(1500)]
    smallest = min(len(t) + 1 for _, t in rows)
    loads = {}
    for f in check(spark.createDataFrame(rows, "doc_id long, text string")):
        loads[f.shard] = loads.get(f.shard, 0) + f.size
    assert max(loads.values()) - min(loads.values()) <= smallest
    rows += [(10_000 + i, prose(7, 30)) for i in range(800)]
    found = check(spark.createDataFrame(rows, "doc_id long, text string"))
    loads = {}
    for f in found:
        loads[f.shard] = loads.get(f.shard, 0) + f.size
    alone = max(loads.values())
    rest = sorted(loads.values())[:-1]
    assert alone > 2 * rest[-1] and rest[-1] - rest[0] <= smallest and len(rest) == 15


def test_a_group_of_most_rows(spark):
    """Its rows find their shard by a broadcast, those of the others by a shuffle."""
    rows = [(i, prose(i, 20 + i % 40)) for i in range(700)] + [(10_000 + i, prose(7, 30)) for i in range(1300)]
    found = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert len({f.shard for f in found if f.doc_id >= 10_000}) == 1 and len({f.shard for f in found}) == 16
