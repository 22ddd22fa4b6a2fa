from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tilewright.functions import colours, names
from tilewright.operators import encoding, spatial, state, tags
from tilewright.sources.split_archive import ArchiveError, group_parts
from tilewright.sources.store import append_log, clean_temporary, load_json, read_log, save_json


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_tag_times(spark):
    lit = F.lit
    assert one(spark, names.tag_time(lit("world-2025-01-11T02-03-04.567Z")), names.tag_time(lit("world-2025-01-11T02:03:04Z"))) == (datetime(2025, 1, 11, 2, 3, 4),) * 2
    assert one(spark, names.tag_time(lit("world-2025-13-41T00-00-00Z")), names.tag_time(lit("other"))) == (None, None)


def test_parts(spark):
    with pytest.raises(Exception, match="several split archives"):
        tags.select_parts(spark.createDataFrame([("A.tar.zst.aa",), ("B.tar.zst.aa",)], "name string")).collect()
    with pytest.raises(Exception, match="several split archives"):
        tags.select_parts(spark.createDataFrame([("A.tar.zst.aa",), ("A.tar.zstd.aa",)], "name string")).collect()
    found = tags.select_parts(spark.createDataFrame([("T.tar.gz.ab",), ("T.tar.gz.aa",), ("T.tar.gz.sha256",)], "name string")).orderBy("part_no")
    assert [r.name for r in found.collect()] == ["T.tar.gz.aa", "T.tar.gz.ab"]
    assert group_parts(["d/T.tar.gz.10", "d/T.tar.gz.2", "d/T.tar.gz.b"]) == {("T", "gzip"): ["d/T.tar.gz.2", "d/T.tar.gz.10", "d/T.tar.gz.b"]}
    for bad in ([], ["x.png"], ["T.tar.gz.txt"]):
        with pytest.raises(ArchiveError):
            group_parts(bad)


def test_colours(spark):
    assert colours.parse_colours("#0000ff; 1,2,3|#0000FF;") == [255, 0x010203]
    for bad in ("#12", "1,2", "1,2,300"):
        with pytest.raises(ValueError):
            colours.parse_colours(bad)
    c = F.lit(0x010203)
    assert one(spark, colours.to_hex(c), colours.from_hex(F.lit("#010203")), colours.red(c), colours.green(c), colours.blue(c)) == ("#010203", 0x010203, 1, 2, 3)
    half = one(spark, colours.over_alpha(F.lit(128), F.lit(255)), colours.over_channel(F.lit(200), F.lit(128), F.lit(100), F.lit(255)), colours.over_channel(F.lit(9), F.lit(0), F.lit(9), F.lit(0)))
    assert half == (255, 150, 0)


def test_composite(spark):
    layers = spark.createDataFrame([(1, 0, 0, 0, 0x646464, 255), (2, 0, 0, 0, 0xC8C8C8, 128), (1, 0, 0, 1, 0x0A0A0A, 0)], "event_id long, x int, y int, pos int, rgb24 int, alpha int")
    found = {r.pos: (r.rgb24, r.alpha) for r in state.composite_over(layers).collect()}
    assert found == {0: (0x969696, 255), 1: (0, 0)}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=20))
def test_payloads(values):
    positions = list(range(0, 5 * len(values), 5))
    dense = bytearray(100)
    for p, v in zip(positions, values, strict=True):
        dense[p] = v
    sparse = encoding.sparse_payload(positions, values)
    assert encoding.pairs_of_payload(sparse, "sparse", len(values), 100) == (positions, values)
    assert encoding.pairs_of_payload(bytes(dense), "dense", len(values), 100) == (positions, values)
    with pytest.raises(ValueError):
        encoding.pairs_of_payload(sparse + b"x", "sparse", len(values), 100)


def brute_labels(points, d):
    """Components of a dilated mask by flood filling, restricted to the painted pixels."""
    size = 24
    mask = np.zeros((size, size), bool)
    for x, y in points:
        mask[max(0, y + 4 - d) : y + 5 + d, max(0, x + 4 - d) : x + 5 + d] = True
    label = np.zeros(mask.shape, int)
    n = 0
    for start in zip(*np.nonzero(mask), strict=True):
        if label[start]:
            continue
        n += 1
        todo = [start]
        while todo:
            y, x = todo.pop()
            if 0 <= y < size and 0 <= x < size and mask[y, x] and not label[y, x]:
                label[y, x] = n
                todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
    groups = {}
    for x, y in points:
        groups.setdefault(label[y + 4, x + 4], set()).add((x, y))
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("d", [0, 1, 3])
def test_components(spark, d):
    rng = np.random.default_rng(d)
    points = sorted({(int(x), int(y)) for x, y in rng.integers(0, 16, (26, 2))})
    df = spark.createDataFrame([((y << 31) | x, x, y, 1) for x, y in points], "id long, wx long, wy long, rgb24 int")
    groups = {}
    for r in spatial.components(df, d).collect():
        groups.setdefault(r.component, set()).add((r.wx, r.wy))
    assert sorted(map(sorted, groups.values())) == brute_labels(points, d)


def test_mosaic_agrees_with_world_for_small_drawings(spark):
    pixels = [(1, 1, 15, 1), (2, 1, 12, 2), (2, 1, 13, 3), (0, 0, 0, 5), (0, 0, 1, 6), (3, 3, 5, 7)]  # 4 x 4 tiles
    df = spark.createDataFrame(pixels, "x int, y int, pos int, rgb24 int")
    world = spatial.artworks(spatial.component_stats(spatial.components(spatial.world(df, 4), 0)), 2).drop("component")
    mosaic = spatial.mosaic_artworks(df, 4, 0, 2)
    columns = ["world_x", "world_y", "w", "h", "pixels", "n_colors", "name", "skip_reason"]
    assert sorted(map(repr, mosaic.select(*columns).collect())) == sorted(map(repr, world.select(*columns).collect()))


def test_merge_is_idempotent_and_order_free(spark):
    from tilewright.streaming.rolling import STATE, merge

    rows = [(i, datetime(2025, 1, 1 + i % 3), 0, 0, i % 4, i, 255 if i % 5 else 0) for i in range(20)]
    df = spark.createDataFrame(rows, "event_id long, tag_ts timestamp_ntz, x int, y int, pos int, rgb24 int, alpha int")
    empty = spark.createDataFrame([], STATE)
    a, b = df.where("event_id < 10"), df.where("event_id >= 10")
    whole = sorted(map(tuple, merge(empty, df).collect()))
    assert sorted(map(tuple, merge(merge(empty, a), b).collect())) == whole
    assert sorted(map(tuple, merge(merge(merge(empty, b), a), b).collect())) == whole


def test_logs(spark, tmp_path):
    path = str(tmp_path / "log")
    append_log(spark.createDataFrame([("a", 1)], "tag string, n int"), path)
    (tmp_path / "log" / "part-x.json").write_text('{"tag": "b", "n": 2}\nnot json\n')
    assert sorted(map(tuple, read_log(spark, path, "tag string, n int").collect())) == [("a", 1), ("b", 2)]
    save_json(str(tmp_path / "s.json"), {"a": 1})
    assert load_json(str(tmp_path / "s.json"), None) == {"a": 1}
    assert load_json(str(tmp_path / "none.json"), 5) == 5
    (tmp_path / "x.tmp").write_text("")
    assert clean_temporary(str(tmp_path)) == 1


def test_downloads(spark):
    import hashlib

    body = b"abc"
    files = spark.createDataFrame([("a", 3, bytearray(body)), ("b", 3, bytearray(body)), ("c", 3, bytearray(body))], "name string, length long, content binary")
    wanted = spark.createDataFrame([("a", 3, "sha256:" + hashlib.sha256(body).hexdigest()), ("b", 3, "sha256:00"), ("c", 4, None)], "name string, size long, digest string")
    assert [r.name for r in tags.valid_downloads(files, wanted).collect()] == ["a"]


def test_cli(tmp_path, capsys):
    from tilewright.cli import main

    (tmp_path / "a.part").write_text("")
    assert main(["clean", "--root", str(tmp_path)]) == 0
    (tmp_path / "bad.toml").write_text("nonsense = 1\n")
    assert main(["clean", "--config", str(tmp_path / "bad.toml")]) == 1
    assert "ERROR: ValueError" in capsys.readouterr().err


def test_compression():
    payload = encoding.sparse_payload([1, 2], [3, 4])
    assert encoding.decompress(encoding.compress(payload), "zstd", 10) == payload
    assert encoding.decompress(payload, "none", 10) == payload
    for bad in (("zstd", 9), ("lz4", 10)):
        with pytest.raises(ValueError):
            encoding.decompress(encoding.compress(payload), *bad)


def test_crops(spark):
    from tilewright.sources.png import decode

    df = spark.createDataFrame([(0, 0, 5, 0xFF0000), (0, 0, 6, 0x00FF00), (1, 1, 0, 0x0000FF)], "x int, y int, pos int, rgb24 int")
    labelled = spatial.components(spatial.world(df, 4), 0)
    kept = spatial.artworks(spatial.component_stats(labelled), 2).where("skip_reason is null")
    (row,) = spatial.crops(labelled, kept).collect()
    assert row.name == "art_x1_y1_w2_h1.png"
    assert decode(row.content)[0].tolist() == [[[255, 0, 0, 255], [0, 255, 0, 255]]]


def test_crops_of_large_drawings(spark):
    """Drawings above the bound come in parts that hold all of their pixels."""
    from tilewright.sources.png import decode

    line = [(x, 2, 0x010000 + x) for x in range(3, 14)] + [(13, y, 0x020000 + y) for y in range(3, 9)]
    small = [(0, 20, 1), (1, 20, 2)]
    df = spark.createDataFrame([((y << 31) | x, x, y, c) for x, y, c in line + small], "id long, wx long, wy long, rgb24 int")
    labelled = spatial.components(df, 0)
    rows = spatial.crops(labelled, spatial.artworks(spatial.component_stats(labelled), 2), 4).collect()
    large = "art_x3_y2_w11_h7"
    assert {(r.name, r.part_row, r.part_column) for r in rows} == {("art_x0_y20_w2_h1.png", 0, 0)} | {(f"{large}_r{r}_c{c}.png", r, c) for r, c in ((0, 0), (0, 1), (0, 2), (1, 2))}
    found = {}
    for r in rows:
        image = decode(r.content)[0]
        assert image.shape[0] <= 4 and image.shape[1] <= 4
        for y, x in zip(*np.nonzero(image[:, :, 3]), strict=True):
            v = image[y, x].tolist()
            x0, y0 = (3, 2) if r.name.startswith(large) else (0, 20)
            found[x0 + r.part_column * 4 + int(x), y0 + r.part_row * 4 + int(y)] = v[0] << 16 | v[1] << 8 | v[2]
    assert found == {(x, y): c for x, y, c in line + small}


def test_suffixes_of_letters_are_parts(spark):
    """A long archive has parts .md, .sig and .asc; only notes and digests are left out."""
    from tilewright.operators import tags
    from tilewright.sources.split_archive import group_parts

    two = [f"T.tar.gz.{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(320)]
    three = ["U.tar.gz.asc", "U.tar.gz.sig", "U.tar.gz.aaa"]
    others = ["T.tar.gz.txt", "T.tar.gz.json", "T.tar.gz.digest", "T.tar.gz.sha256", "T.tar.gz.md5", "readme.md"]
    df = spark.createDataFrame([(n,) for n in [*reversed(two), *others]], "name string")
    rows = tags.select_parts(df).orderBy("part_no").collect()
    assert [r.name for r in rows] == two and "T.tar.gz.md" in two
    assert group_parts(list(reversed(two)))[("T", "gzip")] == two
    assert group_parts(three)[("U", "gzip")] == ["U.tar.gz.aaa", "U.tar.gz.asc", "U.tar.gz.sig"]


def test_tile_paths_in_capitals(spark, tmp_path):
    from tilewright.sources.store import tile_files

    for name in ("3/4.PNG", "3/5.png", "3/6.Png", "3/7.txt"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"x")
    assert sorted((r.x, r.y) for r in tile_files(spark, str(tmp_path)).collect()) == [(3, 4), (3, 5), (3, 6)]


def test_dense_records_of_a_production_tile(spark):
    """1000 x 1000 pixels, a quarter of them visible."""
    from tilewright.operators import encoding

    n = 1_000_000
    values = spark.range(0, n, 4).select(F.lit(1).alias("x"), F.lit(2).alias("y"), F.col("id").cast("int").alias("pos"), (F.col("id") % 63 + 1).cast("int").alias("value"))
    dense = encoding.dense_records(encoding.sparse_records(values), n)
    row = dense.select(F.size("dense").alias("n"), F.aggregate("dense", F.lit(0).cast("long"), lambda a, v: a + v).alias("total")).first()
    assert row.n == n and row.total == sum(i % 63 + 1 for i in range(0, n, 4))
    assert encoding.from_dense(dense).count() == n // 4
