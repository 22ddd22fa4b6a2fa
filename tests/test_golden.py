"""The small world: two snapshots of a 4 x 4 grid of 4 x 4 pixel tiles in archives of two parts each."""

import io
import struct
import tarfile
import zlib

import numpy as np
import pytest

from tilewright.operators import palette
from tilewright.plans.pipeline import Config, Pipeline, StageError
from tilewright.sources import png

T1, T2 = "world-2025-01-01T00-00-00.000Z", "world-2025-01-11T00-00-00.000Z"
RED, GREEN, BLUE, MAGENTA = 0xFF0000, 0x00FF00, 0x0000FF, 0xFF00FF


def rgba(fill, **at):
    image = np.zeros((4, 4, 4), np.uint8)
    image[:] = fill
    for key, value in at.items():
        image[int(key[1]), int(key[2])] = value
    return png.encode(image)


def write_png(width, height, depth, colour, lines, palette_=b"", trns=b"", lace=0):
    out = png.SIGNATURE + png._chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, lace))
    if palette_:
        out += png._chunk(b"PLTE", palette_)
    if trns:
        out += png._chunk(b"tRNS", trns)
    return out + png._chunk(b"IDAT", zlib.compress(lines)) + png._chunk(b"IEND", b"")


def rgb_black_with_blue():
    image = np.zeros((4, 4, 3), np.uint8)
    image[0, 1] = (0, 0, 255)
    return write_png(4, 4, 8, 2, b"".join(b"\0" + row.tobytes() for row in image))


def indexed():
    lines = np.zeros((4, 4), np.uint8)
    lines[0, 1] = 1
    return write_png(4, 4, 8, 3, b"".join(b"\0" + row.tobytes() for row in lines), bytes([9, 9, 9, 255, 0, 255]), bytes([0]))


def archive(folder, tag, members, codec):
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w") as tar:
        for name, body in members:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
    if codec == "gz":
        import gzip

        body = gzip.compress(raw.getvalue())
    else:
        import zstandard

        body = zstandard.ZstdCompressor().compress(raw.getvalue())
    half = len(body) // 2
    (folder / f"{tag}.tar.{codec}.aa").write_bytes(body[:half])
    (folder / f"{tag}.tar.{codec}.ab").write_bytes(body[half:])


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")
    folder = root / "archives" / "a"
    folder.mkdir(parents=True)
    red, blue, green = (255, 0, 0, 255), (0, 0, 255, 255), (0, 255, 0, 255)
    first = [("w/0/0.png", rgba(0, _11=red, _22=blue)), ("w/1/0.png", rgb_black_with_blue()), ("w/2/0.png", indexed()), ("readme.txt", b"x")]
    second = [("w/0/0.png", rgba(0, _11=green)), ("w/0/1.png", rgba((0, 0, 0, 255), _11=green))]
    archive(folder, T1, first, "gz")
    archive(folder, T2, second, "zst")
    config = Config.load(root=str(root), grid_tiles=4, tile_size=4, shard_tiles=2, min_days=7, max_colours=8)
    pipeline = Pipeline(spark, config)
    assert pipeline.run() == [T1, T2]
    return pipeline


def test_state(world):
    found = {(r.x, r.y, r.pos): r.rgb24 for r in world.state().collect()}
    expected = {(0, 0, 5): GREEN, (0, 0, 10): BLUE, (1, 0, 1): BLUE, (2, 0, 1): MAGENTA}
    expected |= {(0, 1, p): GREEN if p == 5 else 0 for p in range(16)}
    assert found == expected


def test_encodings_and_shards(world):
    tiles = {(r.x, r.y): (r["count"], r.encoding) for r in world.tiles().collect()}
    assert tiles == {(0, 0): (2, "sparse"), (0, 1): (16, "dense"), (1, 0): (1, "sparse"), (2, 0): (1, "sparse")}
    shards = {r.name: (r.tile_count, r.visible_pixels) for r in world.manifest().collect()}
    assert shards == {"s0000_0000": (3, 19), "s0001_0000": (1, 1)}


def test_palette_of_state(world):
    assert [(r["index"], r.rgb24) for r in world.palette().orderBy("index").collect()] == [(1, 0), (2, BLUE), (3, GREEN), (4, MAGENTA)]


def test_nothing_is_applied_twice(world):
    before = world.store.versions()
    assert world.run() == []
    assert world.store.versions() == before


def test_export(world):
    from pathlib import Path

    image, _ = png.decode((Path(world.config.root) / "export/11/0/0.png").read_bytes())
    assert image[1, 1].tolist() == [0, 255, 0, 255]
    assert image[0, 0].tolist() == [0, 0, 0, 0]
    assert len(list(Path(world.config.root).glob("export/11/*/*.png"))) == 4


def test_black_warning(world):
    row = world.archives().where(f"tag = '{T2}'").first()
    from tilewright.operators.transparency import black_summary

    found = black_summary(world.overlay(row.tag, row.tag_ts, row.paths), 0.7).where("warning").collect()
    assert [(r.x, r.y) for r in found] == [(0, 1)]


def test_validate_and_other_settings(world, spark):
    assert world.validate().isEmpty()
    changed = Pipeline(spark, Config.load(root=world.config.root, grid_tiles=4, tile_size=4, shard_tiles=2, max_colours=9))
    assert {r.rule for r in changed.validate().collect()} == {"other settings"}


def test_palette_overflow_leaves_the_state(spark, tmp_path):
    folder = tmp_path / "archives" / "a"
    folder.mkdir(parents=True)
    image = np.zeros((2, 2, 4), np.uint8)
    image[0] = [[1, 2, 3, 255], [4, 5, 6, 255]]
    archive(folder, T1, [("0/0.png", png.encode(image))], "gz")
    pipeline = Pipeline(spark, Config.load(root=str(tmp_path), grid_tiles=1, tile_size=2, shard_tiles=1, max_colours=1))
    with pytest.raises(StageError) as e:
        pipeline.run()
    assert e.value.stage == "palette"
    assert pipeline.store.versions() == []
    assert [r.stage for r in pipeline.failed().collect()] == ["palette"]
    assert pipeline.state().isEmpty()


def test_checked_palette(spark):
    colours = spark.createDataFrame([(i, i) for i in range(3)], "index int, rgb24 int")
    assert palette.checked(colours, 3).count() == 3
    with pytest.raises(palette.PaletteOverflow):
        palette.checked(colours, 2)


def test_shard_read_is_pruned(world):
    found = world.store.shard(1, 0)
    assert [(r.x, r.y, r.pos) for r in found.collect()] == [(2, 0, 1)]
    assert "PartitionFilters: [isnotnull" in found._jdf.queryExecution().toString()


def test_stream_equals_batch(spark, tmp_path):
    from pyspark.sql import functions as F

    from tilewright.operators.state import rolling_state
    from tilewright.sources.store import Store
    from tilewright.sources.tables import pixels
    from tilewright.streaming.rolling import STATE, stream_state

    px = pixels(spark, "/root/testdata/sf0.001")
    days = [r.tag_ts for r in px.select("tag_ts").distinct().orderBy(F.desc("tag_ts")).collect()]
    for i, part in enumerate([days[:10], days[10:]]):  # later days come first
        px.where(F.col("tag_ts").isin(part)).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{i}"))
    store = Store(spark, str(tmp_path / "state"), 2)
    for i in range(2):
        source = spark.readStream.schema(px.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / f"p{i}"))
        for _ in range(2):  # the second start has nothing to do
            stream_state(source, store, str(tmp_path / f"check{i}")).awaitTermination()
    assert sorted(map(tuple, store.read(STATE).select("x", "y", "pos", "rgb24").collect())) == sorted(map(tuple, rolling_state(px).collect()))
