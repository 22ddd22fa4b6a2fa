"""Stored index, manifest and palette, sinks and commands, on the small world and on one tile of production size."""

import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_golden import BLUE, GREEN, MAGENTA, RED, T1, T2, archive, indexed, rgb_black_with_blue, rgba
from tilewright import cli
from tilewright.operators import palette, payloads, transparency, validation
from tilewright.plans.pipeline import Config, Pipeline
from tilewright.sources import png
from tilewright.sources.store import Store, image_names
from tilewright.streaming.rolling import STATE, fold


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sinks")
    folder = root / "archives" / "a"
    folder.mkdir(parents=True)
    red, blue, green = (255, 0, 0, 255), (0, 0, 255, 255), (0, 255, 0, 255)
    archive(folder, T1, [("w/0/0.png", rgba(0, _11=red, _22=blue)), ("w/1/0.PNG", rgb_black_with_blue()), ("w/2/0.png", indexed())], "gz")
    archive(folder, T2, [("w/0/0.png", rgba(0, _11=green)), ("w/0/1.png", rgba((0, 0, 0, 255), _11=green))], "zst")
    (root / "c.toml").write_text("grid_tiles = 4\ntile_size = 4\nshard_tiles = 2\nmin_days = 7\nmax_colours = 8\n")
    pipeline = Pipeline(spark, Config.load(str(root / "c.toml"), root=str(root)))
    assert pipeline.run(limit=1) == [T1]
    first = {r.name: r["commit"] for r in pipeline.manifest().collect()}
    assert pipeline.run() == [T2]
    return pipeline, first


def call(pipeline, *args):
    return cli.main([args[0], "--config", f"{pipeline.config.root}/c.toml", "--root", pipeline.config.root, *args[1:]])


def test_only_touched_shards_are_written(world):
    pipeline, first = world
    assert first == {"s0000_0000": 1, "s0001_0000": 1}
    assert {r.name: r["commit"] for r in pipeline.manifest().collect()} == {"s0000_0000": 2, "s0001_0000": 1}
    assert {(r.x, r.y, r.pos): r.rgb24 for r in pipeline.state().collect() if (r.x, r.y) != (0, 1)} == {(0, 0, 5): GREEN, (0, 0, 10): BLUE, (1, 0, 1): BLUE, (2, 0, 1): MAGENTA}


def test_one_tile(world):
    assert sorted((r.pos, r.rgb24) for r in world[0].store.tile(0, 0).collect()) == [(5, GREEN), (10, BLUE)]
    assert world[0].store.tile(3, 3).isEmpty()


def test_stored_index_and_palette(world):
    pipeline, _ = world
    assert {(r.x, r.y): (r["count"], r.encoding) for r in pipeline.tiles().collect()} == {(0, 0): (2, "sparse"), (0, 1): (16, "dense"), (1, 0): (1, "sparse"), (2, 0): (1, "sparse")}
    assert pipeline.validate(deep=True).isEmpty()
    # the first snapshot's colours by value, then those of the second; red is no longer in the state
    assert [(r["index"], r.rgb24) for r in pipeline.saved_palette().orderBy("index").collect()] == [(1, BLUE), (2, RED), (3, MAGENTA), (4, 0), (5, GREEN)]


def test_old_versions_go(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), 1, 16)
    rows = lambda *r: spark.createDataFrame(list(r), STATE)
    for k in range(1, 5):
        store.upsert(rows((0, 0, 1, k, k), (k, 0, 1, k, k)), fold, STATE)
    assert store.versions() == [3, 4]
    assert sorted(map(tuple, store.read(STATE).collect())) == [(0, 0, 1, 4, 4), *((k, 0, 1, k, k) for k in range(1, 5))]
    assert sorted(p.parent.name for p in (tmp_path / "s/data/commit=1").glob("sx=*/sy=*")) == ["sx=1"]
    store.replace(rows(), [(0, 0)])
    assert (0, 0) not in {(r.x, r.y) for r in store.read(STATE).collect()} and store.tiles().count() == 4


def test_damage_is_found(spark, tmp_path):
    import shutil

    store = Store(spark, str(tmp_path / "s"), 1, 16)
    store.write(spark.createDataFrame([(0, 0, 1, 5, 1), (1, 0, 2, 6, 1)], STATE))
    shutil.rmtree(tmp_path / "s/index/commit=1/sx=1")
    assert [(r.name, r.kind) for r in store.missing().collect()] == [("s0001_0000", "index")]
    tiles = spark.createDataFrame([(0, 0, 3, "dense", 15), (1, 0, 2, "sparse", 9)], Store.INDEX)
    manifest = spark.createDataFrame([(0, 0, "s0000_0000", 1, 1, 3, 15, 15), (1, 0, "s0009_0000", 1, 1, 2, 9, 9)], Store.MANIFEST)
    found = sorted((r.rule, r.item) for r in validation.index_violations(tiles, manifest, 1, 16).collect())
    assert found == [("encoding of count", "0/0"), ("manifest", "s0001_0000"), ("manifest", "s0009_0000"), ("shard name", "s0009_0000"), ("size of count", "1/0")]
    state = spark.createDataFrame([(0, 0, 1), (0, 0, 1), (0, 0, 17), (2, 2, 1)], "x int, y int, pos int")
    assert sorted(r.item for r in validation.recounted(tiles, state, 16).collect()) == ["0/0", "1/0", "2/2"]
    bad = spark.createDataFrame([(0, 0, 1, "sparse", "zstd", 3, 5, b"abc"), (1, 0, 99, "sparse", "rle", 2, 4, b"abc")], payloads.FIELDS)
    assert sorted((r.rule, r.item) for r in validation.payload_rules(bad, 16).collect()) == [("compression", "1/0"), ("count", "1/0"), ("size", "1/0"), ("uncompressed size", "1/0")]


def test_stats(world):
    root = Path(world[0].config.root)
    told = json.loads((root / f"stats/ingest_{T1}.json").read_text())
    assert told["png_tiles_seen"] == told["records_written"] == 3 and told["visible_pixels"] == 4
    assert told["rgb_tiles_seen"] == told["p_tiles_seen"] == told["p_has_trns"] == told["rgb_black_dominant_tiles"] == 1 and told["p_no_trns"] == 0
    assert json.loads((root / f"stats/ingest_{T2}.json").read_text())["rgba_black_warning_tiles"] == 1
    told = json.loads((root / f"stats/apply_{T2}.json").read_text())
    assert (told["applied_shards"], told["state_tiles"], told["state_visible_pixels"]) == (1, 4, 20)
    assert not list(root.glob("overlays/*"))


def test_records(world, spark):
    pipeline, _ = world
    assert call(pipeline, "records") == 0
    stored = spark.read.parquet(f"{pipeline.config.root}/records").select(*(f.split()[0] for f in payloads.FIELDS.split(", ")))
    assert validation.payload_rules(stored, 16).isEmpty()
    index = {r["index"]: r.rgb24 for r in pipeline.saved_palette().collect()}
    found = {(r.x, r.y, r.pos): index[r.value] for r in payloads.from_payloads(stored, 16).collect()}
    assert found == {(r.x, r.y, r.pos): r.rgb24 for r in pipeline.state().collect()}


def test_artwork_images(world, spark):
    pipeline, _ = world
    out = f"{pipeline.config.root}/art"
    stats = pipeline.artworks(out, 0, 2, per_folder=1)
    assert stats["kept"] == stats["images"] == 1 and stats["existing"] == 0 and stats["found"] == 5
    (row,) = image_names(spark, out).collect()
    image, _ = png.decode((Path(out) / f"{row.bucket:04d}" / row.name).read_bytes())
    assert image.shape == (4, 4, 4) and image[1, 1].tolist() == [0, 255, 0, 255] and row.name == "art_x0_y4_w4_h4.png"
    again = pipeline.artworks(out, 0, 2)
    assert again["images"] == 0 and again["existing"] == 1
    assert call(pipeline, "artworks", "--grow", "0", "--least-pixels", "1", "--out", out) == 0
    assert json.loads((Path(pipeline.config.root) / "stats/artworks.json").read_text())["kept"] == 1


def test_commands(world, capsys, tmp_path):
    pipeline, _ = world
    assert call(pipeline, "validate", "--deep") == 0 and "0 violations" in capsys.readouterr().out
    assert call(pipeline, "inspect", "--tag", T1) == 0
    told = json.loads(capsys.readouterr().out)
    assert told["modes"] == {"RGBA": 1, "RGB": 1, "P": 1} and told["kinds"]["has_trns"] == 1 and told["samples"]["RGB"] == ["1/0.png"]
    report = str(tmp_path / "probe")
    assert call(pipeline, "probe", "--tag", T2, "--out", report) == 0
    assert json.loads(capsys.readouterr().out)["shards"] == 1
    assert call(pipeline, "probe", "--tag", T2, "--out", report, "--only-missing") == 0
    assert json.loads(capsys.readouterr().out)["shards"] == 0
    assert call(pipeline, "diagnose", "--tag", T1, "--out", str(tmp_path / "d")) == 0
    assert json.loads(capsys.readouterr().out)["samples"][0]["visible"] == 1
    assert sorted(p.name for p in (tmp_path / "d/0000").glob("*.png")) == ["1_0_inferred.png", "1_0_original.png"]
    assert call(pipeline, "benchmark", "--repeats", "1", "--out", str(tmp_path / "b")) == 0
    rows = [json.loads(x) for f in (tmp_path / "b/jsonl").glob("*.json") for x in f.read_text().splitlines()]
    assert {(r["tag"], r["mode"], r["ok"]) for r in rows} == {(t, m, True) for t in (T1, T2) for m in ("stream", "tar")}
    assert all(r["decompressed_stream_bytes"] == 10240 and r["decompressed_mib_s"] > 0 for r in rows)
    assert {r["tar_members"] for r in rows if r["mode"] == "tar"} == {2, 3}
    assert call(pipeline, "diagnose", "--tag", "none") == 1


def test_visible_pixels_by_image_and_by_relation(spark):
    """The rule on a decoded image is that of the relational operator."""
    r = np.random.default_rng(3)
    rows, tiles = [], []
    for n in range(12):
        image = r.integers(0, 3, (8, 8, 3)).astype(np.uint8) * 100
        if n % 3:
            image[:] = (7, 7, n)
            image[3, :n] = (1, 2, 3)
            image[0, 0] = image[0, 0] if n % 2 else (9, 9, 9)
        tiles.append(image)
        c = image.reshape(-1, 3).astype(int)
        rows += [(n, p, int(v)) for p, v in enumerate(c[:, 0] << 16 | c[:, 1] << 8 | c[:, 2])]
    px = spark.createDataFrame(rows, "x int, pos int, rgb24 int").withColumns({"y": F.lit(0), "tag_ts": F.lit("2025-01-01").cast("timestamp_ntz")})
    for mode in transparency.MODES:
        marked = transparency.rgb_transparency(px, 8, mode, 0.85, [100 << 16])
        expected = {(r.x, r.pos) for r in marked.where("not transparent").collect()}
        from types import SimpleNamespace

        head = SimpleNamespace(mode="RGB", trns=None)
        found = {(n, int(p)) for n, t in enumerate(tiles) for p in np.flatnonzero(png.visible_mask(t, head, mode, 0.85, (100 << 16,)))}
        assert found == expected


def test_a_tile_of_production_size(spark, tmp_path):
    """1000 x 1000 pixels from the archive to the state, its index, its records and back to an image."""
    folder = tmp_path / "archives" / "a"
    folder.mkdir(parents=True)
    image = np.zeros((1000, 1000, 4), np.uint8)
    image[100:700, 50:900] = (10, 20, 30, 255)
    image[300:310, 300:310] = (200, 20, 30, 255)
    archive(folder, T1, [("11/5/7.png", png.encode(image, 1))], "gz")
    pipeline = Pipeline(spark, Config.load(root=str(tmp_path)))
    assert pipeline.run() == [T1]
    (row,) = pipeline.tiles().collect()
    assert (row.x, row.y, row["count"], row.encoding) == (5, 7, 510_000, "dense")
    values = palette.encode(pipeline.state().withColumn("alpha", F.lit(255)), pipeline.saved_palette())
    assert payloads.from_payloads(payloads.payloads(values, 1_000_000), 1_000_000).count() == 510_000
    again, _ = png.decode((tmp_path / "export/11/5/7.png").read_bytes())
    assert (again == image).all() and pipeline.validate(deep=True).isEmpty()
