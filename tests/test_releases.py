"""Listings and downloads, from a server on this machine."""

import hashlib
import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from tilewright.operators import encoding, payloads, shards, state
from tilewright.sources import releases

BODY = bytes(range(256)) * 2000


class Handler(http.server.BaseHTTPRequestHandler):
    asked: list = []

    def do_GET(self):
        at = int(self.headers.get("Range", "bytes=0-")[6:-1])
        Handler.asked.append((self.path, at))
        if self.path == "/gone":
            return self.send_error(404)
        if self.path == "/busy" and len([a for a in Handler.asked if a[0] == "/busy"]) < 2:
            return self.send_error(429)
        if at >= len(BODY):
            return self.send_error(416)
        plain = self.path == "/whole"  # a server without ranges
        self.send_response(200 if plain or not at else 206)
        self.end_headers()
        self.wfile.write(BODY if plain else BODY[at:])

    def log_message(self, *a):
        pass


@pytest.fixture(scope="module")
def server():
    found = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=found.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{found.server_port}"
    found.shutdown()


def test_listed_tags(spark, tmp_path):
    lines = ["1 refs/tags/world-2025-01-11T00-00-00.000Z", "2 refs/tags/world-2025-01-01T00-00-00.000Z", "2 refs/tags/world-2025-01-01T00-00-00.000Z^{}", "3 refs/tags/v1", "4 refs/tags/world-x"]
    (tmp_path / "tags.txt").write_text("\n".join(lines))
    assert [r.tag for r in releases.listed_tags(spark, str(tmp_path / "tags.txt")).collect()] == ["world-2025-01-01T00-00-00.000Z", "world-2025-01-11T00-00-00.000Z"]


def test_assets_and_downloads(spark, server, tmp_path):
    digest = "sha256:" + hashlib.sha256(BODY).hexdigest()
    names = {"plain": (len(BODY), digest), "part": (len(BODY), digest), "whole": (len(BODY), None), "long": (len(BODY), digest), "busy": (None, digest), "gone": (1, None), "bad": (len(BODY), "sha256:00"), "there": (3, None)}
    release = {"tag_name": "T", "assets": [{"name": f"{n}.tar.gz.aa", "size": s, "digest": d, "browser_download_url": f"{server}/{n}"} for n, (s, d) in names.items()]}
    wanted = releases.assets(spark.createDataFrame([(json.dumps(release),), (json.dumps({"tag_name": "U"}),)], "json string"))
    assert wanted.count() == len(names)
    (tmp_path / "T").mkdir()
    (tmp_path / "T/part.tar.gz.aa.part").write_bytes(BODY[:1000])
    (tmp_path / "T/whole.tar.gz.aa.part").write_bytes(b"other")
    (tmp_path / "T/long.tar.gz.aa.part").write_bytes(BODY + b"more")
    (tmp_path / "T/there.tar.gz.aa").write_bytes(b"abc")
    found = {r.name.split(".")[0]: r for r in releases.download(wanted, str(tmp_path), wait=0.01).collect()}
    assert {n for n, r in found.items() if not r.ok} == {"gone", "bad"} and found["gone"].error == "HTTP 404" and found["bad"].error == "sha256"
    for n in ("plain", "part", "whole", "long", "busy"):
        assert (tmp_path / f"T/{n}.tar.gz.aa").read_bytes() == BODY
    assert found["part"].fetched_bytes == len(BODY) - 1000 and ("/part", 1000) in Handler.asked and found["there"].fetched_bytes == 0
    assert not [a for a in Handler.asked if a[0] == "/there"]


def test_local_parts(spark, tmp_path):
    for n in ("T.tar.gz.ab", "T.tar.gz.aa", "notes.rst"):
        (tmp_path / n).write_bytes(b"x")
    assert [p.rsplit("/", 1)[1] for p in releases.local_parts(spark, str(tmp_path), "*.tar.*")] == ["T.tar.gz.aa", "T.tar.gz.ab"]
    (tmp_path / "U.tar.gz.aa").write_bytes(b"x")
    with pytest.raises(ValueError):
        releases.local_parts(spark, str(tmp_path), "*.tar.*")


def test_dense_merge_is_the_sparse_one(spark):
    pixels = lambda seed, tiles: [(x, 0, p, (x * 31 + p * seed) % 7) for x in tiles for p in range(64)]
    a, b = (spark.createDataFrame(pixels(s, t), "x int, y int, pos int, value int").where("value > 0") for s, t in ((3, (0, 1)), (5, (1, 2))))
    dense = state.merge_dense(*(encoding.dense_records(encoding.sparse_records(d), 64) for d in (a, b)))
    sparse = state.merge_overlay(*(d.withColumnRenamed("value", "rgb24") for d in (a, b)))
    assert sorted(map(tuple, encoding.from_dense(dense).collect())) == sorted(map(tuple, sparse.collect()))


def test_stored_stats(spark):
    values = spark.range(200).select(F.lit(0).alias("x"), F.lit(0).alias("y"), F.col("id").cast("int").alias("pos"), F.lit(5).alias("value")).union(spark.createDataFrame([(1, 0, 3, 9)], "x int, y int, pos int, value int"))
    (r,) = shards.stored_stats(payloads.payloads(values, 256), 2).collect()
    assert (r.tiles, r.sparse, r.dense, r.zstd, r.none, r.visible_pixels, r.uncompressed_bytes, r.largest) == (2, 1, 1, 1, 1, 201, 261, 200) and r.stored_bytes < 261
