"""The whole run: archives of snapshots into the rolling state, and its export as images.

Control rows (tag, stage, at, error) are appended to a log; a snapshot that the log calls
applied is skipped, so a run that broke off goes on where it was.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, fields
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.colours import parse_colours
from tilewright.functions.names import shard_name, tag_time
from tilewright.operators import encoding, palette, payloads, shards, spatial, tags, transparency, validation
from tilewright.sources import png
from tilewright.sources.split_archive import SplitArchive, group_parts
from tilewright.sources.store import Store, append_log, file_system, image_names, load_toml, read_log, write_images, write_text, write_tiles
from tilewright.streaming.rolling import STATE, fold, latest

CONTROL = "tag string, stage string, at string, error string, config string"


class StageError(RuntimeError):
    """A stage failed; its name is in stage."""

    def __init__(self, stage: str, cause: Exception):
        super().__init__(f"{stage}: {type(cause).__name__}: {cause}")
        self.stage = stage


@dataclass(frozen=True)
class Config:
    """Settings by default, from a TOML file, and from the call, the later ones winning."""

    root: str = "work"
    grid_tiles: int = 2048
    tile_size: int = 1000
    shard_tiles: int = 32
    min_days: int = 7
    max_colours: int = 64
    rgb_mode: str = "corners"
    rgb_least_share: float = 0.9
    transparent_colours: list[int] = field(default_factory=list)
    black_warning: float = 0.7
    strict_rgba: bool = False
    zoom: int = 11

    @classmethod
    def load(cls, path: str | None = None, **given) -> Config:
        known = {f.name for f in fields(cls)}
        values = load_toml(path) if path else {}
        values |= {k: v for k, v in given.items() if v is not None}
        if unknown := set(values) - known:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        if isinstance(values.get("transparent_colours"), str):
            values["transparent_colours"] = parse_colours(values["transparent_colours"])
        return cls(**values)

    def data_hash(self) -> str:
        """A digest of the settings that shape the data."""
        shaping = {k: v for k, v in asdict(self).items() if k not in ("root", "zoom", "min_days", "black_warning")}
        return hashlib.sha256(json.dumps(shaping, sort_keys=True).encode()).hexdigest()


class Pipeline:
    """Snapshots whose archives lie in root/archives as <tag>.tar.<gz|zst>.<part>."""

    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.config = spark, config
        self.store = Store(spark, f"{config.root}/state", config.shard_tiles, config.tile_size**2)
        spark.dataSource.register(SplitArchive)

    # control

    def control(self) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.config.root}/control")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], CONTROL)
        return read_log(self.spark, f"{self.config.root}/control", CONTROL)

    def _note(self, tag: str, stage: str, error: str | None = None) -> None:
        row = (tag, stage, datetime.now(UTC).isoformat(), error, self.config.data_hash())
        append_log(self.spark.createDataFrame([row], CONTROL), f"{self.config.root}/control")

    def applied(self) -> DataFrame:
        return self.control().where("stage = 'applied'").select("tag").distinct()

    def failed(self) -> DataFrame:
        """The last failure of each snapshot that hasn't been applied since."""
        last = self.control().groupBy("tag").agg(F.max_by(F.struct("stage", "error"), "at").alias("last"), F.max("at").alias("at"))
        return last.where("last.error is not null").select("tag", "last.stage", "last.error", "at")

    # stages

    def archives(self) -> DataFrame:
        """tag, tag_ts, paths of the archives at hand."""
        files = self.spark.read.format("binaryFile").load(f"{self.config.root}/archives/*").select("path")
        paths = [r["path"].removeprefix("file:") for r in files.collect()]  # a row for each part
        rows = [(name, ",".join(found)) for (name, _), found in group_parts(paths).items()] if paths else []
        return self.spark.createDataFrame(rows, "tag string, paths string").withColumn("tag_ts", tag_time(F.col("tag"))).where("tag_ts is not null")

    def selected(self, first: datetime | None = None, last: datetime | None = None, limit: int | None = None) -> DataFrame:
        known = self.archives()
        chosen = tags.select_tags(known.select("tag_ts"), self.config.min_days, first, last, limit)
        return known.join(chosen, "tag_ts")

    def members(self, tag: str, tag_ts: datetime, paths: str) -> DataFrame:
        """The encoded tiles of a snapshot."""
        tiles = self.spark.read.format("split_archive").option("paths", paths).option("grid", str(self.config.grid_tiles)).load()
        return tiles.repartition("x", "y").withColumn("tag", F.lit(tag)).withColumn("tag_ts", F.lit(tag_ts).cast("timestamp_ntz"))

    def overlay(self, tag: str, tag_ts: datetime, paths: str) -> DataFrame:
        """All pixels of a snapshot: tag_ts, x, y, event_id (place in the archive), mode, pos, rgb24, alpha."""
        c = self.config
        found = png.decode_pixels(self.members(tag, tag_ts, paths), c.tile_size, c.strict_rgba).withColumnRenamed("ordinal", "event_id")
        with_alpha, without = found.where("mode <> 'RGB' or trns"), found.where("mode = 'RGB' and not trns")
        marked = transparency.rgb_transparency(without, c.tile_size, c.rgb_mode, c.rgb_least_share, c.transparent_colours)
        marked = marked.withColumn("alpha", F.when(F.col("transparent"), 0).otherwise(F.col("alpha"))).drop("transparent")
        return with_alpha.unionByName(marked)

    def ingest(self, tag: str, tag_ts: datetime, paths: str) -> DataFrame:
        """Decodes a snapshot once, into a table: its visible pixels, and a row (pos -1) for each tile."""
        c = self.config
        found = png.decode_visible(self.members(tag, tag_ts, paths), c.tile_size, c.strict_rgba, c.rgb_mode, c.rgb_least_share, tuple(c.transparent_colours), c.black_warning)
        path = f"{c.root}/overlays/{tag}"
        found.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        return self.spark.read.schema(found.schema).parquet(path)

    def ingest_stats(self, tag: str, overlay: DataFrame) -> dict:
        """Sums over the tiles of a decoded snapshot."""
        is_p, is_rgb = F.col("mode") == "P", F.col("mode") == "RGB"
        sums = overlay.where("pos = -1").agg(
            F.count("*").alias("png_tiles_seen"),
            F.count_if(F.col("visible") > 0).alias("records_written"),
            F.coalesce(F.sum("visible"), F.lit(0)).alias("visible_pixels"),
            F.count_if(is_rgb).alias("rgb_tiles_seen"),
            F.count_if(is_p).alias("p_tiles_seen"),
            F.count_if(is_p & F.col("trns")).alias("p_has_trns"),
            F.count_if(is_p & ~F.col("trns")).alias("p_no_trns"),
            F.count_if((F.col("mode") == "RGBA") & F.col("warning")).alias("rgba_black_warning_tiles"),
            F.count_if(is_rgb & (F.col("black") >= self.config.black_warning * self.config.tile_size**2)).alias("rgb_black_dominant_tiles"),
        )
        return {"tag": tag, **sums.first().asDict()}

    def saved_palette(self) -> DataFrame:
        """index, rgb24, hex of all colours that were ever visible, as stored; new ones are appended."""
        path = f"{self.config.root}/palette"
        fs, found = file_system(self.spark, path)
        schema = "index int, rgb24 int, hex string"
        return self.spark.read.schema(schema).json(path) if fs.exists(found) else self.spark.createDataFrame([], schema)

    def _save_palette(self, rows: list) -> None:
        """Replaces the stored palette, at most max_colours rows, in one step."""
        lines = [json.dumps({"index": r["index"], "rgb24": r["rgb24"], "hex": f"#{r['rgb24']:06x}"}) for r in sorted(rows, key=lambda r: r["index"])]
        write_text(self.spark, f"{self.config.root}/palette", "\n".join(lines) + "\n")

    def _save_stats(self, name: str, stats: dict) -> None:
        write_text(self.spark, f"{self.config.root}/stats/{name}.json", json.dumps(stats, indent=1, sort_keys=True, default=str))

    def apply(self, tag: str, tag_ts: datetime, paths: str) -> None:
        """Decodes a snapshot, extends the palette and replaces the shards that it touches."""
        stage = "ingest"
        try:
            overlay = self.ingest(tag, tag_ts, paths)
            self._save_stats(f"ingest_{tag}", self.ingest_stats(tag, overlay))
            visible = overlay.where("pos >= 0")
            stage = "palette"
            colours = palette.checked(palette.build(visible, self.saved_palette()), self.config.max_colours).collect()
            self._save_palette(colours)
            stage = "apply"
            new = latest(visible)
            touched = self.store.touched(new)
            self.store.upsert(new, fold, STATE)
            sums = [F.coalesce(F.sum(c), F.lit(0)).alias(f"state_{c.removesuffix('_count') + 's' if c == 'tile_count' else c}") for c in ("tile_count", "visible_pixels", "stored_bytes", "uncompressed_bytes")]
            self._save_stats(f"apply_{tag}", {"tag": tag, "applied_shards": len(touched), **self.store.manifest().agg(*sums).first().asDict()})
        except Exception as e:
            self._note(tag, stage, f"{type(e).__name__}: {e}"[:2000])
            raise StageError(stage, e) from e
        self._note(tag, "applied")
        fs, path = file_system(self.spark, f"{self.config.root}/overlays/{tag}")
        fs.delete(path, True)

    def run(self, first: datetime | None = None, last: datetime | None = None, limit: int | None = None, export: bool = True) -> list[str]:
        """Applies the selected snapshots that the log doesn't call applied, in order; returns their names."""
        todo = self.selected(first, last, limit).join(self.applied(), "tag", "left_anti").orderBy("tag_ts").collect()  # a row for each snapshot
        for row in todo:
            self.apply(row["tag"], row["tag_ts"], row["paths"])
        if export and (todo or not self.store.versions()):
            self.export(f"{self.config.root}/export")
        return [row["tag"] for row in todo]

    # results

    def state(self) -> DataFrame:
        return self.store.read(STATE)

    def palette(self) -> DataFrame:
        return palette.build(self.state().withColumn("alpha", F.lit(255)))

    def tiles(self) -> DataFrame:
        """The stored tile index."""
        return self.store.tiles()

    def manifest(self) -> DataFrame:
        """The stored manifest."""
        return self.store.manifest()

    def validate(self, deep: bool = False) -> DataFrame:
        """Violations of the stored index, manifest, palette and files; also settings that changed since it was begun.

        deep: the index is compared with the pixels too.
        """
        c = self.config
        gone = self.store.missing()
        found = gone.select(F.concat(F.lit("missing "), F.col("kind")).alias("rule"), F.col("name").alias("item"))
        if gone.isEmpty():
            found = found.unionByName(validation.violations(self.tiles(), self.manifest(), c.grid_tiles, c.tile_size**2))
            found = found.unionByName(validation.index_violations(self.tiles(), self.manifest(), c.shard_tiles, c.tile_size**2))
            if deep:
                found = found.unionByName(validation.recounted(self.tiles(), self.state(), c.tile_size**2))
        known = self.saved_palette()
        found = found.unionByName(palette.contiguity(known.select("index", "rgb24")).select(F.lit("palette index").alias("rule"), F.col("index").cast("string").alias("item")))
        other = self.control().where(F.col("config") != c.data_hash()).select(F.lit("other settings").alias("rule"), F.col("tag").alias("item")).distinct()
        return found.unionByName(other)

    def records(self, folder: str) -> int:
        """Writes the state as compressed records by shard, their values indexes of the saved palette; returns their number."""
        values = palette.encode(self.state().withColumn("alpha", F.lit(255)), self.saved_palette(), self.config.max_colours)
        stored = shards.in_shards(payloads.payloads(values, self.config.tile_size**2), self.config.shard_tiles)
        stored.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("sx", "sy").parquet(folder)
        return self.spark.read.parquet(folder).count()

    def artworks(self, folder: str, grow: int = 3, least_pixels: int = 20, per_folder: int = 5000, skip_existing: bool = True) -> dict:
        """Writes an image of each drawing that isn't there yet, per_folder to a numbered folder; returns and saves the sums."""
        labelled = spatial.components(spatial.world(self.state(), self.config.tile_size), grow)
        found = spatial.artworks(spatial.component_stats(labelled), least_pixels)
        kept = found.where("skip_reason is null")
        there = image_names(self.spark, folder)
        new = tags.without_existing(kept, there) if skip_existing else kept
        images = spatial.crops(labelled, new)
        before = there.agg(F.coalesce(F.max("bucket"), F.lit(-1))).first()[0] + 1
        dealt = shards.buckets(images.select("name").distinct(), per_folder, "name").withColumnRenamed("name", "b_name")
        placed = images.join(dealt, F.col("name") == F.col("b_name")).select((F.col("bucket") + before).alias("bucket"), "name", "content")
        done = write_images(placed, folder).agg(F.count("*").alias("images"), F.coalesce(F.sum("png_bytes"), F.lit(0)).alias("png_bytes")).first().asDict()
        stats = {**spatial.totals(found).first().asDict(), "kept": kept.count(), "existing": kept.count() - new.count() if skip_existing else 0, **done}
        self._save_stats("artworks", stats)
        return stats

    def inspect(self, tag: str, samples: int = 20) -> dict:
        """Modes of a snapshot's images, transparency of those with a palette, and the first paths of each kind, from headers alone."""
        row = self.archives().where(F.col("tag") == tag).first()
        report = png.mode_report(self.members(tag, row["tag_ts"], row["paths"])).persist()
        kind = F.when(F.col("mode") != "P", F.col("mode")).when(F.col("trns"), "has_trns").when(F.size("black_entries") > 0, "no_trns_black_palette").otherwise("no_trns_no_black_palette")
        modes = {r["mode"]: r["n"] for r in tags.class_histogram(report, "mode").collect()}
        kinds = {r["kind"]: r["n"] for r in tags.class_histogram(report.withColumn("kind", kind), "kind").collect()}
        black = {r["entry"]: r["n"] for r in tags.class_histogram(report.where("mode = 'P'").select(F.explode("black_entries").alias("entry")), "entry").collect()}
        first: dict = {}
        order = F.struct("x", "y")
        for r in tags.first_samples(report.withColumn("kind", kind), "kind", order, samples).orderBy("kind", "nth").collect():
            first.setdefault(r["kind"], []).append(f"{r['x']}/{r['y']}.png")
        report.unpersist()
        out = {"total_png": sum(modes.values()), "modes": modes, "kinds": kinds, "black_index_counter": black, "samples": first}
        self._save_stats(f"inspect_{tag}", out)
        return out

    def probe(self, tag: str) -> DataFrame:
        """What applying a snapshot would do to each shard: its tiles and pixels before, overlaid and after, and ok."""
        row = self.archives().where(F.col("tag") == tag).first()
        c = self.config
        new = latest(png.decode_visible(self.members(tag, row["tag_ts"], row["paths"]), c.tile_size, c.strict_rgba, c.rgb_mode, c.rgb_least_share, tuple(c.transparent_colours)).where("pos >= 0"))
        tiles = validation.dry_run(self.state(), new)
        sums = [F.sum(k).cast("long").alias(k) for k in ("before", "overlaid", "after")]
        found = shards.in_shards(tiles, c.shard_tiles).groupBy("sx", "sy").agg(F.count("*").alias("tiles"), *sums, F.bool_and((F.col("after") <= c.tile_size**2) & (F.col("after") >= F.col("before"))).alias("ok"))
        return found.withColumn("name", shard_name(F.col("sx"), F.col("sy")))

    def pending_probes(self, tag: str, report: str) -> DataFrame:
        """The shards of probe() that a report doesn't call ok yet."""
        fs, path = file_system(self.spark, report)
        if not fs.exists(path):
            return self.probe(tag)
        ok = read_log(self.spark, report, "name string, ok boolean").where("ok").select("name").distinct()
        return self.probe(tag).join(ok, "name", "left_anti")

    def diagnose(self, tag: str, n: int = 20) -> DataFrame:
        """The black-pixel summaries of a snapshot's first tiles without alpha."""
        row = self.archives().where(F.col("tag") == tag).first()
        pixels = self.overlay(row["tag"], row["tag_ts"], row["paths"])
        return transparency.black_summary(pixels, self.config.black_warning).orderBy("x", "y").limit(n)

    def diagnostics(self, tag: str, folder: str, n: int = 20) -> dict:
        """Writes n tiles without alpha of a snapshot as they are and as they are read, and their sums, to a folder."""
        row = self.archives().where(F.col("tag") == tag).first()
        chosen = png.mode_report(self.members(tag, row["tag_ts"], row["paths"])).where("mode = 'RGB'").orderBy("x", "y").limit(n).select("x", "y")
        some = self.members(tag, row["tag_ts"], row["paths"]).join(F.broadcast(chosen), ["x", "y"])  # n rows
        c = self.config
        read = png.decode_visible(some, c.tile_size, c.strict_rgba, c.rgb_mode, c.rgb_least_share, tuple(c.transparent_colours), c.black_warning).persist()
        name = F.concat_ws("_", "x", "y")
        as_is = some.select(F.lit(0).alias("bucket"), F.concat(name, F.lit("_original.png")).alias("name"), "content")
        seen = png.encode_tiles(read.where("pos >= 0"), c.tile_size).select(F.lit(0).alias("bucket"), F.concat(name, F.lit("_inferred.png")).alias("name"), "content")
        written = write_images(as_is.unionByName(seen), folder).count()
        samples = [r.asDict() for r in read.where("pos = -1").select("x", "y", "visible", "black", "warning").orderBy("x", "y").collect()]  # n rows
        read.unpersist()
        out = {"rgb_samples": len(samples), "images": written, "samples": samples}
        write_text(self.spark, f"{folder}/diagnostics.json", json.dumps(out, indent=1, sort_keys=True))
        return out

    def export(self, folder: str) -> tuple[int, int]:
        """Writes the state's tiles as images; returns their number and bytes."""
        images = png.encode_tiles(self.state(), self.config.tile_size)
        done = write_tiles(images, folder, self.config.zoom).agg(F.count("*").alias("n"), F.coalesce(F.sum("png_bytes"), F.lit(0)).alias("b")).first()
        return done["n"], done["b"]
