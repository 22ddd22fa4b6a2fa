"""The registered queries: each operator over the whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import colours, names
from tilewright.operators import encoding, palette, payloads, shards, spatial, state, tags, transparency, validation
from tilewright.sources.tables import GRID, SHARD_TILES, TILE_PIXELS, TILE_SIZE, pixels, table

Query = Callable[[SparkSession, str], DataFrame]
_FOUND: dict[str, Query] = {}

#: Parameters of the queries over the synthetic tables (plans/oracle.py has the same).
AS_OF = datetime(2024, 1, 15)
THIN_DAYS = 10
FIRST, LAST, RANGE_DAYS, RANGE_LIMIT = datetime(1996, 1, 1), datetime(1998, 12, 31), 14, 50
EXPLICIT = [419430, 4194300]


def query(f: Query) -> Query:
    _FOUND[f.__name__] = f
    return f


def _overlay_tiles(spark, d) -> DataFrame:
    return encoding.tiles(state.tag_overlay(pixels(spark, d)), TILE_PIXELS, "tag_ts")


def _state_tiles(spark, d) -> DataFrame:
    return encoding.tiles(state.rolling_state(pixels(spark, d)), TILE_PIXELS)


def _days(spark, d) -> DataFrame:
    return pixels(spark, d).select("tag_ts").distinct()


def _labelled(spark, d, grow: int) -> DataFrame:
    """The pixels of the whole rolling state with their drawing."""
    return spatial.components(spatial.world(state.rolling_state(pixels(spark, d)), TILE_SIZE), grow)


def _letters(k) -> Column:
    """A number as three letters, aaa on."""
    return F.concat(*(F.char((F.lit(97) + F.floor(k / step) % 26).cast("int")) for step in (676, 26, 1)))


@query
def rolling_state(spark, d):
    return state.rolling_state(pixels(spark, d))


@query
def state_as_of(spark, d):
    return state.state_as_of(pixels(spark, d), AS_OF)


@query
def rolling_state_incremental(spark, d):
    px = pixels(spark, d)
    cut = F.lit(AS_OF).cast("timestamp_ntz")
    return state.merge_overlay(state.rolling_state(px.where(F.col("tag_ts") <= cut)), state.rolling_state(px.where(F.col("tag_ts") > cut)))


@query
def tag_overlay(spark, d):
    return state.tag_overlay(pixels(spark, d))


@query
def keep_last_tile(spark, d):
    return state.keep_last_tile(pixels(spark, d).select("tag_ts", "x", "y", "event_id"), "event_id")


@query
def pixel_deltas(spark, d):
    return state.pixel_deltas(pixels(spark, d))


@query
def composite(spark, d):
    """Every event a layer; values of the table as alpha."""
    layers = pixels(spark, d).join(table(spark, d, "events").select("event_id", F.least(F.lit(255), F.floor(F.abs("value")) % 256).cast("int").alias("a")), "event_id")
    return state.composite_over(layers.select("event_id", "x", "y", "pos", "rgb24", "a"), "a")


@query
def alpha_over(spark, d):
    px = pixels(spark, d)
    a, b = F.col("event_id") % 256, F.floor(F.col("event_id") / 7) % 256
    below, above = F.col("pos"), F.col("rgb24") % 256
    return px.select(
        "event_id", colours.over_alpha(a, b).alias("out_alpha"), colours.over_channel(above, a, below, b).alias("out_channel")
    )


@query
def tag_thinning(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderdate").cast("timestamp_ntz").alias("tag_ts"))
    return tags.thin(orders, THIN_DAYS)


@query
def tag_range_thinning(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderdate").cast("timestamp_ntz").alias("tag_ts"))
    return tags.select_tags(orders, RANGE_DAYS, FIRST, LAST, RANGE_LIMIT)


@query
def tag_names_parse(spark, d):
    named = _days(spark, d).select(names.tag_name(F.col("tag_ts")).alias("tag"))
    return named.withColumn("parsed", names.tag_time(F.col("tag")))


@query
def tag_lines(spark, d):
    lines = _days(spark, d).select(F.explode(F.array(F.concat(F.lit("0000 refs/tags/"), names.tag_name(F.col("tag_ts"))), F.concat(F.lit("0000 refs/tags/"), names.tag_name(F.col("tag_ts")), F.lit("^{}")), F.lit("0000 refs/tags/other"))).alias("line"))
    return tags.parse_tags(lines)


@query
def palette_build(spark, d):
    return palette.build(pixels(spark, d))


@query
def palette_extend(spark, d):
    """The first half of the snapshots' palette, extended by the others' colours."""
    px = pixels(spark, d)
    cut = F.lit(AS_OF).cast("timestamp_ntz")
    known = palette.build(px.where((F.col("tag_ts") <= cut) & (F.col("rgb24") % 838860 == 0)))
    return palette.build(px, known)


@query
def palette_encode(spark, d):
    px = pixels(spark, d)
    return palette.encode(px, palette.build(px)).select("event_id", "x", "y", "pos", "value")


@query
def palette_decode(spark, d):
    px = pixels(spark, d)
    built = palette.build(px)
    return palette.decode(palette.encode(px, built).select("event_id", "value"), built)


@query
def palette_unknown(spark, d):
    px = pixels(spark, d)
    return palette.unknown(px, palette.build(px.where("rgb24 % 838860 = 0")))


@query
def palette_overflow_check(spark, d):
    return palette.overflow(pixels(spark, d), 39)


@query
def palette_contiguity(spark, d):
    return palette.contiguity(palette.build(pixels(spark, d)).where("index <> 3").select("index", "rgb24"))


@query
def palette_hex(spark, d):
    built = palette.build(pixels(spark, d))
    c = F.col("rgb24")
    return built.select("rgb24", colours.from_hex(F.col("hex")).alias("again"), colours.rgb24(colours.red(c), colours.green(c), colours.blue(c)).alias("packed"))


@query
def rgb_transparency(spark, d):
    marked = transparency.rgb_transparency(pixels(spark, d), TILE_SIZE, "corners", 0.05)
    return transparency.transparent_share(marked, F.col("transparent"))


@query
def rgb_transparency_none(spark, d):
    marked = transparency.rgb_transparency(pixels(spark, d), TILE_SIZE, "none")
    return transparency.transparent_share(marked, F.col("transparent"))


@query
def explicit_colors(spark, d):
    marked = transparency.rgb_transparency(pixels(spark, d), TILE_SIZE, "none", explicit=EXPLICIT)
    return transparency.transparent_share(marked, F.col("transparent"))


@query
def rgba_black_warning(spark, d):
    found = transparency.black_summary(pixels(spark, d), 0.05)
    return found.withColumn("ratio", F.floor(F.col("ratio") * 1000000.0))


@query
def partial_alpha(spark, d):
    px = pixels(spark, d).withColumn("alpha", F.when(F.col("event_id") % 97 == 0, 128).otherwise(F.col("alpha")))
    return transparency.partial_alpha(px)


@query
def tile_encoding(spark, d):
    return _overlay_tiles(spark, d)


@query
def sparse_records(spark, d):
    px = pixels(spark, d)
    encoded = palette.encode(state.rolling_state(px).withColumn("alpha", F.lit(255)), palette.build(px))
    records = encoding.sparse_records(encoded)
    return records.select("x", "y", F.posexplode("record").alias("nth", "item")).select("x", "y", "nth", F.col("item.pos").alias("pos"), F.col("item.v").alias("value"))


@query
def dense_roundtrip(spark, d):
    px = pixels(spark, d)
    encoded = palette.encode(state.rolling_state(px).withColumn("alpha", F.lit(255)), palette.build(px))
    return encoding.from_dense(encoding.dense_records(encoding.sparse_records(encoded), TILE_PIXELS))


def _state_payloads(spark, d) -> DataFrame:
    px = pixels(spark, d)
    return payloads.payloads(palette.encode(state.rolling_state(px).withColumn("alpha", F.lit(255)), palette.build(px)), TILE_PIXELS)


@query
def payload_sizes(spark, d):
    return _state_payloads(spark, d).select("x", "y", "count", "encoding", "uncompressed_size")


@query
def payload_roundtrip(spark, d):
    return payloads.from_payloads(_state_payloads(spark, d), TILE_PIXELS)


@query
def shard_manifest(spark, d):
    return shards.manifest(_state_tiles(spark, d), SHARD_TILES)


@query
def store_rollup(spark, d):
    return shards.rollup(_state_tiles(spark, d), SHARD_TILES)


@query
def largest_shards(spark, d):
    return shards.largest(shards.manifest(_state_tiles(spark, d), SHARD_TILES).select("name", "stored_bytes"))


@query
def shard_schedule(spark, d):
    return shards.schedule(shards.manifest(_state_tiles(spark, d), SHARD_TILES).select("name", "stored_bytes"))


@query
def byte_chunks(spark, d):
    return shards.byte_chunks(_state_tiles(spark, d), 600, SHARD_TILES)


@query
def dir_buckets(spark, d):
    return shards.buckets(table(spark, d, "supplier").select("s_suppkey"), 7, "s_suppkey")


@query
def shard_upsert(spark, d):
    whole = shards.manifest(_state_tiles(spark, d), SHARD_TILES).select("name", "visible_pixels")
    new = whole.where("visible_pixels % 2 = 0").withColumn("visible_pixels", F.col("visible_pixels") + 1000)
    return shards.upsert_meta(whole, new)


@query
def shard_names(spark, d):
    found = shards.manifest(_state_tiles(spark, d), SHARD_TILES).select("name")
    sx, sy = names.shard_from_name(F.col("name"))
    return found.select("name", sx.alias("sx"), sy.alias("sy"))


@query
def validate_state(spark, d):
    """A damaged copy of the state's tiles against the rules."""
    tiles = _state_tiles(spark, d).withColumn("x", F.when(F.col("y") == 7, F.col("x") + 5).otherwise(F.col("x"))).withColumn("encoding", F.when((F.col("x") == 1) & (F.col("y") == 1), "rle").otherwise(F.col("encoding")))
    return validation.violations(tiles, shards.manifest(_state_tiles(spark, d), SHARD_TILES), GRID, TILE_PIXELS)


@query
def payload_checks(spark, d):
    px = pixels(spark, d).select("x", "y", "pos", (F.col("rgb24") / 419430).cast("int").alias("value"))
    return validation.payload_violations(px, 200)


@query
def missing_shards(spark, d):
    whole = shards.manifest(_state_tiles(spark, d), SHARD_TILES)
    return validation.missing_shards(whole, whole.where("sx <> sy"))


@query
def dry_run(spark, d):
    px = pixels(spark, d)
    cut = F.lit(AS_OF).cast("timestamp_ntz")
    return validation.dry_run(state.rolling_state(px.where(F.col("tag_ts") <= cut)), state.rolling_state(px.where(F.col("tag_ts") > cut)))


def _tag_sets(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderdate").cast("timestamp_ntz").alias("tag_ts"))
    return tags.thin(orders, 5), tags.thin(orders, THIN_DAYS)


@query
def pending_tags(spark, d):
    return tags.pending(*_tag_sets(spark, d))


@query
def applied_tags_semi(spark, d):
    return tags.done(*_tag_sets(spark, d))


@query
def tag_intersect(spark, d):
    a, b = _tag_sets(spark, d)
    return a.intersect(b)


@query
def tag_union(spark, d):
    a, b = _tag_sets(spark, d)
    return a.union(b).distinct()


@query
def tag_except(spark, d):
    a, b = _tag_sets(spark, d)
    return a.subtract(b)


@query
def asset_select(spark, d):
    """Names of both codecs with suffixes of two and three letters, notes and a checksum among them."""
    k = F.col("s_suppkey")
    suffix = F.when(k % 10 == 0, "txt").when(k % 10 == 1, "json").when(k % 10 == 2, "sha256").otherwise(_letters(k))
    name = F.concat(F.lit("T.tar."), F.when(k % 2 == 0, "gz").otherwise("zst"), F.lit("."), suffix)
    return tags.select_parts(table(spark, d, "supplier").select(name.alias("name")))


@query
def split_sort(spark, d):
    """Parts of numbers and of letters of several archives."""
    k = F.col("s_suppkey")
    name = F.concat(F.when(k % 2 == 0, "T").otherwise("s"), (k % 7).cast("string"), F.lit(".tar.gz."), F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, F.upper(_letters(k))).otherwise(F.concat(F.lit("z"), _letters(k))))
    return tags.sort_parts(table(spark, d, "supplier").select(name.alias("name")))


@query
def natural_keys(spark, d):
    return table(spark, d, "customer").select("c_custkey", names.natural_key(F.concat(F.lit("Tile "), F.col("c_custkey").cast("string"), F.lit("b"))).alias("key"))


@query
def tile_path_parse(spark, d):
    path = F.concat(F.lit("a\\"), (F.col("s_suppkey") % 9).cast("string"), F.lit("/"), F.col("s_suppkey").cast("string"), F.when(F.col("s_suppkey") % 5 == 0, ".txt").when(F.col("s_suppkey") % 5 == 1, ".PNG").otherwise(".png"))
    found = table(spark, d, "supplier").select("s_suppkey", path.alias("path"))
    return found.select("s_suppkey", names.tile_x(F.col("path")).alias("x"), names.tile_y(F.col("path")).alias("y")).where("x is not null")


@query
def mode_histogram(spark, d):
    return tags.class_histogram(table(spark, d, "events"), "event_type")


@query
def mode_samples(spark, d):
    return tags.first_samples(table(spark, d, "events").select("event_type", "event_id"), "event_type", "event_id", 20)


@query
def ingest_stats(spark, d):
    px = pixels(spark, d)
    return px.groupBy("tag_ts").agg(F.count("*").alias("pixels"), F.count_if(F.expr("alpha <> 0")).alias("visible"), F.count_distinct("x", "y").alias("tiles"))


@query
def neighbor_mosaic(spark, d):
    return spatial.neighbour_mosaic(_state_tiles(spark, d))


@query
def components_d0(spark, d):
    return _labelled(spark, d, 0).select("wx", "wy", "component")


@query
def components_d3(spark, d):
    return _labelled(spark, d, 3).select("wx", "wy", "component")


@query
def artworks(spark, d):
    return spatial.artworks(spatial.component_stats(_labelled(spark, d, 0)), 2).drop("component")


@query
def digest_check(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))


@query
def digest_names(spark, d):
    digest = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("md5:"), F.md5(F.coalesce("text", F.lit(""))))).otherwise(F.concat(F.lit("SHA256:"), F.upper(F.sha2(F.coalesce("text", F.lit("")), 256))))
    return table(spark, d, "documents").select("doc_id", names.sha256_of_digest(digest).alias("digest"))


@query
def hit_rate(spark, d):
    found = table(spark, d, "events").groupBy("user_id").agg(F.count_if(F.expr("event_type = 'click'")).alias("hits"), F.count_if(F.expr("event_type = 'view'")).alias("misses"))
    return found.select("user_id", F.floor(names.hit_rate(F.col("hits"), F.col("misses")) * 1000000.0).alias("rate_millionths"))


@query
def byte_sizes(spark, d):
    return table(spark, d, "documents").select("doc_id", names.human_bytes(F.octet_length(F.coalesce("text", F.lit(""))).cast("long") * 1000).alias("size"))


@query
def shard_lists(spark, d):
    text = F.concat(F.lit(" s0001_0002;,"), F.format_string("s%04d_%04d", F.col("n_nationkey").cast("int"), F.col("n_regionkey").cast("int")), F.lit(" ;"))
    return table(spark, d, "nation").select("n_nationkey", F.explode(names.shard_list(text)).alias("name"))


@query
def run_totals(spark, d):
    return spatial.totals(spatial.artworks(spatial.component_stats(_labelled(spark, d, 0)), 2))


@query
def dilation(spark, d):
    return spatial.dilate(spatial.world(state.rolling_state(pixels(spark, d)), TILE_SIZE), 1)


@query
def shard_discovery(spark, d):
    whole = shards.manifest(_state_tiles(spark, d), SHARD_TILES)
    return shards.discover(whole.where("sx < 2"), whole.where("sy > 1"))


@query
def shard_encodings(spark, d):
    return shards.encoding_stats(_state_tiles(spark, d), SHARD_TILES)


@query
def slowest_tiles(spark, d):
    return tags.slowest(table(spark, d, "events").select("event_id", F.round("value", 2).alias("ms")), "ms", 10, "event_id")


@query
def new_outputs(spark, d):
    found = table(spark, d, "supplier").select(names.artwork_name(F.col("s_suppkey"), F.col("s_suppkey"), F.lit(1), F.lit(2)).alias("name"))
    return tags.without_existing(found, found.where(names.is_png(F.col("name")) & F.col("name").contains("_x1")))


@query
def throughput(spark, d):
    took = F.when(F.col("doc_id") % 7 == 0, 0.0).otherwise(F.col("doc_id") / 4.0)
    return table(spark, d, "documents").select("doc_id", F.floor(names.mib_per_second(F.octet_length(F.coalesce("text", F.lit(""))) * 1024, took) * 1000000.0).alias("mib_s_millionths"))


@query
def replaced_tiles(spark, d):
    """Images whose size isn't that of the one before."""
    events = table(spark, d, "events")
    w, h = F.col("event_id") % 3, F.col("user_id") % 3
    return events.where(~names.same_size(w, h, F.lit(1), F.lit(1))).select("event_id")


def queries() -> dict[str, Query]:
    return dict(_FOUND)
