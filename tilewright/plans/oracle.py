"""DuckDB SQL for the registered queries, with the parameters of plans/catalogue.py."""

from __future__ import annotations

_PX = r"""px AS (
  SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS tag_ts, CAST(user_id % 8 AS INT) AS x, CAST((user_id // 8) % 8 AS INT) AS y,
    CAST(event_id % 256 AS INT) AS pos, CAST(CAST(regexp_extract(props, '"k": (\d+)', 1) AS INT) % 40 * 419430 AS INT) AS rgb24,
    CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 255 END AS INT) AS alpha
  FROM events)"""
_OVERLAY = "overlay AS (SELECT tag_ts, x, y, pos, arg_max(rgb24, event_id) AS rgb24 FROM px WHERE alpha <> 0 GROUP BY ALL)"
_STATE = "state AS (SELECT x, y, pos, arg_max(rgb24, tag_ts) AS rgb24 FROM overlay GROUP BY ALL)"
_PALETTE = "palette AS (SELECT CAST(row_number() OVER (ORDER BY rgb24) AS INT) AS index, rgb24 FROM (SELECT DISTINCT rgb24 FROM px WHERE alpha <> 0))"
_TILES = """tiles AS (SELECT x, y, count(*) AS count, CASE WHEN count(*) * 5 < 256 THEN 'sparse' ELSE 'dense' END AS encoding,
  least(count(*) * 5, 256) AS stored_bytes FROM state GROUP BY x, y)"""
_SHARDS = """shards AS (SELECT CAST(x // 2 AS INT) AS sx, CAST(y // 2 AS INT) AS sy, count(*) AS tile_count, CAST(sum(count) AS BIGINT) AS visible_pixels,
  CAST(sum(stored_bytes) AS BIGINT) AS stored_bytes, printf('s%04d_%04d', x // 2, y // 2) AS name FROM tiles GROUP BY x // 2, y // 2)"""
_CUT = "TIMESTAMP '2024-01-15 00:00:00'"
_WORLD = """world AS (SELECT CAST(y AS BIGINT) * 16 + pos // 16 AS wy, CAST(x AS BIGINT) * 16 + pos % 16 AS wx, rgb24,
  ((CAST(y AS BIGINT) * 16 + pos // 16) << 31) | (CAST(x AS BIGINT) * 16 + pos % 16) AS id FROM state)"""
_LETTERS = "(chr(CAST(97 + s_suppkey // 676 % 26 AS INT)) || chr(CAST(97 + s_suppkey // 26 % 26 AS INT)) || chr(CAST(97 + s_suppkey % 26 AS INT)))"
_TAGS = "times AS (SELECT DISTINCT CAST(o_orderdate AS TIMESTAMP) AS t FROM orders)"


def _with(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


def _thin(name: str, days: int, source: str = "times") -> str:
    return f"""{name} AS (SELECT min(t) AS tag_ts FROM {source}
  UNION ALL SELECT (SELECT min(t) FROM {source} WHERE t >= {name}.tag_ts + INTERVAL {days} DAY) FROM {name}
  WHERE EXISTS (SELECT 1 FROM {source} WHERE t >= {name}.tag_ts + INTERVAL {days} DAY))"""


def _mixed(shift: int) -> str:
    """A channel of layer p over layer q."""
    weight = "(q.a * (255 - p.a) / 255.0::DOUBLE)"
    return f"""(CASE WHEN p.a + {weight} > 0 THEN least(255, greatest(0, floor((((p.c >> {shift}) & 255) * p.a + ((q.c >> {shift}) & 255) * {weight}) / (p.a + {weight}) + 0.5::DOUBLE)))::BIGINT ELSE 0::BIGINT END)"""


def _transparent(condition: str) -> str:
    return f"SELECT tag_ts, x, y, count(*) AS pixels, count(*) FILTER (WHERE {condition}) AS transparent FROM px GROUP BY ALL"


def _key(field: str, size: int = 1) -> str:
    return f"regexp_extract(name, '(?i)^(.+?)\\.tar\\.(gz|zst|zstd)\\.([A-Za-z]+|\\d+)$', {field})"


def oracle_sql() -> dict[str, str]:
    base = _with(_PX, _OVERLAY, _STATE)
    tiled = _with(_PX, _OVERLAY, _STATE, _TILES, _SHARDS)
    as_of = f"SELECT x, y, pos, arg_max(rgb24, tag_ts) AS rgb24 FROM overlay WHERE tag_ts <= {_CUT} GROUP BY ALL"
    encoded = _with(_PX, _OVERLAY, _STATE, _PALETTE)
    sets = _with(_TAGS, _thin("a", 5), _thin("b", 10), recursive=True)
    over_a = "floor(a + b * (255 - a) / 255.0::DOUBLE + 0.5::DOUBLE)"
    suffix = "list_reduce(list_prepend(0::BIGINT, list_transform(string_split(lower(suffix), ''), lambda c: (ascii(c) - 97)::BIGINT)), lambda p, q: p * 26 + q)"
    out = {
        "rolling_state": base + "SELECT * FROM state",
        "rolling_state_incremental": base + "SELECT * FROM state",
        "state_as_of": base + as_of,
        "tag_overlay": base + "SELECT * FROM overlay",
        "keep_last_tile": _with(_PX) + "SELECT tag_ts, x, y, max(event_id) AS event_id FROM px GROUP BY ALL",
        "pixel_deltas": _with(
            _PX,
            "seen AS (SELECT tag_ts, x, y, pos, max(CASE WHEN alpha <> 0 THEN 1 ELSE 0 END) AS now FROM px GROUP BY ALL)",
            "run AS (SELECT *, coalesce(max(now) OVER (PARTITION BY x, y, pos ORDER BY tag_ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS had FROM seen)",
        )
        + """SELECT tag_ts, count(*) FILTER (WHERE now = 1 AND had = 0) AS added, count(*) FILTER (WHERE now = 0 AND had = 1) AS disappeared,
  count(*) FILTER (WHERE now = 1 AND had = 0) - count(*) FILTER (WHERE now = 0 AND had = 1) AS net FROM run GROUP BY tag_ts""",
        "composite": _with(
            _PX,
            "layers AS (SELECT x, y, pos, list({'c': rgb24::BIGINT, 'a': CAST(floor(abs(value)) AS BIGINT) % 256} ORDER BY event_id) AS l FROM px JOIN events USING (event_id) GROUP BY x, y, pos)",
            f"""folded AS (SELECT x, y, pos, list_reduce(list_prepend({{'c': 0::BIGINT, 'a': 0::BIGINT}}, l), lambda q, p:
  {{'c': ({_mixed(16)} << 16) | ({_mixed(8)} << 8) | {_mixed(0)}, 'a': floor(p.a + q.a * (255 - p.a) / 255.0::DOUBLE + 0.5::DOUBLE)::BIGINT}}) AS f FROM layers)""",
        )
        + "SELECT x, y, pos, CAST(f.c AS INT) AS rgb24, CAST(f.a AS INT) AS alpha FROM folded",
        "alpha_over": _with(_PX, "l AS (SELECT event_id, event_id % 256 AS a, event_id // 7 % 256 AS b, pos AS below, rgb24 % 256 AS above FROM px)")
        + f"""SELECT event_id, CAST({over_a} AS INT) AS out_alpha, CAST(CASE WHEN a + b * (255 - a) / 255.0::DOUBLE > 0 THEN
  least(255, greatest(0, floor((above * a + below * (b * (255 - a) / 255.0::DOUBLE)) / (a + b * (255 - a) / 255.0::DOUBLE) + 0.5::DOUBLE))) ELSE 0 END AS INT) AS out_channel FROM l""",
        "tag_thinning": _with(_TAGS, _thin("k", 10), recursive=True) + "SELECT tag_ts FROM k",
        "tag_range_thinning": _with(
            _TAGS, "ranged AS (SELECT t FROM times WHERE t BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31')", _thin("k", 14, "ranged"), recursive=True
        )
        + "SELECT tag_ts FROM k ORDER BY tag_ts LIMIT 50",
        "tag_names_parse": _with(_PX) + "SELECT DISTINCT 'world-' || strftime(tag_ts, '%Y-%m-%dT%H-%M-%S') || '.000Z' AS tag, tag_ts AS parsed FROM px",
        "tag_lines": _with(_PX) + "SELECT DISTINCT 'world-' || strftime(tag_ts, '%Y-%m-%dT%H-%M-%S') || '.000Z' AS tag, tag_ts FROM px",
        "palette_build": _with(_PX, _PALETTE) + "SELECT index, rgb24, printf('#%06x', rgb24) AS hex FROM palette",
        "palette_extend": _with(
            _PX,
            f"known AS (SELECT CAST(row_number() OVER (ORDER BY rgb24) AS INT) AS index, rgb24 FROM (SELECT DISTINCT rgb24 FROM px WHERE alpha <> 0 AND tag_ts <= {_CUT} AND rgb24 % 838860 = 0))",
            """added AS (SELECT CAST(row_number() OVER (ORDER BY rgb24) + (SELECT max(index) FROM known) AS INT) AS index, rgb24
  FROM (SELECT DISTINCT rgb24 FROM px WHERE alpha <> 0 AND rgb24 NOT IN (SELECT rgb24 FROM known)))""",
        )
        + "SELECT index, rgb24, printf('#%06x', rgb24) AS hex FROM (SELECT * FROM known UNION ALL SELECT * FROM added)",
        "palette_encode": _with(_PX, _PALETTE) + "SELECT event_id, x, y, pos, index AS value FROM px JOIN palette USING (rgb24) WHERE alpha <> 0",
        "palette_decode": _with(_PX, _PALETTE)
        + "SELECT event_id, index AS value, rgb24 >> 16 AS r, (rgb24 >> 8) & 255 AS g, rgb24 & 255 AS b, 255 AS a FROM px JOIN palette USING (rgb24) WHERE alpha <> 0",
        "palette_unknown": _with(_PX) + "SELECT DISTINCT rgb24 FROM px WHERE alpha <> 0 AND rgb24 NOT IN (SELECT rgb24 FROM px WHERE alpha <> 0 AND rgb24 % 838860 = 0)",
        "palette_overflow_check": _with(_PX) + "SELECT tag_ts, count(DISTINCT rgb24) AS colours, count(DISTINCT rgb24) > 39 AS overflows FROM px WHERE alpha <> 0 GROUP BY tag_ts",
        "palette_contiguity": _with(_PX, _PALETTE)
        + "SELECT * FROM (SELECT index, rgb24, CAST(row_number() OVER (ORDER BY index) AS INT) AS place FROM palette WHERE index <> 3) WHERE index <> place",
        "palette_hex": _with(_PX, _PALETTE) + "SELECT rgb24, rgb24 AS again, rgb24 AS packed FROM palette",
        "rgb_transparency": _with(
            _PX,
            """corner AS (SELECT tag_ts, x, y, max(rgb24) FILTER (WHERE pos = 0) AS c0, max(rgb24) FILTER (WHERE pos = 15) AS c1,
  max(rgb24) FILTER (WHERE pos = 240) AS c2, max(rgb24) FILTER (WHERE pos = 255) AS c3 FROM px GROUP BY ALL)""",
            """share AS (SELECT tag_ts, x, y, max(CASE WHEN c0 = c1 AND c0 = c2 AND c0 = c3 THEN c0 END) AS c,
  avg(CASE WHEN c0 = c1 AND c0 = c2 AND c0 = c3 AND rgb24 = c0 THEN 1.0 ELSE 0.0 END) AS s FROM px JOIN corner USING (tag_ts, x, y) GROUP BY ALL)""",
        )
        + "SELECT tag_ts, x, y, count(*) AS pixels, count(*) FILTER (WHERE rgb24 = 0 OR (rgb24 = c AND s >= 0.05)) AS transparent FROM px JOIN share USING (tag_ts, x, y) GROUP BY ALL",
        "rgb_transparency_none": _with(_PX) + _transparent("rgb24 = 0"),
        "explicit_colors": _with(_PX) + _transparent("rgb24 IN (0, 419430, 4194300)"),
        "rgba_black_warning": _with(_PX)
        + """SELECT tag_ts, x, y, count(*) FILTER (WHERE rgb24 = 0) AS black, CAST(floor(count(*) FILTER (WHERE rgb24 = 0) / count(*) * 1000000.0::DOUBLE) AS BIGINT) AS ratio,
  bool_and(alpha = 255) AS opaque, bool_and(alpha = 255) AND count(*) FILTER (WHERE rgb24 = 0) / count(*) >= 0.05::DOUBLE AS warning FROM px GROUP BY ALL""",
        "partial_alpha": _with(_PX) + "SELECT tag_ts, x, y, count(*) AS partial FROM px WHERE event_id % 97 = 0 GROUP BY ALL",
        "tile_encoding": base
        + """SELECT tag_ts, x, y, count(*) AS count, CASE WHEN count(*) * 5 < 256 THEN 'sparse' ELSE 'dense' END AS encoding,
  least(count(*) * 5, 256) AS stored_bytes FROM overlay GROUP BY ALL""",
        "sparse_records": encoded + "SELECT x, y, CAST(row_number() OVER (PARTITION BY x, y ORDER BY pos) - 1 AS INT) AS nth, pos, index AS value FROM state JOIN palette USING (rgb24)",
        "dense_roundtrip": encoded + "SELECT x, y, pos, index AS value FROM state JOIN palette USING (rgb24)",
        "payload_roundtrip": encoded + "SELECT x, y, pos, index AS value FROM state JOIN palette USING (rgb24)",
        "payload_sizes": tiled + "SELECT x, y, CAST(count AS INT) AS count, encoding, CAST(stored_bytes AS INT) AS uncompressed_size FROM tiles",
        "shard_manifest": tiled + "SELECT * FROM shards",
        "store_rollup": tiled
        + """SELECT CAST(x // 2 AS INT) AS sx, CAST(y // 2 AS INT) AS sy, count(*) AS tile_count, CAST(sum(count) AS BIGINT) AS visible_pixels,
  CAST(sum(stored_bytes) AS BIGINT) AS stored_bytes FROM tiles GROUP BY ROLLUP (x // 2, y // 2)""",
        "largest_shards": tiled + "SELECT name, stored_bytes FROM shards ORDER BY stored_bytes DESC, name LIMIT 10",
        "shard_schedule": tiled
        + """SELECT name, stored_bytes, CAST(sum(stored_bytes) OVER (ORDER BY stored_bytes DESC, name ROWS UNBOUNDED PRECEDING) AS BIGINT) AS done_bytes,
  CAST(row_number() OVER (ORDER BY stored_bytes DESC, name) AS INT) AS nth FROM shards""",
        "byte_chunks": _with(
            _PX, _OVERLAY, _STATE, _TILES,
            "o AS (SELECT x, y, x // 2 AS sx, y // 2 AS sy, stored_bytes, row_number() OVER (PARTITION BY x // 2, y // 2 ORDER BY x, y) AS n FROM tiles)",
            """f(sx, sy, n, x, y, chunk, used) AS (SELECT sx, sy, n, x, y, 0, stored_bytes FROM o WHERE n = 1
  UNION ALL SELECT o.sx, o.sy, o.n, o.x, o.y, f.chunk + CASE WHEN f.used > 0 AND f.used + o.stored_bytes > 600 THEN 1 ELSE 0 END,
    CASE WHEN f.used > 0 AND f.used + o.stored_bytes > 600 THEN o.stored_bytes ELSE f.used + o.stored_bytes END
  FROM f JOIN o ON o.sx = f.sx AND o.sy = f.sy AND o.n = f.n + 1)""",
            recursive=True,
        )
        + "SELECT CAST(sx AS INT) AS sx, CAST(sy AS INT) AS sy, x, y, CAST(chunk AS INT) AS chunk FROM f",
        "dir_buckets": "SELECT s_suppkey, CAST((row_number() OVER (ORDER BY s_suppkey) - 1) // 7 AS INT) AS bucket FROM supplier",
        "shard_upsert": tiled + "SELECT name, CASE WHEN visible_pixels % 2 = 0 THEN visible_pixels + 1000 ELSE visible_pixels END AS visible_pixels FROM shards",
        "shard_names": tiled + "SELECT name, sx, sy FROM shards",
        "validate_state": _with(
            _PX, _OVERLAY, _STATE, _TILES,
            "bad AS (SELECT CASE WHEN y = 7 THEN x + 5 ELSE x END AS x, y, CASE WHEN (CASE WHEN y = 7 THEN x + 5 ELSE x END) = 1 AND y = 1 THEN 'rle' ELSE encoding END AS encoding FROM tiles)",
        )
        + """SELECT 'out of the grid' AS rule, printf('%d/%d', x, y) AS item FROM bad WHERE x >= 8
UNION ALL SELECT 'encoding', printf('%d/%d', x, y) FROM bad WHERE encoding = 'rle'
UNION ALL SELECT 'repeated tile', printf('%d/%d', x, y) FROM bad GROUP BY x, y HAVING count(*) > 1""",
        "payload_checks": _with(_PX)
        + """SELECT x, y, count(*) FILTER (WHERE pos >= 200) AS bad_pos, count(*) FILTER (WHERE rgb24 = 0) AS bad_value, count(*) - count(DISTINCT pos) AS repeated
FROM px GROUP BY x, y HAVING count(*) FILTER (WHERE pos >= 200) > 0 OR count(*) FILTER (WHERE rgb24 = 0) > 0 OR count(*) > count(DISTINCT pos)""",
        "missing_shards": tiled + "SELECT name FROM shards WHERE sx = sy",
        "dry_run": base.rstrip()
        + f""", old AS ({as_of}), new AS (SELECT x, y, pos FROM overlay WHERE tag_ts > {_CUT} GROUP BY ALL)
SELECT n.x, n.y, coalesce(any_value(b.before), 0) AS before, count(*) AS overlaid, coalesce(any_value(b.before), 0) + count(*) FILTER (WHERE o.pos IS NULL) AS after
FROM new n LEFT JOIN old o ON n.x = o.x AND n.y = o.y AND n.pos = o.pos LEFT JOIN (SELECT x, y, count(*) AS before FROM old GROUP BY x, y) b ON b.x = n.x AND b.y = n.y
GROUP BY n.x, n.y""",
        "pending_tags": sets + "SELECT tag_ts FROM a WHERE tag_ts NOT IN (SELECT tag_ts FROM b)",
        "applied_tags_semi": sets + "SELECT tag_ts FROM a WHERE tag_ts IN (SELECT tag_ts FROM b)",
        "tag_intersect": sets + "SELECT tag_ts FROM a INTERSECT SELECT tag_ts FROM b",
        "tag_union": sets + "SELECT tag_ts FROM a UNION SELECT tag_ts FROM b",
        "tag_except": sets + "SELECT tag_ts FROM a EXCEPT SELECT tag_ts FROM b",
        "asset_select": f"""WITH n AS (SELECT 'T.tar.' || CASE WHEN s_suppkey % 2 = 0 THEN 'gz' ELSE 'zst' END || '.' || CASE s_suppkey % 10 WHEN 0 THEN 'txt' WHEN 1 THEN 'json' WHEN 2 THEN 'sha256' ELSE {_LETTERS} END AS name FROM supplier),
p AS (SELECT name, {_key('1')} AS prefix, lower({_key('2')}) AS ext, {_key('3')} AS suffix FROM n),
q AS (SELECT name, prefix, CASE WHEN ext = 'gz' THEN 'gzip' ELSE 'zstd' END AS codec, suffix FROM p WHERE suffix <> '' AND lower(suffix) NOT IN ('txt', 'json', 'digest'))
SELECT name, prefix, codec, CAST(row_number() OVER (ORDER BY length(suffix), {suffix}, name) AS INT) AS part_no FROM q WHERE codec = 'zstd'""",
        "split_sort": f"""WITH n AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'T' ELSE 's' END || (s_suppkey % 7) || '.tar.gz.' ||
  CASE s_suppkey % 3 WHEN 0 THEN s_suppkey::VARCHAR WHEN 1 THEN upper({_LETTERS}) ELSE 'z' || {_LETTERS} END AS name FROM supplier),
p AS (SELECT name, lower({_key('1')}) AS prefix, {_key('3')} AS suffix FROM n),
k AS (SELECT name, prefix, CASE WHEN regexp_matches(suffix, '^\\d+$') THEN 0 ELSE 1 END AS kind, CASE WHEN regexp_matches(suffix, '^\\d+$') THEN 0 ELSE length(suffix) END AS len,
  CASE WHEN regexp_matches(suffix, '^\\d+$') THEN TRY_CAST(suffix AS BIGINT) ELSE {suffix} END AS number FROM p)
SELECT name, CAST(row_number() OVER (ORDER BY prefix, kind, len, number, name) AS INT) AS part_no FROM k""",
        "natural_keys": "SELECT c_custkey, 'tile ' || lpad(CAST(c_custkey AS VARCHAR), 20, '0') || 'b' AS key FROM customer",
        "tile_path_parse": "SELECT s_suppkey, CAST(s_suppkey % 9 AS INT) AS x, CAST(s_suppkey AS INT) AS y FROM supplier WHERE s_suppkey % 5 <> 0",
        "mode_histogram": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
        "mode_samples": "SELECT event_type, event_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS INT) AS nth FROM events QUALIFY nth <= 20",
        "ingest_stats": _with(_PX) + "SELECT tag_ts, count(*) AS pixels, count(*) FILTER (WHERE alpha <> 0) AS visible, count(DISTINCT x * 100 + y) AS tiles FROM px GROUP BY tag_ts",
        "neighbor_mosaic": tiled + "SELECT a.x, a.y, b.x AS nx, b.y AS ny, b.count FROM tiles a JOIN tiles b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1",
        "digest_check": "SELECT doc_id, sha256(coalesce(text, '')) AS digest FROM documents",
        "digest_names": "SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN sha256(coalesce(text, '')) END AS digest FROM documents",
        "hit_rate": """SELECT user_id, CAST(floor(coalesce(h / nullif(h + m, 0), 0) * 1000000.0::DOUBLE) AS BIGINT) AS rate_millionths FROM
  (SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS h, count(*) FILTER (WHERE event_type = 'view') AS m FROM events GROUP BY user_id)""",
        "byte_sizes": """SELECT doc_id, CASE WHEN n >= 1024 ** 3 THEN printf('%.2fGiB', round(n / 1024.0 ** 3, 2)) WHEN n >= 1024 ** 2 THEN printf('%.2fMiB', round(n / 1024.0 ** 2, 2))
  WHEN n >= 1024 THEN printf('%.2fKiB', round(n / 1024.0, 2)) ELSE printf('%.2fB', n::DOUBLE) END AS size FROM (SELECT doc_id, strlen(coalesce(text, '')) * 1000 AS n FROM documents)""",
        "shard_lists": "SELECT n_nationkey, unnest(['s0001_0002', printf('s%04d_%04d', n_nationkey, n_regionkey)]) AS name FROM nation",
        "dilation": _with(_PX, _OVERLAY, _STATE, _WORLD)
        + "SELECT DISTINCT wx + dx AS wx, wy + dy AS wy FROM world, (VALUES (-1), (0), (1)) AS a(dx), (VALUES (-1), (0), (1)) AS b(dy)",
        "shard_discovery": tiled + "SELECT name FROM shards WHERE sx < 2 UNION SELECT name FROM shards WHERE sy > 1",
        "shard_encodings": tiled
        + """SELECT CAST(x // 2 AS INT) AS sx, CAST(y // 2 AS INT) AS sy, count(*) FILTER (WHERE encoding = 'sparse') AS sparse,
  count(*) FILTER (WHERE encoding = 'dense') AS dense, max(count) AS largest FROM tiles GROUP BY x // 2, y // 2""",
        "slowest_tiles": "SELECT event_id, round(value, 2) AS ms FROM events ORDER BY ms DESC, event_id LIMIT 10",
        "new_outputs": """SELECT name FROM (SELECT printf('art_x%d_y%d_w1_h2.png', s_suppkey, s_suppkey) AS name FROM supplier) WHERE NOT contains(name, '_x1')""",
        "throughput": """SELECT doc_id, CAST(floor(CASE WHEN doc_id % 7 <> 0 THEN strlen(coalesce(text, '')) * 1024 / 1048576.0::DOUBLE / (doc_id / 4.0::DOUBLE) END * 1000000.0::DOUBLE) AS BIGINT) AS mib_s_millionths FROM documents""",
        "replaced_tiles": "SELECT event_id FROM events WHERE NOT (event_id % 3 = 1 AND user_id % 3 = 1)",
    }
    return out
