"""Names of snapshots (tags), split archive parts, tile paths and shards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed formats of the archives: snapshot names, parts of split archives, tile paths.
TAG = r"^world-(\d{4})-(\d{2})-(\d{2})T(\d{2})[-_:](\d{2})[-_:](\d{2})"
PART = r"(?i)^(.+?)\.tar\.(gz|zst|zstd)\.([A-Za-z]+|\d+)$"
#: Suffixes of notes and digests, which look like parts; any other suffix of letters is a part's.
NOT_PARTS = ("txt", "json", "digest")
TILE = r"(?i)(\d+)/(\d+)\.png$"


def tag_time(tag: Column) -> Column:
    """The time without zone in a snapshot's name, to the second; null if there is none."""
    text = F.concat_ws(
        " ",
        F.concat_ws("-", *(F.regexp_extract(tag, TAG, i) for i in (1, 2, 3))),
        F.concat_ws(":", *(F.regexp_extract(tag, TAG, i) for i in (4, 5, 6))),
    )
    return F.when(tag.rlike(TAG), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"))


def tag_name(time: Column) -> Column:
    return F.concat(F.lit("world-"), F.date_format(time.cast("timestamp"), "yyyy-MM-dd'T'HH-mm-ss"), F.lit(".000Z"))


def whole_days(a: Column, b: Column) -> Column:
    """Whole days from a to b."""
    return F.timestamp_diff("DAY", a, b)


def is_part(name: Column) -> Column:
    return name.rlike(PART) & ~F.lower(F.regexp_extract(name, PART, 3)).isin(*NOT_PARTS)


def part_prefix(name: Column) -> Column:
    return F.regexp_extract(name, PART, 1)


def part_codec(name: Column) -> Column:
    found = F.lower(F.regexp_extract(name, PART, 2))
    return F.when(found == "gz", "gzip").otherwise("zstd")


def part_extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, PART, 2))


def part_suffix(name: Column) -> Column:
    return F.regexp_extract(name, PART, 3)


def letters_number(suffix: Column) -> Column:
    """A suffix of letters as a number in base 26 (a = 0)."""
    letters = F.transform(F.split(F.lower(suffix), ""), lambda c: F.ascii(c) - 97)
    return F.aggregate(letters, F.lit(0).cast("long"), lambda acc, x: acc * 26 + x)


def part_order(name: Column) -> list[Column]:
    """Sort keys of parts: prefix, digits before letters, length of letters, number, name."""
    suffix = part_suffix(name)
    digits = suffix.rlike(r"^\d+$")
    return [
        F.lower(part_prefix(name)),
        F.when(digits, 0).otherwise(1),
        F.when(digits, 0).otherwise(F.length(suffix)),
        F.when(digits, suffix.try_cast("long")).otherwise(letters_number(suffix)),
        name,
    ]


def natural_key(text: Column) -> Column:
    """A text whose plain order is the natural one: numbers padded to 20 digits."""
    pieces = F.regexp_extract_all(F.lower(text), F.lit(r"(\d+|\D+)"), 1)
    return F.array_join(F.transform(pieces, lambda p: F.when(p.rlike(r"^\d+$"), F.lpad(p, 20, "0")).otherwise(p)), "")


def tile_x(path: Column) -> Column:
    """The column in a path .../x/y.png; null for other paths."""
    return F.regexp_extract(F.translate(path, "\\", "/"), TILE, 1).try_cast("int")


def tile_y(path: Column) -> Column:
    return F.regexp_extract(F.translate(path, "\\", "/"), TILE, 2).try_cast("int")


def shard_of(x: Column, shard_tiles: int) -> Column:
    return F.floor(x / shard_tiles).cast("int")


def shard_name(sx: Column, sy: Column) -> Column:
    return F.format_string("s%04d_%04d", sx, sy)


def shard_from_name(name: Column) -> tuple[Column, Column]:
    form = r"^s(\d{4})_(\d{4})$"
    return F.regexp_extract(name, form, 1).try_cast("int"), F.regexp_extract(name, form, 2).try_cast("int")


def shards_per_axis(grid_tiles: int, shard_tiles: int) -> int:
    return -(-grid_tiles // shard_tiles)


def shard_list(text: Column) -> Column:
    """The names in a list separated by ',' or ';'."""
    return F.filter(F.transform(F.split(F.translate(text, ";", ","), ","), lambda x: F.trim(x)), lambda x: x != "")


def sha256_of_digest(digest: Column) -> Column:
    """The hexadecimal part of 'sha256:...'; null for other digests."""
    return F.when(F.lower(digest).startswith("sha256:"), F.lower(F.substring_index(digest, ":", -1)))


def human_bytes(n: Column) -> Column:
    """A size with two decimals in the largest unit that it reaches, as 1.50KiB."""
    out = F.format_string("%.2fB", n.cast("double"))
    for power, unit in ((1, "KiB"), (2, "MiB"), (3, "GiB"), (4, "TiB")):
        out = F.when(F.abs(n) >= 1024**power, F.format_string(f"%.2f{unit}", n / float(1024**power))).otherwise(out)
    return out


def hit_rate(hits: Column, misses: Column) -> Column:
    return F.coalesce(F.try_divide(hits.cast("double"), (hits + misses).cast("double")), F.lit(0.0))


def world_position(tile: Column, offset: Column, tile_size: int) -> Column:
    return tile.cast("long") * tile_size + offset


def artwork_name(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.format_string("art_x%d_y%d_w%d_h%d.png", x, y, w, h)


def is_png(name: Column) -> Column:
    return F.lower(name).endswith(".png")


def mib_per_second(size: Column, seconds: Column) -> Column:
    """Throughput; null where no time passed."""
    return F.try_divide(size / float(1 << 20), seconds)


def same_size(width: Column, height: Column, other_width: Column, other_height: Column) -> Column:
    """Whether two images can be compared pixel by pixel; otherwise the new one replaces the old one."""
    return (width == other_width) & (height == other_height)
