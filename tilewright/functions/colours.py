"""Packed 24-bit colours, palettes' hexadecimal form, and compositing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rgb24(r: Column, g: Column, b: Column) -> Column:
    """One integer from three channels of 0..255."""
    low = lambda c: c.cast("int").bitwiseAND(F.lit(255))
    return F.shiftleft(low(r), 16).bitwiseOR(F.shiftleft(low(g), 8)).bitwiseOR(low(b))


def red(c: Column) -> Column:
    return F.shiftright(c, 16).bitwiseAND(F.lit(255))


def green(c: Column) -> Column:
    return F.shiftright(c, 8).bitwiseAND(F.lit(255))


def blue(c: Column) -> Column:
    return c.bitwiseAND(F.lit(255))


def to_hex(c: Column) -> Column:
    """#rrggbb in lower case."""
    return F.concat(F.lit("#"), F.lower(F.lpad(F.hex(c), 6, "0")))


def from_hex(s: Column) -> Column:
    return F.conv(F.substring(s, 2, 6), 16, 10).cast("int")


def parse_colours(text: str | None) -> list[int]:
    """Packed colours of 'r,g,b' or '#rrggbb' entries separated by ';' or '|', sorted and distinct."""
    found = set()
    for part in (text or "").replace("|", ";").split(";"):
        part = part.strip()
        if not part:
            continue
        if part.startswith("#"):
            if len(part) != 7:
                raise ValueError(f"not a colour: {part}")
            found.add(int(part[1:], 16))
            continue
        channels = [int(x) for x in part.split(",")]
        if len(channels) != 3 or not all(0 <= c <= 255 for c in channels):
            raise ValueError(f"not a colour: {part}")
        found.add(channels[0] << 16 | channels[1] << 8 | channels[2])
    return sorted(found)


def over_alpha(above: Column, below: Column) -> Column:
    """Alpha (0..255) of one layer over another, rounded half up."""
    return F.floor(above + below * (255 - above) / F.lit(255.0) + F.lit(0.5)).cast("int")


def over_channel(above: Column, alpha_above: Column, below: Column, alpha_below: Column) -> Column:
    """A channel (0..255) of one layer over another, rounded half up; 0 where nothing is visible."""
    weight = alpha_below * (255 - alpha_above) / F.lit(255.0)
    total = alpha_above + weight
    mixed = F.floor((above * alpha_above + below * weight) / total + F.lit(0.5))
    return F.when(total > 0, F.least(F.lit(255), F.greatest(F.lit(0), mixed))).otherwise(0).cast("int")
