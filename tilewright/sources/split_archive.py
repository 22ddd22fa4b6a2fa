"""A data source of tiles in split tar archives.

The parts of an archive are one byte stream that was cut after compression, so a snapshot is
one partition and is read as a stream: parts, inflation, tar members. Rows are the members
whose path ends in x/y.png: x, y, ordinal (place in the archive), content.

    spark.dataSource.register(SplitArchive)
    spark.read.format("split_archive").option("paths", "a.tar.gz.aa,a.tar.gz.ab").load()

paths may hold several archives; their parts are grouped by name.
"""

from __future__ import annotations

import os
import re
import tarfile
import zlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tilewright.functions.names import NOT_PARTS, PART, TILE

_PART, _TILE = re.compile(PART), re.compile(TILE)


class ArchiveError(ValueError):
    """Names that aren't the parts of one archive, or a damaged stream."""


def part_order(path: str) -> tuple:
    """Digits before letters; letters by length, then alphabet."""
    suffix = _PART.match(path.rsplit("/", 1)[-1])[3].lower()
    return (0, 0, int(suffix), "") if suffix.isdigit() else (1, len(suffix), 0, suffix)


def group_parts(paths: list[str]) -> dict[tuple[str, str], list[str]]:
    """Parts in order by (prefix, codec); ArchiveError for another name."""
    out: dict[tuple[str, str], list[str]] = {}
    for path in paths:
        found = _PART.match(path.rsplit("/", 1)[-1])
        if not found or found[3].lower() in NOT_PARTS:
            raise ArchiveError(f"not a part of a split archive: {path}")
        out.setdefault((found[1], "gzip" if found[2].lower() == "gz" else "zstd"), []).append(path)
    if not out:
        raise ArchiveError("no parts")
    return {k: sorted(v, key=part_order) for k, v in out.items()}


def file_size(path: str) -> int:
    return os.path.getsize(path)


class Stream:
    """The inflated bytes of parts, as a file to read from."""

    def __init__(self, paths: list[str], codec: str, chunk: int = 1 << 20):
        self.blocks, self.rest, self.total = self._inflated(paths, codec, chunk), b"", 0

    @staticmethod
    def _inflated(paths: list[str], codec: str, chunk: int) -> Iterator[bytes]:
        if codec == "zstd":
            import zstandard

            inflate = zstandard.ZstdDecompressor().decompressobj()
        else:
            inflate = zlib.decompressobj(31)
        begun = False
        for path in paths:
            with open(path, "rb") as f:
                while block := f.read(chunk):
                    begun = True
                    while block:
                        yield inflate.decompress(block)
                        block = inflate.unused_data
                        if not inflate.eof:
                            break
                        # members or frames may follow each other
                        inflate = zstandard.ZstdDecompressor().decompressobj() if codec == "zstd" else zlib.decompressobj(31)
                        begun = bool(block)
        if begun and not inflate.eof:
            raise ArchiveError("the archive ends early")

    def read(self, n: int = -1) -> bytes:
        parts, have = [self.rest], len(self.rest)
        while n < 0 or have < n:
            block = next(self.blocks, None)
            if block is None:
                break
            parts.append(block)
            have += len(block)
            self.total += len(block)
        whole = b"".join(parts)
        if n < 0:
            n = len(whole)
        self.rest = whole[n:]
        return whole[:n]


def tiles(paths: list[str], codec: str, grid: int | None = None) -> Iterator[tuple[int, int, int, bytes]]:
    """(x, y, ordinal, content) of the archive's tiles; ArchiveError for one out of the grid."""
    with tarfile.open(fileobj=Stream(paths, codec), mode="r|") as tar:
        for ordinal, member in enumerate(tar):
            found = _TILE.search(member.name.replace("\\", "/"))
            if not member.isfile() or not found:
                continue
            x, y = int(found[1]), int(found[2])
            if grid is not None and (x >= grid or y >= grid):
                raise ArchiveError(f"tile {x}/{y} is out of the grid")
            yield x, y, ordinal, tar.extractfile(member).read()


class Archive(InputPartition):
    def __init__(self, name: str, codec: str, paths: list[str]):
        super().__init__(name)
        self.name, self.codec, self.paths = name, codec, paths


class SplitArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p.strip() for p in options.get("paths", "").split(",") if p.strip()]
        self.grid = int(options["grid"]) if options.get("grid") else None

    def partitions(self) -> list[InputPartition]:
        return [Archive(name, codec, paths) for (name, codec), paths in group_parts(self.paths).items()]

    def read(self, partition: Archive):
        for x, y, ordinal, content in tiles(partition.paths, partition.codec, self.grid):
            yield partition.name, x, y, ordinal, content


class SplitArchive(DataSource):
    @classmethod
    def name(cls) -> str:
        return "split_archive"

    def schema(self) -> str:
        return "tag string, x int, y int, ordinal long, content binary"

    def reader(self, schema) -> DataSourceReader:
        return SplitArchiveReader(self.options)
