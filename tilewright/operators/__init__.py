"""Relational operators on snapshots, pixels, tiles, shards and palettes."""
