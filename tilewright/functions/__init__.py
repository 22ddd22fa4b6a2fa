"""Column functions: colours, tag names, asset names, tile and shard addresses, compositing."""
