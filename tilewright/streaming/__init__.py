"""The rolling state as a stream of snapshots."""
