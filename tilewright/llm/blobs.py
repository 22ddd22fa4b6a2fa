"""Entries of several columns as binary blobs, dealt to numbered parts and sorted there by numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tilewright.llm.common import release


def dealt(pid: np.ndarray, *columns: np.ndarray):
    """(pid, blob) for each pid: its entries' columns, one after another."""
    order = np.argsort(pid.astype(np.uint16) if pid.max(initial=0) < 1 << 16 else pid, kind="stable")
    pid, columns = pid[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.diff(pid)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(pid)], strict=True):
        if b > a:
            yield int(pid[a]), b"".join(c[a:b].tobytes() for c in columns)


def gathered(blobs: list[bytes], types: tuple) -> list[np.ndarray]:
    """The columns of all blobs of dealt()."""
    width = sum(np.dtype(t).itemsize for t in types)
    out: list[list[np.ndarray]] = [[] for _ in types]
    for blob in blobs:
        n, at = len(blob) // width, 0
        for column, t in zip(out, types, strict=True):
            column.append(np.frombuffer(blob, t, n, at))
            at += n * np.dtype(t).itemsize
    return [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(out, types, strict=True)]


def blob_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kind, pid, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(pid, pa.int32()), pa.array(blob, pa.binary())], names=["kind", "pid", "blob"])


def by_kind(batches):
    """The blobs of a partition, by kind."""
    release()
    found: dict[int, list[bytes]] = {}
    for batch in batches:
        for kind, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            found.setdefault(kind, []).append(blob)
    return found
