"""Columns of integers packed into one binary value, so that a batch of rows travels as one row per bucket."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of integers that are not negative, each in the least width that holds it, compressed together."""
    thin = [a.astype(np.min_scalar_type(int(a.max())) if len(a) else np.uint8, copy=False) for a in arrays]
    head = np.array([x for a in thin for x in (a.itemsize, len(a))], np.int64)
    raw = head.tobytes() + b"".join(a.tobytes() for a in thin)
    return np.array([len(raw), len(thin)], np.int64).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def spread(payload: bytes) -> list[np.ndarray]:
    """The arrays of ``squeeze``."""
    size, n = (int(x) for x in np.frombuffer(payload, np.int64, 2))
    raw = pa.decompress(payload[16:], size, "zstd", asbytes=True)
    out, at = [], 16 * n
    for width, count in np.frombuffer(raw, np.int64, 2 * n).reshape(n, 2).tolist():
        out.append(np.frombuffer(raw, f"u{width}", count, at))
        at += width * count
    return out


def first_batch() -> int:
    """Number of a task's first batch of rows; the next ones count on. The same for a task that runs again."""
    task = TaskContext.get()
    return (task.partitionId() if task else 0) << 24
