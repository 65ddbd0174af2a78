"""Character n-grams of Arrow string columns in NumPy, whole columns at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18


def pieces(col: pa.Array, most: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows [i, j) of about `most` characters (a longer text is a run of its own): their code points, one text
    after the other, and where each text begins and the last one ends. A null text is empty."""
    col = pc.fill_null(col, "")
    ends = np.concatenate([[0], np.cumsum(pc.utf8_length(col).to_numpy(zero_copy_only=False))]).astype(np.int64)
    i, n = 0, len(col)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + most, "right")) - 1)
        text = "".join(col.slice(i, j - i).to_pylist())
        yield i, j, np.frombuffer(text.encode("utf-32-le"), np.uint32), ends[i : j + 1] - ends[i]
        i = j


def counted(codes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, gram, times, example) of each distinct n-gram of each text, by row: grams numbered within the piece, with
    the place of one occurrence of each gram."""
    last = len(codes) - n + 1
    if last <= 0:
        return (np.zeros(0, np.int64),) * 4
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(row[:last] == row[n - 1 :])
    if n == 2:
        key = (codes[at].astype(np.uint64) << np.uint64(32)) | codes[at + 1]
    else:
        key = np.lib.stride_tricks.sliding_window_view(codes, n)[at].copy().view(f"V{4 * n}").ravel()
    _, example, gram = np.unique(key, return_index=True, return_inverse=True)
    pair, times = np.unique(row[at] * len(example) + gram, return_counts=True)
    return pair // max(len(example), 1), pair % max(len(example), 1), times, at[example]
