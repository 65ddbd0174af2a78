"""What the operators share: written tables in the shared folder, word hashing over Arrow buffers, components.

Tokens are hashed in bulk with NumPy straight from the UTF-8 buffer of an Arrow column; no row-at-a-time Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators._store import discard, ship, spread  # noqa: F401
from textmill.operators._store import stored as written

WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64
_P, _Q = U64(0x9E3779B97F4A7C15), U64(0xD1342543DE82EF95)
CHUNK_BYTES = 256 << 10


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most `rows` rows and about `size` bytes (a larger row is a piece of its own), so that
    what an operator holds at once does not hang on the session's Arrow settings."""
    for batch in batches:
        many = max(1, min(rows, batch.num_rows * size // max(batch.nbytes, 1)))
        for i in range(0, batch.num_rows, many):
            yield batch.slice(i, many)


def gathered(batches: Iterator[pa.RecordBatch], rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Batches that follow on each other put together, up to `rows` rows and about `size` bytes."""
    held, n, many = [], 0, 0
    for batch in batches:
        if held and (n + batch.num_rows > rows or many + batch.nbytes > size):
            yield pa.concat_batches(held)
            held, n, many = [], 0, 0
        held.append(batch)
        n, many = n + batch.num_rows, many + batch.nbytes
    if held:
        yield pa.concat_batches(held)


def arrow_map(df: DataFrame, f: Callable, schema, rows: int = 1000, size: int = 4 << 20) -> DataFrame:
    """mapInArrow of f over pieces of the batches."""
    ship(df.sparkSession)
    return df.mapInArrow(lambda batches: f(sliced(gathered(batches, rows, size), rows, size)), schema)


def text_buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "")
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offs = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + n + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def text_chunks(col, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows [i, j) of about `limit` bytes (a longer text is a run of its own) with their bytes and offsets."""
    raw, offs = text_buffers(col)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def _table(seps: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in seps]] = True
    return t


BLANK = _table("\x20\x09\x0a\x0b\x0c\x0d")
BLANK_OR_PUNCT = BLANK | _table("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


TILE = 1 << 18
_tables: dict[int, np.ndarray] = {}


def _pow(base: int, n: int) -> np.ndarray:
    """base to the powers 0 to n - 1 and beyond, modulo 2**64."""
    if base not in _tables or len(_tables[base]) < n:
        steps = np.full(max(n, TILE), base, U64)
        steps[0] = 1
        _tables[base] = np.cumprod(steps, dtype=U64)
    return _tables[base]


def words(raw: np.ndarray, offs: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, byte start, byte end, 64-bit hash of the A-Z-lowered word) of each word, in order."""
    value = np.where(blank, U64(0), LOWER.astype(U64) + U64(1))
    tok = ~blank[raw]
    n = len(raw)
    first, last = tok.copy(), tok.copy()
    first[1:] &= ~tok[:-1]
    last[:-1] &= ~tok[1:]
    inner = offs[(offs > 0) & (offs < n)]
    first[inner], last[inner - 1] = tok[inner], tok[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    # A word's polynomial is summed with the powers of its place in the tile, which the inverse power takes out again;
    # blanks add nothing.
    h = np.zeros(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + TILE, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        at = starts[i:j] - a
        h[i:j] = np.add.reduceat(value[raw[a:b]] * _pow(int(_P), b - a)[: b - a], at) * _pow(pow(int(_P), -1, 1 << 64), b - a)[at]
        i = j
    h = mix64(h + (ends - starts).astype(U64) * _Q)
    return np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(starts, offs))), starts, ends, h


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive word hashes."""
    q = int(_Q)
    total, n = np.zeros(max(0, len(h) - k + 1), U64), 0
    part, m = h, 1  # part: sums over m words, for m the powers of two
    while len(total) and n < k:
        if k & m:
            total += part[n : n + len(total)] * U64(pow(q, n, 1 << 64))
            n += m
        if n < k:
            part = part[: len(part) - m] + part[m:] * U64(pow(q, m, 1 << 64))
            m *= 2
    return mix64(total + U64(k))


def shingle_sets(raw: np.ndarray, offs: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each row; a shorter text is one shingle, one without words none."""
    row, _, _, h = words(raw, offs)
    n = len(offs) - 1
    at = np.searchsorted(row, np.arange(n + 1))
    grams = gram_hashes(h, k)
    out = []
    for i in range(n):
        a, b = at[i], at[i + 1]
        out.append(np.unique(grams[a : b - k + 1]) if b - a >= k else gram_hashes(h[a:b], int(b - a)) if b > a else grams[:0])
    return out


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id on an edge (a, b): component is the smallest id reachable.

    Each round maps a vertex to its smallest neighbour and contracts the graph by that map; only minima per vertex are
    aggregated (map-side combine), no adjacency list is ever gathered. Rounds are written tables.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    e, labels = written(e, "edges"), None
    while not e.isEmpty():
        up = e.select(F.col("b").alias("id"), F.col("a").alias("to")).unionByName(e.select(F.col("a").alias("id"), F.col("b").alias("to")))
        up = written(up.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("to")), "parents")
        old = [e, up] + ([] if labels is None else [labels])
        labels = up.select("id", F.col("to").alias("component")) if labels is None else (
            labels.join(up.withColumnRenamed("id", "component"), "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        )
        labels = written(labels, "labels")
        e = (
            e.join(up.select(F.col("id").alias("a"), F.col("to").alias("pa")), "a")
            .join(up.select(F.col("id").alias("b"), F.col("to").alias("pb")), "b")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .where("a < b")
            .distinct()
        )
        e = written(e, "edges")
        discard(*old)
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("a").alias("component")).limit(0)
    return labels
