"""Line dedup by winnowing.

Texts are reflowed by every site, so a line is here any LINE consecutive words, wherever the line feeds are. Of the
hashes of all lines of a text the minimum of each window of WINDOW lines is the fingerprint of the MIN_WORDS words from
the window's start, so equal runs have equal fingerprints. Runs that follow on each other and share a fingerprint are a
stretch, which is joined by the hash of all its words to its first position (by doc_id, then word). Where a fingerprint
has unequal stretches, the first of each is read again and its runs of MIN_WORDS words are hashed one by one and joined
to their first positions; later stretches need not be, as all their runs are in the first. All words of later stretches
and runs are deleted: exactly those that lie in MIN_WORDS words which occur earlier.

A text's own lines, between line feeds, come in addition: one of MIN_LINE words or more that stood as a line earlier is
deleted, however short of MIN_WORDS it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._common import _Q, _pow, arrow_map, gram_hashes, mix64, text_chunks, words, written
from .near_dup import near_duplicates

LINE, WINDOW, MIN_WORDS, MIN_LINE = 10, 31, 40, 3
BLOCK = 128
U64 = np.uint64
TOP = U64(0xFFFFFFFFFFFFFFFF)


def _slide(x: np.ndarray, w: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each window of w, by doubling."""
    n, m = 1, x
    while 2 * n <= w:
        m = pick(m[: len(m) - n], m[n:])
        n *= 2
    return pick(m[: len(x) - w + 1], m[w - n : w - n + len(x) - w + 1]) if w > n else m


def spans(h: np.ndarray, a: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hash of the n words from each a on, the same as gram_hashes of n words."""
    q = int(_Q)
    total = np.concatenate([np.zeros(1, U64), np.cumsum(h * _pow(q, len(h))[: len(h)], dtype=U64)])
    return mix64((total[a + n] - total[a]) * _pow(pow(q, -1, 1 << 64), len(h))[a] + n.astype(U64))


def winnow(row: np.ndarray, h: np.ndarray, line: int, window: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, fingerprint) of each stretch: runs of `least` words of one text that follow on each other and
    share their lowest line. A stretch in which that line may occur twice could repeat itself: its first run is given as
    a stretch of its own too, which makes the fingerprint one of unequal stretches."""
    g = gram_hashes(h, line)
    n = max(0, len(h) - least + 1)
    at = np.flatnonzero(row[:n] == row[len(row) - n :])
    if not len(at):
        return at, at, g[:0]
    low = _slide(g, window, np.minimum)[at]
    new = np.ones(len(at), bool)
    new[1:] = (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1)
    heads = np.flatnonzero(new)
    high = np.zeros(len(g) + window - 1, U64)
    high[at + window - 1] = low
    lowest = np.flatnonzero(_slide(high, window, np.maximum) == g)
    lowest = lowest[np.argsort(g[lowest], kind="stable")]
    close = (g[lowest[1:]] == g[lowest[:-1]]) & (lowest[1:] - lowest[:-1] <= window)
    at, n, low = at[heads], np.diff(np.append(heads, len(at))) + least - 1, low[heads]
    twice = np.isin(low, g[lowest[1:]][close]) & (n > least)
    return np.concatenate([at, at[twice]]), np.concatenate([n, np.full(twice.sum(), least)]), np.concatenate([low, low[twice]])


def own_lines(raw: np.ndarray, row: np.ndarray, start: np.ndarray, h: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, hash) of the lines between line feeds that hold MIN_LINE words or more, but fewer than `least`."""
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), h
    feed = np.searchsorted(np.flatnonzero((raw == 10) | (raw == 13)), start)
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (feed[1:] != feed[:-1])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(h)))
    mine = (n >= MIN_LINE) & (n < least)
    return at[mine], n[mine], spans(h, at[mine], n[mine])


PRINTS = "stretch long, fp long, doc_id long, pos int, n int"


def _prints(batches: Iterator[pa.RecordBatch], line: int, window: int, least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for i, _, raw, offs in text_chunks(batch.column(1)):
            row, start, _, h = words(raw, offs)
            at, n, fp = winnow(row, h, line, window, least)
            own, size, of = own_lines(raw, row, start, h, least)
            whole = np.concatenate([spans(h, at, n), of])
            at, n, fp = np.concatenate([at, own]), np.concatenate([n, size]), np.concatenate([fp, of])
            pos = at - np.searchsorted(row, row[at])
            yield pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(ids[i + row[at]].astype(np.int64)), pa.array(pos.astype(np.int32)), pa.array(n.astype(np.int32))], names=["stretch", "fp", "doc_id", "pos", "n"])


RUNS = "run long, doc_id long, pos int"


def _runs(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Hash and place of each run of `least` words in the stretches of column 2."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        bounds = batch.column(2).offsets.to_numpy()
        pos, n = (batch.column(2).values.field(c).to_numpy().astype(np.int64) for c in ("pos", "n"))
        for i, j, raw, offs in text_chunks(batch.column(1)):
            row, _, _, h = words(raw, offs)
            at = np.searchsorted(row, np.arange(j - i + 1))
            m = slice(bounds[i], bounds[j])
            many = n[m] - least + 1
            head = np.repeat(at[:-1], np.diff(bounds[i : j + 1])) + pos[m]
            place = np.repeat(head - np.cumsum(many) + many, many) + np.arange(many.sum())
            run, pos_ = gram_hashes(h, least)[place], place - at[row[place]]
            yield pa.RecordBatch.from_arrays([pa.array(run.view(np.int64)), pa.array(ids[i + row[place]].astype(np.int64)), pa.array(pos_.astype(np.int32))], names=["run", "doc_id", "pos"])


def repeated(own: np.ndarray, at: np.ndarray, ids: list, found: tuple, least: int, spare: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the runs of words that occur earlier, and whether each row is a copy that is left whole.

    It compares with given blocks of earlier texts word by word; dedup_lines, which joins whole runs, does without it.
    own: 32-bit word hashes of the rows' texts, of which row r has those from at[r] to at[r + 1]. found: of each match its
    row (ascending), src, diag (own word - earlier word), block, n_src, the block's hashes (all in one array) and their
    ends in it. Blocks that follow on each other are one stretch. A run may overlap the earlier one in the same text.
    """
    row, src, diag, block, n_src, hashes, ends = found
    copy = np.zeros(len(at) - 1, bool)
    none = np.zeros(0, np.int64)
    shift = at[row] + block.astype(np.int64) * BLOCK + diag  # own word that the block's first is held against
    lo, hi = np.maximum(shift, at[row]), np.minimum(shift + np.diff(ends), at[row + 1])
    into = ends[:-1] - shift
    order = np.lexsort((lo, diag, src, row))
    order = order[(lo < hi)[order]]
    if not len(order):
        return none, none, none, copy
    row, src, diag, n_src, lo, hi, into = (x[order] for x in (row, src, diag, n_src, lo, hi, into))
    size = hi - lo
    stop = np.cumsum(size)
    begin = stop - size
    place = np.arange(stop[-1]) + np.repeat(lo - begin, size)
    eq = own[place] == hashes[place + np.repeat(into, size)]
    pair = np.ones(len(row), bool)
    pair[1:] = (row[1:] != row[:-1]) | (src[1:] != src[:-1])
    if spare is not None:
        heads = np.flatnonzero(pair)
        tails = np.append(heads[1:], len(row)) - 1
        seen = np.add.reduceat(eq.astype(np.int64), begin[heads])  # at most: two diagonals may meet one word
        words_ = at[1:] - at[:-1]
        for k in np.flatnonzero(seen >= spare * np.maximum(words_[row[heads]], n_src[heads])):
            i, j = heads[k], tails[k]
            r = row[i]
            if src[i] != ids[r] and not copy[r]:
                met = place[begin[i] : stop[j]][eq[begin[i] : stop[j]]]
                copy[r] = len(np.unique(met)) >= spare * max(words_[r], n_src[i])
    fresh = pair.copy()
    fresh[1:] |= (diag[1:] != diag[:-1]) | (lo[1:] != hi[:-1])
    heads = begin[fresh]
    first, last = eq.copy(), eq.copy()
    first[1:] &= ~eq[:-1]
    last[:-1] &= ~eq[1:]
    first[heads], last[heads - 1] = eq[heads], eq[heads - 1]
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    long = b - a + 1 >= least
    a, b = place[a[long]], place[b[long]] + 1
    r = np.searchsorted(at, a, "right") - 1
    a, b, r = (x[~copy[r]] for x in (a, b, r))
    if not len(a):
        return none, none, none, copy
    order = np.argsort(a, kind="stable")
    a, b, r = a[order], np.maximum.accumulate(b[order]), r[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] > b[:-1]) | (r[1:] != r[:-1])
    heads = np.flatnonzero(new)
    return r[heads], a[heads], b[np.append(heads[1:], len(a)) - 1], copy


def cut(raw: bytes, start: np.ndarray, end: np.ndarray, runs: list[tuple[int, int]]) -> bytes:
    """The text without the runs of words; of the blanks around a run one gap stays, the one with a line feed first."""
    out, at = [], 0
    for a, b in runs:
        out.append(raw[at : start[a]])
        nxt = int(start[b]) if b < len(start) else len(raw)
        before = raw[int(end[a - 1]) if a else 0 : start[a]]
        after = raw[int(end[b - 1]) : nxt]
        if b >= len(start) or a == 0:
            keep = b""
        elif b"\n" in after and b"\n" not in before:
            out[-1] = out[-1][: len(out[-1]) - len(before)]
            keep = after
        else:
            keep = b""
        out.append(keep)
        at = nxt
    out.append(raw[at:])
    return b"".join(out)


CLEAN = "doc_id long, text string, n_runs long, n_deleted long, is_copy boolean"


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in CLEAN.split(", ")]
    for batch in batches:
        more = batch.schema.names[4:]  # carried columns
        met = pc.fill_null(pc.greater(pc.list_value_length(batch.column(2)), 0), False)
        rest = batch.filter(pc.invert(met))  # texts without matches pass as they are
        none = pa.array(np.zeros(rest.num_rows, np.int64))
        yield pa.RecordBatch.from_arrays([rest.column(0), rest.column(1), none, none, *rest.columns[3:]], names=names + more)
        batch = batch.filter(met)
        found = batch.column(2)
        bounds = found.offsets.to_numpy()
        pos, n = (found.values.field(c).to_numpy().astype(np.int64) for c in ("pos", "n"))
        for i, j, raw, offs in text_chunks(batch.column(1)):
            row, start, end, _ = words(raw, offs)
            at = np.searchsorted(row, np.arange(j - i + 1))
            m = slice(bounds[i], bounds[j])
            from_ = np.repeat(at[:-1], np.diff(bounds[i : j + 1])) + pos[m]
            depth = np.bincount(from_, minlength=len(row) + 1) - np.bincount(from_ + n[m], minlength=len(row) + 1)
            gone = np.cumsum(depth)[:-1] > 0
            first, last = gone.copy(), gone.copy()
            first[1:] &= ~gone[:-1] | (row[1:] != row[:-1])
            last[:-1] &= ~gone[1:] | (row[1:] != row[:-1])
            a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
            r = row[a]
            texts = batch.column(1).slice(i, j - i)
            n_runs, n_deleted = np.bincount(r, minlength=j - i), np.bincount(r, b - a, j - i).astype(np.int64)
            if len(r):
                new = texts.to_pylist()
                for k in np.flatnonzero(n_runs):
                    mine = slice(*np.searchsorted(r, [k, k + 1]))
                    lo, hi = at[k], at[k + 1]
                    own = cut(raw[offs[k] : offs[k + 1]].tobytes(), start[lo:hi] - offs[k], end[lo:hi] - offs[k], list(zip((a[mine] - lo).tolist(), (b[mine] - lo).tolist())))
                    new[k] = own.decode("utf-8")
                texts = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), texts, pa.array(n_runs), pa.array(n_deleted), *(c.slice(i, j - i) for c in batch.columns[3:])], names=names + more)


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS, line: int = LINE, window: int = WINDOW, spare: float | None = None, carry: bool = False) -> DataFrame:
    """One row per input row: doc_id, text without later repeated runs, n_runs, n_deleted, is_copy.

    Words are compared with A-Z lowered. Order is by doc_id, then place; rows that share a doc_id are taken to be equal
    and are edited alike, so a repeated row is not a repeat of itself. With `spare`, a text that near-duplicate removal
    at that Jaccard similarity of shingle sets links with an earlier one that stays is marked is_copy and left whole for
    that stage to drop, and no text is cut for what stands in it. Where the one that stays loses runs, its copies are
    given its text and lose the same, so that they are still linked. Null texts stay null; null doc_ids and
    texts without matches pass unchanged; an empty table gives no rows. Other columns are not read unless `carry` is set:
    then a struct `row` holds all columns but text as they came, whatever their names.
    """
    rest = [F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row")] if carry else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *rest)
    if spare is not None:
        copies = written(near_duplicates(rows, percent=round(100 * spare)).where("not kept").select("doc_id", "component_id").distinct(), "copies")
    window = min(window, least - line + 1)
    prints = arrow_map(rows.select("doc_id", "text").where("doc_id is not null"), lambda b: _prints(b, line, window, least), PRINTS)
    if spare is not None:
        prints = prints.join(copies, "doc_id", "left_anti")
    prints = written(prints, "prints")
    place = F.struct("doc_id", "pos")
    firsts = prints.groupBy("stretch").agg(F.min(place).alias("first"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.count(F.lit(1)).alias("times"))
    firsts = written(firsts, "firsts")
    mixed = firsts.where(F.col("n") >= least).groupBy("fp").agg(F.count(F.lit(1)).alias("stretches")).where("stretches > 1").select("fp")
    again = firsts.where(F.col("n") >= least).join(mixed, "fp").groupBy(F.col("first.doc_id").alias("doc_id")).agg(F.collect_list(F.struct("first.pos", "n")).alias("stretches"))
    texts = rows.select("doc_id", "text").join(written(again, "again"), "doc_id")
    runs = written(arrow_map(texts, lambda b: _runs(b, least), RUNS), "runs")
    known = runs.groupBy("run").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").select("run", "first")
    at_first = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("pos") == F.col("first.pos"))
    parts = runs.join(known, "run").where(~at_first).select("doc_id", "pos", F.lit(least).alias("n"))
    later = prints.select("stretch", "doc_id", "pos", "n").join(firsts.where("times > 1").select("stretch", "first"), "stretch").where(~at_first).select("doc_id", "pos", "n")
    full = later.unionByName(parts).groupBy("doc_id").agg(F.collect_list(F.struct("pos", "n")).alias("found"))
    full = written(full, "found")
    if spare is not None:
        cut_too = copies.join(full.withColumnRenamed("doc_id", "component_id"), "component_id")
        led = written(cut_too.select("component_id").distinct(), "led")
        leads = rows.select(F.col("doc_id").alias("component_id"), F.col("text").alias("instead")).join(led, "component_id").dropDuplicates(["component_id"])
        whole = copies.join(led, "component_id", "left_anti").select("doc_id", F.lit(True).alias("is_copy"))
        given = cut_too.join(leads, "component_id").select("doc_id", "found", "instead", F.lit(True).alias("is_copy"))
        full = full.unionByName(given, allowMissingColumns=True).unionByName(whole, allowMissingColumns=True)
        text = F.coalesce("instead", "text").alias("text")
    else:
        full, text = full.withColumn("is_copy", F.lit(False)), "text"
    joined = rows.join(full, "doc_id", "left").select("doc_id", text, "found", F.coalesce("is_copy", F.lit(False)).alias("is_copy"), *(["row"] if carry else []))
    schema = StructType.fromDDL(CLEAN)
    return arrow_map(joined, _delete, schema.add("row", rows.schema["row"].dataType) if carry else schema)
