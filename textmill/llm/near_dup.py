"""MinHash near-duplicates by bottom-k sketches of one hash function.

1. Every text becomes its set of 5-word shingle hashes and the k smallest of them (the sketch). Texts with equal sets
   are one class, stood for by the smallest doc_id; copies are never compared with each other.
2. Inverted lists of retained values: values are ordered by how many classes retain them, rarest first, and each class
   is listed under just enough of its rarest values that two classes which share the values a linked pair must share
   meet in a list. Common passages sort last and so build no lists for texts that hold anything else.
3. Two classes of one list whose similarity, read off the bottom-k of the sketches' union, is within reach of 0.75 fall
   in one bundle. In each list the members are first compared with the smallest class; lists that still hold more than
   one bundle are finished by blocks of members, a matrix product per block pair that yields only the pairs which join
   bundles. No list is capped, and no list's pairs are written out.
4. Inside each bundle, blocks of members are compared on their full shingle sets, again by matrix products over the
   shingles that occur twice: first all with the smallest member, then those not linked with it with all. Similarity of
   0.75 or more is a link, and a cell yields a spanning forest of its links. Components of those are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import arrow_map, components, mix64, shingle_sets, text_chunks, written

SKETCH = 64
NEED = 34  # values a linked pair shares in two sketches of 64: mean 48, standard deviation 3.5, so 4 deviations below
REACH = 0.54  # least estimate that goes on to the exact test: as many deviations below 0.75
BLOCK, BLOCK_VALUES = 512, 1 << 18

PAIRS = "a long, b long"
SIGNED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
    T.StructField("set_lo", T.LongType()), T.StructField("set_hi", T.LongType()), T.StructField("sketch", T.ArrayType(T.LongType())),
])


def _sign(batches: Iterator[pa.RecordBatch], words: int, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, col = batch.column(0), batch.column(1)
        for i, j, raw, offs in text_chunks(col):
            sets = shingle_sets(raw, offs, words)
            n = np.fromiter((len(x) for x in sets), np.int64, len(sets))
            lo = np.fromiter((x.sum(dtype=np.uint64) for x in sets), np.uint64, len(sets))
            hi = np.fromiter((mix64(x).sum(dtype=np.uint64) for x in sets), np.uint64, len(sets))
            kept = np.minimum(n, k)
            flat = np.concatenate([x[:k] for x in sets]) if len(sets) else np.zeros(0, np.uint64)
            offsets = np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                ids.slice(i, j - i), pa.array(n), pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64))),
            ], names=SIGNED.names)


def signatures(docs: DataFrame, words: int = 5, k: int = SKETCH) -> DataFrame:
    """(doc_id, n_shingles, set_lo, set_hi, sketch): size, 128-bit digest and k smallest hashes of each shingle set."""
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), lambda b: _sign(b, words, k), SIGNED)


def prefix_length(n: np.ndarray | int, k: int = SKETCH, need: int = NEED, percent: int = 75):
    """How many rarest retained values must be listed, for sets of n shingles."""
    n = np.asarray(n)
    return np.minimum(n, k) - np.minimum(-(-n * percent // 100), need) + 1


def estimates(sketches: list[np.ndarray], others: list[np.ndarray], shared: np.ndarray, n: np.ndarray, m: np.ndarray, k: int = SKETCH) -> np.ndarray:
    """Jaccard similarity of each pair of sorted sketches, read off the values up to the smaller of their last ones.

    Both sketches are whole up to there, as is their union; where neither set is larger than its sketch it is exact.
    """
    inf = np.uint64(0xFFFFFFFFFFFFFFFF)
    last = np.array([inf if c <= k else x[-1] for x, c in zip(sketches, n)], np.uint64)
    other = np.array([inf if c <= k else x[-1] for x, c in zip(others, m)], np.uint64)
    a = np.array([np.searchsorted(x, other, "right") for x in sketches]).reshape(len(sketches), len(others))
    b = np.array([np.searchsorted(x, last, "right") for x in others]).reshape(len(others), len(sketches)).T
    return shared / np.maximum(1, a + b - shared)


def _estimated(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = []
        for c in (2, 3):
            col = batch.column(c)
            sides.append((col.values.to_numpy(zero_copy_only=False).view(np.uint64), col.offsets.to_numpy()))
        (va, oa), (vb, ob) = sides
        n, m = batch.column(4).to_numpy(), batch.column(5).to_numpy()
        ok = []
        for i in range(batch.num_rows):
            x, y = va[oa[i] : oa[i + 1]], vb[ob[i] : ob[i + 1]]
            shared = np.array([[len(np.intersect1d(x, y, assume_unique=True))]])
            ok.append(estimates([x], [y], shared, n[i : i + 1], m[i : i + 1])[0, 0] >= least)
        mask = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])


def _sides(batch: pa.RecordBatch, array: str, *fields: str) -> list[list]:
    """For the list columns l and r of a cell: row bounds, the fields of their structs, bounds and values of their arrays."""
    out = []
    for name in ("l", "r"):
        col = batch.column(name)
        m = col.values
        held = m.field(array)
        out.append([col.offsets.to_numpy(), [m.field(f).to_numpy() for f in fields], held.offsets.to_numpy(), held.values.to_numpy()])
    return out


def _cell(sides: list[list], i: int) -> list[list]:
    out = []
    for rows, fields, at, values in sides:
        x, y = rows[i], rows[i + 1]
        out.append([*(f[x:y] for f in fields), np.diff(at[x : y + 1]), values[at[x] : at[y]]])
    return out


def _shared(sizes: np.ndarray, values: np.ndarray, left: int, columns: int = 8192) -> np.ndarray:
    """How many values the first `left` sets share with each of the others; sets lie one after the other in values."""
    distinct, col, n = np.unique(values, return_inverse=True, return_counts=True)
    rank = np.cumsum(n > 1) - 1
    twice = n[col] > 1
    row, col = np.repeat(np.arange(len(sizes)), sizes)[twice], rank[col[twice]]
    out = np.zeros((left, len(sizes) - left), np.float32)
    for c in range(0, int(rank[-1]) + 1 if len(rank) else 0, columns):
        part = (col >= c) & (col < c + columns)
        seen = np.zeros((len(sizes), columns), np.float32)
        seen[row[part], col[part] - c] = 1
        out += seen[:left] @ seen[left:].T
    return out


def _out(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(a, np.int64)), pa.array(np.asarray(b, np.int64))], names=["a", "b"])


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs within reach between two blocks of one list, as many as join its bundles."""
    for batch in batches:
        a, b = [], []
        sides = _sides(batch, "sketch", "cls", "bundle", "n_shingles")
        for i in range(batch.num_rows):
            (lc, lk, ln, ll, lv), (rc, rk, rn, rl, rv) = _cell(sides, i)
            shared = _shared(np.concatenate([ll, rl]), np.concatenate([lv, rv]), len(lc))
            least, most = np.minimum(ln[:, None], rn), np.maximum(ln[:, None], rn)
            ok = (lk[:, None] != rk) & (shared >= np.minimum(-(-least * 3 // 4), NEED)) & (100 * least >= 75 * most)
            if not ok.any():
                continue
            cut = lambda v, w: np.split(v.view(np.uint64), np.cumsum(w)[:-1])
            x, y = np.nonzero(ok & (estimates(cut(lv, ll), cut(rv, rl), shared, ln, rn) >= REACH))
            _, one = np.unique(np.stack([np.minimum(lk[x], rk[y]), np.maximum(lk[x], rk[y])]), axis=1, return_index=True)
            root: dict[int, int] = {}

            def top(k: int, root=root) -> int:
                while (up := root.get(k, k)) != k:
                    k = up
                return k

            for t in one:
                p, q = top(int(lk[x[t]])), top(int(rk[y[t]]))
                if p != q:
                    root[max(p, q)] = min(p, q)
                    a.append(lc[x[t]])
                    b.append(rc[y[t]])
        yield _out(a, b)


def _exact(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Spanning forest of the links between two blocks of one bundle, found on full sets."""
    for batch in batches:
        a, b = [], []
        sides = _sides(batch, "set", "cls")
        for i in range(batch.num_rows):
            (lc, ll, lv), (rc, rl, rv) = _cell(sides, i)
            shared = _shared(np.concatenate([ll, rl]), np.concatenate([lv, rv]), len(lc))
            link = 100 * shared >= percent * (ll[:, None] + rl - shared)
            lab_l, lab_r = lc.copy(), rc.copy()
            far = np.iinfo(np.int64).max
            while True:
                new_r = np.minimum(lab_r, np.where(link, lab_l[:, None], far).min(0, initial=far))
                new_l = np.minimum(lab_l, np.where(link, new_r, far).min(1, initial=far))
                if (new_l == lab_l).all() and (new_r == lab_r).all():
                    break
                lab_l, lab_r = new_l, new_r
            for c, lab in ((lc, lab_l), (rc, lab_r)):
                a += list(lab[c != lab])
                b += list(c[c != lab])
        yield _out(a, b)


def _cells(rows: DataFrame, key: str, member) -> DataFrame:
    """(l, r): every pair of blocks of a key's members, a block with itself too. rows: key, cls, blocks and the member's fields."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    rows = rows.select(key, member.alias("m"), "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select(key, F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), (F.col("block") <= F.col("other")).alias("is_l"), "m")
    cells = rows.groupBy(key, "p", "q").agg(F.collect_list(F.when(F.col("is_l"), F.col("m"))).alias("l"), F.collect_list(F.when(~F.col("is_l"), F.col("m"))).alias("r"))
    return cells.select("l", F.when(F.col("p") == F.col("q"), F.col("l")).otherwise(F.col("r")).alias("r"))


def _blocks(size: str) -> Column:
    """Blocks of at most about BLOCK members and BLOCK_VALUES values."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)), F.ceil(F.sum(size) / F.lit(BLOCK_VALUES)))


SETS = "cls long, set array<long>"


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, raw, offs in text_chunks(batch.column(1)):
            sets = shingle_sets(raw, offs, words)
            at = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets).view(np.int64)))], names=["cls", "set"])


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document.

    Texts that are null or without words have an empty set and link with nothing; a text of fewer than `words` words is
    one shingle. Repeated rows are one document and are all returned; rows that share a doc_id are taken to share the text. A null doc_id keeps
    its row with a null component and kept true. Only doc_id and text are read. An empty table gives no rows.
    """
    sig = written(signatures(docs, words), "signatures")
    member = sig.groupBy("n_shingles", "set_lo", "set_hi").agg(F.min("doc_id").alias("cls"), F.min_by("sketch", "doc_id").alias("sketch"))
    classes = written(member.where("n_shingles > 0 and cls is not null"), "classes")

    held = classes.select("cls", "n_shingles", F.explode("sketch").alias("value"))
    often = written(held.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "often")
    shared = held.join(often, "value").select("cls", "n_shingles", F.struct("df", "value").alias("v"))
    size, need = F.least("n_shingles", F.lit(SKETCH)), F.least(F.ceil(F.col("n_shingles") * percent / 100), F.lit(NEED))
    # values retained once come first in the order, and list nobody
    ranked = shared.groupBy("cls", "n_shingles").agg(F.array_sort(F.collect_list("v")).alias("vs"))
    ranked = ranked.withColumn("take", size - need + 1 - (size - F.size("vs"))).where("take > 0")
    lists = written(ranked.select("cls", "n_shingles", F.explode(F.expr("slice(vs, 1, int(take))")).alias("v")).select("v.value", "cls", "n_shingles"), "lists")

    lead = written(lists.groupBy("value").agg(F.min("cls").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1"), "leads")
    pairs = lists.join(lead, "value").where("cls > lead").select(F.col("lead").alias("a"), F.col("cls").alias("b"), "n_shingles").distinct()
    sk = classes.select(F.col("cls").alias("id"), F.col("sketch"), F.col("n_shingles").alias("n"))
    pairs = (
        written(pairs, "star").join(sk.select(F.col("id").alias("a"), F.col("sketch").alias("sa"), "n"), "a")
        .where("100 * least(n, n_shingles) >= 75 * greatest(n, n_shingles)")
        .join(sk.select(F.col("id").alias("b"), F.col("sketch").alias("sb")), "b")
        .select("a", "b", "sa", "sb", "n", "n_shingles")
    )
    reached = written(arrow_map(pairs, lambda x: _estimated(x, REACH), PAIRS), "reached")
    bundles = components(reached)

    now = lists.join(bundles, lists["cls"] == bundles["id"], "left").select("value", "cls", "n_shingles", F.coalesce("component", "cls").alias("bundle"))
    now = written(now, "members")
    open_ = now.groupBy("value").agg(F.min("bundle").alias("lo"), F.max("bundle").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi")
    open_ = written(open_.select("value", F.ceil(F.col("n") / F.lit(BLOCK)).alias("blocks")), "open")
    cells = _cells(now.join(open_, "value").join(classes.select("cls", "sketch"), "cls"), "value", F.struct("cls", "bundle", "n_shingles", "sketch"))
    more = written(arrow_map(cells, _cross, PAIRS).distinct(), "cross")
    if not more.isEmpty():
        bundles = components(reached.unionByName(more))

    weights = bundles.join(classes.select(F.col("cls").alias("id"), "n_shingles"), "id")
    sized = written(weights.groupBy("component").agg(_blocks("n_shingles").alias("blocks")), "bundles")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(bundles, "id").select("id", "text")
    sets = written(arrow_map(texts, lambda x: _sets(x, words), SETS).dropDuplicates(["cls"]), "full-sets")
    rows = bundles.join(sized, "component").withColumnRenamed("id", "cls").join(sets, "cls")
    member_ = F.struct("cls", "set").alias("m")
    block = F.pmod(F.xxhash64("cls"), F.col("blocks")).alias("block")
    stars = rows.where("cls <> component").select("component", block, member_).groupBy("component", "block").agg(F.collect_list("m").alias("r"))
    stars = stars.join(rows.where("cls = component").select("component", F.array(member_).alias("l")), "component").select("l", "r")
    links = written(arrow_map(stars, lambda x: _exact(x, percent), PAIRS), "star-links")
    # what is not linked with the smallest member of its bundle is compared with all of them
    apart = weights.where("id <> component").join(links.select(F.col("b").alias("id")).distinct(), "id", "left_anti")
    apart = written(apart.select("id", "component", "n_shingles"), "apart")
    if not apart.isEmpty():
        left = apart.groupBy("component").agg(_blocks("n_shingles").alias("u_blocks"))
        open_ = rows.join(written(left, "apart-blocks"), "component").join(apart.select(F.col("id").alias("cls"), F.lit(True).alias("u")), "cls", "left")
        upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
        mine = open_.where("u").select("component", F.pmod(F.xxhash64("cls"), F.col("u_blocks")).alias("p"), upto(F.col("blocks")).alias("q"), member_).groupBy("component", "p", "q").agg(F.collect_list("m").alias("l"))
        every = open_.select("component", upto(F.col("u_blocks")).alias("p"), block.alias("q"), member_).groupBy("component", "p", "q").agg(F.collect_list("m").alias("r"))
        links = links.unionByName(arrow_map(mine.join(every, ["component", "p", "q"]).select("l", "r"), lambda x: _exact(x, percent), PAIRS))
    comp = components(links)
    of = comp.select(F.col("id").alias("cls"), "component")
    classes_of = written(written(member.select("n_shingles", "set_lo", "set_hi", "cls"), "sets").join(of, "cls", "left"), "classes-of")
    out = sig.drop("sketch").join(classes_of, ["n_shingles", "set_lo", "set_hi"])
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "cls"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
