"""Embedding near-duplicates over hierarchical navigable small-world graphs, one a shard.

Distinct vectors are dealt to shards by hash; each shard's graph is built in the task that holds it, and every distinct
vector queries every shard. Queries walk the layers in step, as NumPy arrays. A query whose whole beam is links is
asked again with a beam twice as wide, and a shard's first beam is doubled until an audit of AUDIT of its own vectors and
as many planted neighbours against brute force finds RECALL of the links, those of a vector to itself left out. What is found is verified by cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import arrow_map, components, mix64, written

SHARDS, SHARD_ROWS = 8, 250_000
M, BEAM, WIDTH = 12, 32, 4
AUDIT, RECALL = 256, 0.98
SLACK = 1e-4


def _select(v: np.ndarray, cand: np.ndarray, sims: np.ndarray, m: int) -> np.ndarray:
    """Up to m neighbours out of candidates (-1: none), sorted by falling similarity: first those nearer to the vector
    than to any chosen one, so that edges lead out of clusters, then the nearest others."""
    out = np.full((len(cand), m), -1, np.int32)
    for s in range(0, len(cand), 512):
        c, x = cand[s : s + 512], sims[s : s + 512]
        vc = v[np.maximum(c, 0)]
        g = vc @ vc.transpose(0, 2, 1)
        chosen = np.zeros(c.shape, bool)
        count = np.zeros(len(c), np.int64)
        for j in range(c.shape[1]):
            ok = (c[:, j] >= 0) & (count < m) & (np.where(chosen, g[:, j, :], -2).max(1) < x[:, j])
            chosen[:, j] = ok
            count += ok
        rank = np.where(c < 0, 3e6, np.where(chosen, 0, 1e6) + np.arange(c.shape[1]))
        first = np.argsort(rank, 1, kind="stable")[:, :m]
        got = np.take_along_axis(c, first, 1)
        out[s : s + 512, : got.shape[1]] = got
    return out


class Layer:
    """One layer: rows of neighbours of its nodes; nodes are inserted in the order given, upper ones first."""

    def __init__(self, v: np.ndarray, nodes: np.ndarray, degree: int):
        self.v, self.nodes = v, nodes
        self.links = np.full((len(v), degree), -1, np.int32)

    def search(self, q: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the beam nearest nodes found from the entries, nearest first; -1 fills up."""
        n = len(q)
        ids = np.full((n, beam), -1, np.int32)
        sims = np.full((n, beam), -3, np.float32)
        seen = np.zeros((n, len(self.v) + 1), bool)
        seen[:, -1] = True
        entry = entry[:, :beam]
        e = np.where(entry < 0, len(self.v), entry)
        ids[:, : entry.shape[1]] = entry
        sims[:, : entry.shape[1]] = np.where(entry < 0, -3, np.einsum("qd,qkd->qk", q, self.v[np.maximum(entry, 0)]))
        np.put_along_axis(seen, e, True, 1)
        done = ids < 0
        live = np.arange(n)
        while len(live):
            open_ = np.where(done[live], -4, sims[live])
            w = min(WIDTH, beam)
            best = np.argpartition(-open_, w - 1, 1)[:, :w] if w < beam else np.broadcast_to(np.arange(beam), (len(live), beam))
            val = np.take_along_axis(open_, best, 1)
            go = val.max(1) > -3
            live, best, val = live[go], best[go], val[go]
            if not len(live):
                break
            at = np.where(val > -3, np.take_along_axis(ids[live], best, 1), -1)
            flag = done[live]
            np.put_along_axis(flag, best, True, 1)
            nb = np.where(at[:, :, None] >= 0, self.links[np.maximum(at, 0)], -1).reshape(len(live), -1)
            nb = np.sort(nb, 1)
            nb[:, 1:][nb[:, 1:] == nb[:, :-1]] = -1
            slot = np.where(nb < 0, len(self.v), nb)
            fresh = ~seen[live[:, None], slot]
            seen[live[:, None], slot] = True
            nb = np.where(fresh, nb, -1)
            new = np.where(fresh, np.einsum("qd,qkd->qk", q[live], self.v[np.maximum(nb, 0)]), -3)
            all_s, all_i = np.concatenate([sims[live], new], 1), np.concatenate([ids[live], nb], 1)
            all_d = np.concatenate([flag, nb < 0], 1)
            top = np.argpartition(-all_s, beam - 1, 1)[:, :beam]
            sims[live], ids[live], done[live] = (np.take_along_axis(a, top, 1) for a in (all_s, all_i, all_d))
        order = np.argsort(-sims, 1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def insert(self, new: np.ndarray, cand: np.ndarray, sims: np.ndarray, m: int) -> None:
        own = self.v[new] @ self.v[new].T
        np.fill_diagonal(own, -3)
        k = min(16, len(new) - 1)
        if k:
            near = np.argpartition(-own, k - 1, 1)[:, :k]
            cand = np.concatenate([cand, new[near]], 1)
            sims = np.concatenate([sims, np.take_along_axis(own, near, 1)], 1)
        if not cand.shape[1]:
            return
        order = np.argsort(-sims, 1, kind="stable")[:, :48]
        got = _select(self.v, np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1), m)
        self.links[new, : got.shape[1]] = got
        src, dst = np.repeat(new, got.shape[1]), got.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        target, first, count = np.unique(dst, return_index=True, return_counts=True)
        pad = np.full((len(target), int(count.max()) if len(count) else 0), -1, np.int32)
        pad[np.repeat(np.arange(len(target)), count), np.arange(len(dst)) - np.repeat(first, count)] = src
        for s in range(0, len(target), 256):
            t = target[s : s + 256]
            width = int(count[s : s + 256].max())
            c = np.sort(np.concatenate([self.links[t], pad[s : s + 256, :width]], 1), 1)
            c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
            x = np.where(c < 0, -3, np.einsum("qd,qkd->qk", self.v[t], self.v[np.maximum(c, 0)]))
            order = np.argsort(-x, 1, kind="stable")[:, :64]
            self.links[t] = _select(self.v, np.take_along_axis(c, order, 1), np.take_along_axis(x, order, 1), self.links.shape[1])


class Graph:
    def __init__(self, v: np.ndarray, key: np.ndarray, m: int = M):
        """v: unit vectors (float32); key: 64-bit hashes that fix levels and order."""
        self.v = v
        level = np.floor(-np.log((mix64(key) >> np.uint64(11)).astype(float) / 2**53 + 1e-17) / np.log(16)).astype(int)
        order = np.lexsort([key, -level])
        top = int(level.max()) if len(level) else 0
        self.layers: list[Layer] = []
        for lv in range(top, -1, -1):
            nodes = order[level[order] >= lv].astype(np.int32)
            if len(nodes) < 32 and lv:
                continue
            layer = Layer(v, nodes, m if lv else 2 * m)
            held = min(len(nodes), 64)
            layer.insert(nodes[:held], np.zeros((held, 0), np.int32), np.zeros((held, 0), np.float32), m)
            while held < len(nodes):
                new = nodes[held : held + min(held, 1024)]
                entry = self.enter(v[new], layer)
                cand, sims = layer.search(v[new], entry, 48)
                layer.insert(new, cand, sims, m)
                held += len(new)
            self.layers.append(layer)

    def enter(self, q: np.ndarray, layer: Layer | None = None) -> np.ndarray:
        """Entries into the next layer: the four nearest found in the layers above, or the first nodes of the top."""
        first = (self.layers[0] if self.layers else layer).nodes[:4]
        entry = np.broadcast_to(first, (len(q), len(first)))
        for up in self.layers if layer is not None else self.layers[:-1]:
            entry = up.search(q, entry, 8)[0][:, :4]
        return entry

    def near(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        return self.layers[-1].search(q, self.enter(q), beam)


class Shard:
    """A shard's vectors, graph and running union of the vectors that share a link."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, vectors: np.ndarray, least: float):
        self.ids, self.counts, self.least = ids, counts, least
        self.unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.v = self.unit.astype(np.float32)
        self.graph = Graph(self.v, mix64(ids.view(np.uint64)))
        self.label = np.arange(len(ids))
        self.beam, self.recall = self.audited()

    def audited(self) -> tuple[int, float]:
        """(beam, recall): the beam is doubled until AUDIT queries on either side find RECALL of their links.

        The queries are own vectors, dealt by hash, without their links to themselves, and as many moved away from them
        to a cosine between the threshold and 1, half of them just above it; so links are there to be found even where
        the shard holds none."""
        picked = np.argsort(mix64(self.ids.view(np.uint64) ^ np.uint64(0x5EED)))[:AUDIT]
        rnd = np.random.default_rng(len(self.ids))
        away = rnd.normal(size=(len(picked), self.v.shape[1]))
        away -= (away * self.unit[picked]).sum(1, keepdims=True) * self.unit[picked]
        away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
        at = self.least + (1 - self.least) * np.where(np.arange(len(picked)) % 2, rnd.random(len(picked)), 0.02)[:, None]
        moved = at * self.unit[picked] + np.sqrt(1 - at**2) * away
        asked = np.concatenate([self.v[picked], moved.astype(np.float32)])
        owner = np.concatenate([picked, np.full(len(picked), -1)])
        truth = 0
        for s in range(0, len(asked), 64):
            part = asked[s : s + 64] @ self.v.T >= self.least
            truth += int(part.sum()) - int(part[np.arange(len(part)), owner[s : s + 64]][owner[s : s + 64] >= 0].sum())
        beam = min(BEAM, len(self.v))
        while True:
            self.beam = beam
            a, b = self.found(asked, self.least)
            recall = float((b != owner[a]).sum()) / truth if truth else 1.0
            if recall >= RECALL or beam == len(self.v):
                return beam, recall
            beam = min(2 * beam, len(self.v))

    def links(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, vector) of what is found at the threshold, in single precision with slack."""
        return self.found(q.astype(np.float32), self.least - SLACK)

    def found(self, v: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        a, b = [], []
        todo, beam = np.arange(len(v)), self.beam
        while len(todo):
            again = []
            step = max(16, min(1024, (1 << 26) // len(self.v)))
            for s in range(0, len(todo), step):
                part = todo[s : s + step]
                ids, sims = self.graph.near(v[part], beam)
                full = (sims[:, -1] >= least) & (beam < len(self.v))
                again.append(part[full])
                x, y = np.nonzero((sims >= least) & ~full[:, None])
                a.append(part[x])
                b.append(ids[x, y])
            todo, beam = np.concatenate(again), min(2 * beam, len(self.v))
        return np.concatenate(a), np.concatenate(b)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            la, lb = self.label[a], self.label[b]
            low = np.minimum(la, lb)
            np.minimum.at(self.label, la, low)
            np.minimum.at(self.label, lb, low)
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]
            open_ = self.label[a] != self.label[b]
            a, b = a[open_], b[open_]

    def ask(self, ids: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each query: links found (copies counted) and one vector linked to (-1: none)."""
        unit = q / np.linalg.norm(q, axis=1, keepdims=True)
        a, b = self.links(unit)
        ok = self.ids[b] != ids[a]
        a, b = a[ok], b[ok]
        exact = np.concatenate([np.einsum("ij,ij->i", unit[a[s : s + (1 << 16)]], self.unit[b[s : s + (1 << 16)]]) for s in range(0, len(a), 1 << 16)] or [np.zeros(0)])
        a, b = a[exact >= self.least], b[exact >= self.least]
        n = np.bincount(a, self.counts[b], minlength=len(ids)).astype(np.int64)
        to = np.full(len(ids), -1)
        to[a[::-1]] = b[::-1]
        self.union(to[a], b)
        return ids, n, np.where(to >= 0, self.ids[np.maximum(to, 0)], -1)


FOUND = "cls long, n long, to long"


def _serve(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, its own vectors first (role 0), then the queries (role 1)."""

    def out(a, b, c) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (a, b, c)], names=["cls", "n", "to"])

    def close(shard: Shard) -> pa.RecordBatch:
        moved = np.flatnonzero(shard.label != np.arange(len(shard.ids)))
        return out(shard.ids[moved], np.zeros(len(moved)), shard.ids[shard.label[moved]])

    at, held, shard = None, [], None
    for batch in batches:
        key, role, cls, n = (batch.column(c).to_numpy() for c in range(4))
        col = batch.column(4)
        offs = col.offsets.to_numpy()
        values = col.values.to_numpy(zero_copy_only=False)
        edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (role[1:] != role[:-1])]))
        for s, e in zip(edge, [*edge[1:], len(key)]):
            if key[s] != at:
                if shard is not None:
                    yield close(shard)
                at, held, shard = key[s], [], None
            vectors = values[offs[s] : offs[e]].reshape(e - s, -1).astype(np.float64)
            if role[s] == 0:
                held.append((cls[s:e], n[s:e], vectors))
                continue
            if shard is None:
                if not held:
                    continue
                shard = Shard(*(np.concatenate(x) for x in zip(*held)), least)
                held = []
            yield out(*shard.ask(cls[s:e], vectors))
    if shard is not None:
        yield close(shard)


def link_embeddings(embeddings: DataFrame, least: float = 0.9, shards: int = SHARDS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing; vectors of different
    length are not compared. Equal vectors are one class, whose copies link with each other and share all links. Rows
    with a null vec_id count as vectors but not as names of components; a component of those alone is null and kept.
    Repeated rows are vectors of their own. Other columns are not read; vectors may have any length. An empty table gives
    no rows.
    """
    e = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.coalesce(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    e = e.withColumn("v", F.when(sound, F.col("v")))
    rows = written(e.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), "v")), "vectors")
    # a class is named by its smallest vec_id; one without any gets a name below all of them
    classes = rows.where("v is not null").groupBy("h1", "h2").agg(F.min("vec_id").alias("cls"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    classes = written(classes.withColumn("nameless", F.col("cls").isNull()).withColumn("cls", F.coalesce("cls", -F.abs(F.col("h1") % (2**60)) - F.lit(2**61))), "classes")
    links = None
    for dim, n in sorted((r["dim"], r["count"]) for r in classes.groupBy(F.size("v").alias("dim")).count().collect()):
        some = classes.where(F.size("v") == dim).select("cls", "n", "v")
        count = max(min(shards, -(-n // 64)), -(-n // shard_rows))
        own = some.select(F.pmod(F.xxhash64(F.lit(3), "cls"), F.lit(count)).alias("shard"), F.lit(0).alias("role"), "cls", "n", "v")
        asks = some.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))).alias("shard"), F.lit(1).alias("role"), "cls", "n", "v")
        dealt = own.unionByName(asks).repartitionByRange(count, "shard").sortWithinPartitions("shard", "role")
        found = arrow_map(dealt, lambda b: _serve(b, least), FOUND)
        links = found if links is None else links.unionByName(found)
    if links is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = written(links, "links")
    comp = components(links.where("to != -1").select(F.col("cls").alias("a"), F.col("to").alias("b")))
    counts = links.groupBy("cls").agg(F.sum("n").alias("found"))
    of = classes.select("h1", "h2", "cls", "n", "nameless").join(counts, "cls").join(comp, F.col("cls") == F.col("id"), "left")
    of = of.withColumn("component", F.coalesce("component", "cls"))
    # names of components: the smallest vec_id that is one
    named = of.where("not nameless").groupBy("component").agg(F.min("cls").alias("component_id"))
    of = written(of.join(named, "component", "left").select("h1", "h2", (F.col("found") + F.col("n") - 1).alias("links"), "component_id"), "of")
    out = rows.select("vec_id", "h1", "h2", F.col("v").isNotNull().alias("ok")).join(of, ["h1", "h2"], "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(F.col("ok"), F.col("links")).otherwise(F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
