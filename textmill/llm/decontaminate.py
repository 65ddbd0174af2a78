"""Benchmark decontamination: BM25 with block-max WAND over an inverted index of the test items.

The index holds word bigrams (single words of a passage would bring up most items); impacts are BM25 scores divided by
the item's score against itself, so one threshold serves items of any length. Every training text is cut into passages
that overlap by half, each passage is a query, and all items at or above the threshold are retrieved. A retrieved item
counts if enough of its five-word shingles are in the passage and both its question and its answer overlap.

Test items are indexed in shards of at most SHARD_ITEMS in all (items of like length together), which is what a task
holds and what one scan of the texts searches for.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import BLANK_OR_PUNCT, arrow_map, discard, gram_hashes, text_buffers, text_chunks, words, written

SHARD_ITEMS = 20_000
RETRIEVE, CONTAIN, PART = 0.5, 0.75, 0.5
LEAST_WORDS = 5
K1, B = 0.9, 0.4
BLOCK = 16
BLOOM = 22


class Index:
    """Postings of a shard of items: for each bigram the items (ascending), their impacts and the maxima of blocks."""

    def __init__(self, items: list[tuple[int, str]]):
        raw, offs = text_buffers(_strings([t for _, t in items]))
        row, _, _, h = words(raw, offs, BLANK_OR_PUNCT)
        at = np.searchsorted(row, np.arange(len(items) + 1))
        own = [h[a:b] for a, b in zip(at, at[1:])]
        self.ids = [i for (i, _), w in zip(items, own)]
        self.words = own
        self.longest = max((len(w) for w in own), default=0)
        grams = [gram_hashes(w, 2) for w in own]
        n = len(items)
        every, df = np.unique(np.concatenate([np.unique(g) for g in grams]) if grams else np.zeros(0, np.uint64), return_counts=True)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        mean = max(1.0, float(np.mean([len(g) for g in grams])) if grams else 1.0)
        posts: list[list] = [[] for _ in every]
        for i, g in enumerate(grams):
            terms, tf = np.unique(g, return_counts=True)
            pos = np.searchsorted(every, terms)
            impact = idf[pos] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(g) / mean))
            for p, v in zip(pos, impact / max(impact.sum(), 1e-12)):
                posts[p].append((i, float(v)))
        self.terms, self.post = every, []
        for p in posts:
            ids, imp = [i for i, _ in p], [v for _, v in p]
            self.post.append((ids, imp, [max(imp[j : j + BLOCK]) for j in range(0, len(imp), BLOCK)], max(imp)))
        self.most = np.array([p[3] for p in self.post])
        self.bloom = np.zeros(1 << BLOOM, bool)
        self.bloom[(every >> np.uint64(64 - BLOOM)).astype(np.int64)] = True
        self.shingles = [np.unique(gram_hashes(w, 5)) if len(w) >= 5 else gram_hashes(w, len(w)) for w in own]
        self.halves = [(np.unique(gram_hashes(w[: -(-len(w) // 2)], 2)), np.unique(gram_hashes(w[-(-len(w) // 2) :], 2))) for w in own]


def _strings(x: list) -> pa.Array:
    return pc.utf8_lower(pa.array([t or "" for t in x], pa.string()))


def block_max_wand(lists: list[tuple], least: float) -> list[tuple[int, float]]:
    """(item, score) of all items whose impacts sum to `least` or more. lists: (items, impacts, block maxima, maximum)."""
    out, least = [], least - 1e-9
    at = [0] * len(lists)
    live = list(range(len(lists)))
    while live:
        live.sort(key=lambda k: lists[k][0][at[k]])
        bound, pivot = 0.0, -1
        for n, k in enumerate(live):
            bound += lists[k][3]
            if bound >= least:
                pivot = n
                break
        if pivot < 0:
            break
        d = lists[live[pivot]][0][at[live[pivot]]]
        while pivot + 1 < len(live) and lists[live[pivot + 1]][0][at[live[pivot + 1]]] == d:
            pivot += 1
        head = live[: pivot + 1]
        places = [bisect_left(lists[k][0], d, at[k]) for k in head]
        block = sum(lists[k][2][p // BLOCK] for k, p in zip(head, places) if p < len(lists[k][0]))
        if block >= least:
            score = 0.0
            for k, p in zip(head, places):
                items = lists[k][0]
                if p < len(items) and items[p] == d:
                    score += lists[k][1][p]
                    p += 1
                at[k] = p
            if score >= least:
                out.append((d, score))
        else:  # no item before the end of the nearest block, nor before the next list's, can reach it
            ends = [lists[k][0][min(len(lists[k][0]), (p // BLOCK + 1) * BLOCK) - 1] + 1 for k, p in zip(head, places) if p < len(lists[k][0])]
            if pivot + 1 < len(live):
                ends.append(lists[live[pivot + 1]][0][at[live[pivot + 1]]])
            nxt = max(min(ends), d + 1) if ends else d + 1
            for k in head:
                at[k] = bisect_left(lists[k][0], nxt, at[k])
        live = [k for k in live if at[k] < len(lists[k][0])]
    return out


def passages(n_words: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end word) of the passages of texts: 2 * stride words every stride, so that whatever is no
    longer than stride lies in one."""
    count = np.maximum(1, -(-n_words // stride) - 1)
    text = np.repeat(np.arange(len(n_words)), count)
    k = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return text, k * stride, np.minimum(k * stride + 2 * stride, n_words[text])


def search(index: Index, row: np.ndarray, h: np.ndarray, texts: int, retrieve: float = RETRIEVE, contain: float = CONTAIN, part: float = PART) -> list[tuple]:
    """(text, item, first word, score, containment, question overlap, answer overlap), the best passage of each pair.

    row, h: the text and hash of each word of `texts` texts."""
    if len(h) < 2 or not len(index.terms):
        return []
    g = gram_hashes(h, 2)
    may = np.flatnonzero(index.bloom[(g >> np.uint64(64 - BLOOM)).astype(np.int64)] & (row[:-1] == row[1:]))
    pos = np.minimum(np.searchsorted(index.terms, g[may]), len(index.terms) - 1)
    is_term = index.terms[pos] == g[may]
    may, pos = may[is_term], pos[is_term]
    total = np.zeros(len(g) + 2)
    total[may + 1] = index.most[pos]
    total = np.cumsum(total)
    first = np.searchsorted(row, np.arange(texts))
    n_words = np.searchsorted(row, np.arange(texts), "right") - first
    text, a, b = passages(n_words, max(8, index.longest))
    a, b = a + first[text], b + first[text]
    best: dict[tuple, tuple] = {}
    for t in np.flatnonzero(total[np.maximum(b - 1, a)] - total[a] >= retrieve - 1e-9):
        lo, hi = np.searchsorted(may, [a[t], b[t] - 1])
        lists = [index.post[p] for p in np.unique(pos[lo:hi])]
        for item, score in block_max_wand(lists, retrieve):
            own, w = index.shingles[item], h[a[t] : b[t]]
            k = min(5, len(index.words[item]))
            inside = float(np.isin(own, gram_hashes(w, k)).mean()) if len(own) else 0.0
            two = gram_hashes(w, 2)
            q, ans = (float(np.isin(x, two).mean()) if len(x) else 1.0 for x in index.halves[item])
            key = (int(text[t]), item)
            if inside >= contain and q >= part and ans >= part and (inside, score) > best.get(key, (0, (0.0, 0.0)))[1]:
                best[key] = (int(a[t] - first[text[t]]), (inside, score), q, ans)
    return [(text, index.ids[item], at, s[1], s[0], q, ans) for (text, item), (at, s, q, ans) in best.items()]


class Short:
    """Items of fewer than LEAST_WORDS words, found as their whole sequence of words."""

    def __init__(self, items: list[tuple[int, str]]):
        raw, offs = text_buffers(_strings([t for _, t in items]))
        row, _, _, h = words(raw, offs, BLANK_OR_PUNCT)
        at = np.searchsorted(row, np.arange(len(items) + 1))
        self.of: dict[int, dict[int, list[int]]] = {}
        for (i, _), a, b in zip(items, at, at[1:]):
            if b > a:
                self.of.setdefault(int(b - a), {}).setdefault(int(gram_hashes(h[a:b], int(b - a))[0]), []).append(i)
        self.known = {n: np.array(sorted(x), np.uint64) for n, x in self.of.items()}

    def search(self, row: np.ndarray, h: np.ndarray) -> list[tuple]:
        out: dict[tuple, tuple] = {}
        for n, known in self.known.items():
            g = gram_hashes(h, n)
            for t in np.flatnonzero(np.isin(g, known) & (row[: len(g)] == row[n - 1 :][: len(g)])):
                for item in self.of[n][int(g[t])]:
                    out.setdefault((int(row[t]), item), (int(t - np.searchsorted(row, row[t])), 1.0, 1.0, 1.0, 1.0))
        return [(*k, *v) for k, v in out.items()]


FOUND = "doc_id long, item_id long, first_word long, score double, containment double, question_overlap double, answer_overlap double"
_built: dict[str, tuple] = {}


def _indexes(name: str, shards: list[list[tuple[int, str]]], short: list[tuple[int, str]]) -> tuple:
    """The indexes of one scan, built once in a worker."""
    if name not in _built:
        _built.clear()
        _built[name] = ([Index(x) for x in shards], Short(short))
    return _built[name]


def _search(batches: Iterator[pa.RecordBatch], name: str, items, limits: tuple) -> Iterator[pa.RecordBatch]:
    indexes, short = _indexes(name, *items.value)
    for batch in batches:
        rows = []
        for i, j, raw, offs in text_chunks(pc.utf8_lower(batch.column(1))):
            row, _, _, h = words(raw, offs, BLANK_OR_PUNCT)
            for found in (short.search(row, h), *(search(index, row, h, j - i, *limits) for index in indexes)):
                rows += [(i + r[0], *r[1:]) for r in found]
        cols = list(zip(*rows)) if rows else [[]] * 7
        ids = batch.column(0).take(pa.array(cols[0], pa.int64()))
        kinds = [pa.int64(), pa.int64()] + [pa.float64()] * 4
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(cols[1:], kinds))], names=[c.split()[0] for c in FOUND.split(", ")])


def contaminated(docs: DataFrame, benchmark: DataFrame, retrieve: float = RETRIEVE, contain: float = CONTAIN, part: float = PART, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """(doc_id, item_id, first_word, score, containment, question_overlap, answer_overlap), one row per document row and
    test item found in it, for the passage that holds most of the item.

    Words are runs of other than ASCII blanks and punctuation, in lower case. The first half of an item's words is taken
    as its question, the rest as its answer. An item of fewer than 5 words is found where all its words stand one after
    the other. Null items, ones without words and ones without item_id are not searched for; null texts hold nothing; texts are
    searched whole, however long; a repeated item is found once for each of its ids; repeated rows of documents are found
    alike; other columns are not read. Without items or documents the result is empty.

    The texts of at most shard_items items go to the executors together, which index them; more are further scans.
    """
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text").dropDuplicates(["item_id", "text"])
    n_words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D!-/:-@\[-`{-~]+"))
    kind = F.when(F.col("n") >= LEAST_WORDS, F.floor(F.log2("n") / 2).cast("int")).otherwise(-1)
    items = written(items.withColumn("n", n_words).where("n > 0").withColumn("kind", kind), "items")
    scans: list[list[tuple]] = [[]]
    for k, n in sorted((r["kind"], r["count"]) for r in items.groupBy("kind").count().collect()):
        shards = -(-n // shard_items)
        for shard in range(shards):
            if scans[-1] and sum(x[2] for x in scans[-1]) + n / shards > shard_items:
                scans.append([])
            mine = items.where((F.col("kind") == k) & (F.pmod(F.xxhash64("item_id"), F.lit(shards)) == shard)).orderBy("item_id", "text")
            scans[-1].append((k, [(r.item_id, r.text) for r in mine.collect()], n / shards))
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    out = docs.sparkSession.createDataFrame([], FOUND)
    for i, scan in enumerate(x for x in scans if x):
        sent = docs.sparkSession.sparkContext.broadcast(([x for k, x, _ in scan if k >= 0], [y for k, x, _ in scan if k < 0 for y in x]))
        found = arrow_map(rows, lambda b, name=items.stored_at + str(i), sent=sent: _search(b, name, sent, (retrieve, contain, part)), FOUND)
        out = found if not i else out.unionByName(found)
    discard(items)
    return out
