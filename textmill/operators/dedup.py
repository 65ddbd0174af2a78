"""Exact duplicates, MinHash signatures over character bigrams, and order-true greedy near-duplicate removal."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from textmill.functions import grams

from ._store import discard, ship, stored

PRIME = 2**31 - 1


@dataclass(frozen=True)
class MinHashConfig:
    num_perm: int = 128
    threshold: float = 0.5
    shingle: int = 2

    @property
    def bands(self) -> tuple[int, int]:
        """(bands, rows): the split whose S-curve has the least area of false positives and negatives together."""
        s = (np.arange(2000) + 0.5) / 2000
        best = (9.0, 1, 1)
        for r in range(1, self.num_perm + 1):
            for b in range(1, self.num_perm // r + 1):
                hit = 1 - (1 - s**r) ** b
                cost = (hit[s < self.threshold].sum() + (1 - hit[s >= self.threshold]).sum()) / 2000
                if cost < best[0] - 1e-12:
                    best = (cost, b, r)
        return best[1:]


def _firsts(df: DataFrame, order: str, md5: str, counts: Column) -> DataFrame:
    """(order, digest, _first) of the first counted record of each digest. It is a min by digest with map-side combine,
    and is joined back by order key and digest together, so a digest that a third of the corpus shares is no hot task."""
    first = df.groupBy(md5).agg(F.min(F.when(counts, F.struct(order))).alias("_o")).where("_o is not null")
    return stored(first.select(F.col("_o")[order].alias(order), md5, F.lit(True).alias("_first")), "first-by-digest")


def exact_dedup(df: DataFrame, order: str = "doc_id", md5: str = "md5") -> DataFrame:
    """The first record of each digest by `order` (a null one comes first). Records with the same digest and order key
    all stay: they are the same record. df is written once, so that what digests are made of is computed once."""
    df = stored(df, "digests")
    first = _firsts(df, order, md5, F.lit(True)).withColumnsRenamed({order: "_k", md5: "_d"})
    return df.join(first, F.col(order).eqNullSafe(F.col("_k")) & F.col(md5).eqNullSafe(F.col("_d")), "left_semi")


def mark_duplicates(df: DataFrame, order: str = "doc_id") -> DataFrame:
    """Sets drop_reason of later records with the digest of an earlier kept one.

    df is written once and not filtered: a filter on drop_reason would be pushed below the rules and run them anew."""
    return marked(stored(df, "reasons"), order)


def marked(df: DataFrame, order: str = "doc_id") -> DataFrame:
    """mark_duplicates of a table that is written already."""
    first = _firsts(df, order, "md5", F.col("drop_reason").isNull()).withColumnsRenamed({order: "_k", "md5": "_d"})
    out = df.join(first, F.col(order).eqNullSafe(F.col("_k")) & F.col("md5").eqNullSafe(F.col("_d")), "left").drop("_k", "_d")
    return out.withColumn("drop_reason", F.when(F.col("drop_reason").isNull() & F.col("_first").isNull(), "md5_duplicate").otherwise(F.col("drop_reason"))).drop("_first")


def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    """a and b of the hash family, by rule: seven hex digits of the MD5 of a0, b0, a1, ..."""
    value = lambda c, k: int(hashlib.md5(f"{c}{k}".encode()).hexdigest()[:7], 16)
    return np.array([value("a", k) + 1 for k in range(n)], np.uint64), np.array([value("b", k) for k in range(n)], np.uint64)


def _sign(batches: Iterator[pa.RecordBatch], cfg: MinHashConfig) -> Iterator[pa.RecordBatch]:
    a, b = (x.astype(np.uint64) for x in coefficients(cfg.num_perm))
    known: dict[str, int] = {}
    for batch in batches:
        for i, j, codes, bounds in grams.pieces(batch.column(1)):
            row, gram, _, example = grams.counted(codes, bounds, cfg.shingle)
            said = [codes[x : x + cfg.shingle].tobytes().decode("utf-32-le") for x in example.tolist()]
            for r in np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < cfg.shingle)):  # a shorter text is its own gram
                row, gram = np.append(row, r), np.append(gram, len(said))
                said.append(codes[bounds[r] : bounds[r + 1]].tobytes().decode("utf-32-le"))
            for g in said:
                if g not in known:
                    known[g] = int(hashlib.md5(g.encode()).hexdigest()[:7], 16)
            h = np.array([known[g] for g in said], np.uint64)
            every = ((h[:, None] * a + b) % np.uint64(PRIME)).astype(np.int64)
            by_row = np.argsort(row, kind="stable")
            row, gram = row[by_row], gram[by_row]
            have, first = np.unique(row, return_index=True)
            low = np.zeros((len(have), cfg.num_perm), np.int64)
            cuts = np.append(first, len(row))
            for s in range(0, len(have), 64):
                part = cuts[s : s + 65]
                low[s : s + 64] = np.minimum.reduceat(every[gram[part[0] : part[-1]]], part[:-1] - part[0])
            size = np.zeros(j - i, np.int64)
            size[have] = cfg.num_perm
            offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32), mask=np.append(size == 0, False))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(offsets, pa.array(low.ravel()))], names=[batch.schema.names[0], "signature"])
        if len(known) > 1_000_000:
            known.clear()


def signatures(df: DataFrame, cfg: MinHashConfig = MinHashConfig(), text: str = "cleaned_text", key: str = "doc_id") -> DataFrame:
    """(key, signature): the minima of (a * h + b) mod (2^31 - 1) over the hashed grams; null for a text without any."""
    ship(df.sparkSession)
    schema = StructType([df.schema[key], StructField("signature", ArrayType(LongType()))])
    return df.select(key, text).mapInArrow(lambda b: _sign(b, cfg), schema)


def buckets(signed: DataFrame, cfg: MinHashConfig = MinHashConfig(), key: str = "doc_id") -> DataFrame:
    """(key, band, bucket): one row a band, the bucket a digest of the band's minima."""
    b, r = cfg.bands
    band = F.transform(F.sequence(F.lit(0), F.lit(b - 1)), lambda i: F.struct(i.alias("band"), F.md5(F.array_join(F.transform(F.slice("signature", i * r + 1, F.lit(r)), lambda v: v.cast("string")), ",")).alias("bucket")))
    return signed.where("signature is not null").select(key, F.explode(band).alias("x")).select(key, "x.band", "x.bucket")


#: Incidences that one task goes through in order; more are first thinned out by rounds.
LAST_ROWS = 1_000_000


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The kept keys of incidences sorted by key, one after the other."""
    taken: set = set()
    key, own, kept = None, set(), []

    def decide() -> None:
        if own and not own & taken:
            taken.update(own)
            kept.append(key)

    for batch in batches:
        for k, band, bucket in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                decide()
                key, own = k, set()
            own.add((band, bucket))
        yield pa.RecordBatch.from_arrays([pa.array(kept, batch.schema.types[0])], names=["k"])
        kept = []
        schema = batch.schema
    decide()
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(kept, schema.types[0])], names=["k"])


class _Taken:
    """Buckets of kept keys, looked up whole columns at a time: by a 64-bit hash first, then by all their minima."""

    def __init__(self, own: np.ndarray):
        own = own.reshape(-1, own.shape[-1])
        code = self._codes(own)
        by = np.argsort(code, kind="stable")
        self.own, self.code = own[by], code[by]
        self.alike = int(np.unique(code, return_counts=True)[1].max()) if len(code) else 0

    @staticmethod
    def _codes(own: np.ndarray) -> np.ndarray:
        code = np.zeros(own.shape[:-1], np.uint64)
        for i in range(own.shape[-1]):
            code = (code ^ own[..., i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        return code

    def hit(self, own: np.ndarray) -> np.ndarray:
        """Of (texts, bands, 1 + minima) whether each text has a bucket that is taken."""
        code = self._codes(own)
        at, found = np.searchsorted(self.code, code), np.zeros(code.shape, bool)
        for more in range(self.alike):
            i = np.minimum(at + more, max(len(self.code) - 1, 0))
            near = (self.code[i] == code) & ~found
            found[near] = (self.own[i[near]] == own[near]).all(-1)
        return found.any(-1)


def _own(signature: pa.Array, cfg: MinHashConfig) -> np.ndarray:
    """(texts, bands, 1 + rows): the buckets of signatures, each its band and the band's minima, which are below 2^31."""
    b, r = cfg.bands
    low = signature.flatten().to_numpy(zero_copy_only=False).reshape(len(signature), cfg.num_perm)[:, : b * r].reshape(-1, b, r)
    return np.concatenate([np.broadcast_to(np.arange(b)[:, None], (len(low), b, 1)), low], 2).astype(np.int32)


def _greedy(batches: Iterator[pa.RecordBatch], cfg: MinHashConfig) -> Iterator[pa.RecordBatch]:
    """The rows (key, signature), sorted by key, that going through them keeps. Rows of one key are one text."""
    taken: set[bytes] = set()
    key, own, rows = None, set(), []

    def decide() -> list[tuple]:
        if not own or own & taken:
            return []
        taken.update(own)
        return rows

    for batch in batches:
        out: list[tuple] = []
        own_of = _own(batch.column(1), cfg)
        for k, s, buckets in zip(batch.column(0).to_pylist(), batch.column(1), own_of.view(f"V{4 * own_of.shape[2]}")[..., 0].tolist()):
            if k != key:
                out += decide()
                key, own, rows = k, set(), []
            own.update(buckets)
            rows.append((k, s))
        schema = batch.schema
        yield _batch(out, schema)
    if out := decide():
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], schema.types[0]), pa.array([s.as_py() for _, s in rows], schema.types[1])], names=schema.names)


def _head(df: DataFrame, key: str, n: int, most: int) -> object:
    """A key with about `most` of the n rows of df up to it, from a sample of some 10,000 keys by hash; None if there is
    none. What lies up to it only bounds the work of one task, so the sample decides no result."""
    every = max(1, n // 10_000)
    sample = df.where(F.col(key).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(every)) == 0)).select(key)
    return sample.orderBy(key).limit(max(1, most // every)).agg(F.max(key)).first()[0]


def greedy_signed(signed: DataFrame, cfg: MinHashConfig = MinHashConfig(), key: str = "doc_id", last: int = LAST_ROWS) -> DataFrame:
    """greedy_near_dedup of the buckets of (key, signature), which is written already.

    What going through the first keys in order keeps does not depend on later ones, so one task goes through as many as
    have `last` incidences. The buckets of those kept, `last` at most, go to the executors, and every later text that has
    one of them is dropped where it is: nothing is shuffled, and only what is left is written. As long as that drops half
    of the texts or more, it is done again; texts that are mostly unlike go through the rounds of greedy_near_dedup."""
    spark, most = signed.sparkSession, max(1, last // cfg.bands[0])
    ship(spark)
    open_, kept, k = signed.where("signature is not null").select(key, "signature"), None, F.col(key)
    n, mine = open_.count(), None
    while n > most and (bound := _head(open_, key, n, most)) is not None:
        first = open_.where(k.isNull() | (k <= F.lit(bound)))
        if first.count() > 4 * most:  # one key has very many rows
            break
        first = stored(first.repartition(1).sortWithinPartitions(key).mapInArrow(lambda b: _greedy(b, cfg), open_.schema), "kept-first")
        lows = first.select("signature").toArrow().column(0).combine_chunks()
        taken = spark.sparkContext.broadcast(_Taken(_own(lows, cfg)))

        def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = taken.value
            for batch in batches:
                for i in range(0, len(batch), 4096):
                    part = batch.slice(i, 4096)
                    yield part.filter(pa.array(~known.hit(_own(part.column(1), cfg))))

        left = stored(open_.where(k > F.lit(bound)).mapInArrow(later, open_.schema), "open")
        kept = first.select(key) if kept is None else kept.unionByName(first.select(key))
        if mine is not None:
            discard(mine)
        open_ = mine = left
        was, n = n, left.count()
        if 2 * n > was:
            break
    rest = open_.coalesce(1).sortWithinPartitions(key).mapInArrow(lambda b: _greedy(b, cfg), open_.schema).select(key) if n <= most else greedy_near_dedup(buckets(open_, cfg, key), key, last)
    return rest if kept is None else kept.unionByName(rest)


def greedy_near_dedup(incidence: DataFrame, key: str = "doc_id", last: int = LAST_ROWS) -> DataFrame:
    """The keys that going through them in order keeps, where a key is dropped if it shares a bucket with a kept one.

    Rounds over the bucket incidence, no pairs: a key that is the smallest undecided one in all its buckets is kept, and
    every undecided key that shares a bucket with a kept one is dropped. Buckets are only aggregated to minima
    (map-side), so one that holds a third of all keys is harmless. Each round writes what is still undecided; when that
    is `last` rows or fewer, one task goes through the rest in order. A row that occurs twice changes nothing.
    """
    open_ = stored(incidence.select(F.col(key).alias("k"), "band", "bucket"), "incidence")
    kept = None
    while open_.count() > last:
        lead = open_.groupBy("band", "bucket").agg(F.min("k").alias("lead"))
        led = stored(open_.join(lead, ["band", "bucket"]), "led")
        firsts = stored(led.groupBy("k").agg(F.min("lead").alias("lead")).where("k = lead").select("k"), "kept")
        kept = firsts if kept is None else kept.unionByName(firsts)
        gone = led.join(firsts.withColumnRenamed("k", "lead"), "lead", "left_semi").select("k").distinct()
        left = stored(led.join(gone, "k", "left_anti").drop("lead"), "open")
        discard(open_, led)
        open_ = left
    ship(open_.sparkSession)
    rest = open_.coalesce(1).sortWithinPartitions("k").mapInArrow(_in_order, StructType([open_.schema["k"]]))
    return (rest if kept is None else kept.unionByName(rest)).withColumnRenamed("k", key)


def near_dedup(df: DataFrame, cfg: MinHashConfig = MinHashConfig(), text: str = "cleaned_text", key: str = "doc_id") -> DataFrame:
    """The records that greedy near-duplicate removal keeps, in order of key; texts without grams always stay."""
    return df.join(near_kept(df, cfg, text, key), key, "left_semi")


def near_kept(df: DataFrame, cfg: MinHashConfig = MinHashConfig(), text: str = "cleaned_text", key: str = "doc_id") -> DataFrame:
    """The keys that near_dedup keeps, written: where they are few, what is joined with them need not be shuffled."""
    signed = stored(signatures(df, cfg, text, key), "signatures")
    kept = greedy_signed(signed, cfg, key)
    return stored(kept.unionByName(signed.where("signature is null").select(key)), "kept-keys")
