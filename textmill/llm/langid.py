"""Language of code-switched text: a linear-chain conditional random field over words.

Features of a word are hashed byte n-grams (of 2, 3 and 4 bytes, with word-edge marks, so affixes are among them) and
the word itself (a learned lexicon); transitions between the labels of neighbouring words are learned with them by
gradient steps on the log-likelihood (forward-backward). A document's language is the label with the largest share of
the expected words, each weighted by its letters. Training cuts the whole texts of at most SAMPLE documents of each
language (smallest hash) into sequences of SPAN words and takes at most SEQUENCES of each language (smallest hash);
half of them are spliced with another so that switches are seen. Prediction reads whole texts, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import BLANK, LOWER, arrow_map, mix64, text_chunks, words

SAMPLE, SEQUENCES, SPAN = 600, 800, 24
BITS = 15
STEP_BYTES = 12 << 20  # of text go through forward-backward together
U64 = np.uint64


def _letter_bytes() -> np.ndarray:
    t = np.zeros(256, bool)
    t[65:91] = t[97:123] = t[0xC2:0xF5] = True  # a lead byte beyond ASCII; its tail is not counted again
    return t


LETTER = _letter_bytes()


def byte_features(raw: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word index, feature) pairs of every word: n-grams of 2 to 4 bytes including the blanks at its edges, and itself.

    Non-letters of ASCII count as one sign, digits too, so numbers, addresses and punctuation do not name a language.
    """
    low = LOWER[raw].astype(U64)
    low[(raw < 128) & ~LETTER[raw]] = 32
    pad = np.concatenate([np.full(1, 32, U64), low, np.full(4, 32, U64)])
    word = np.repeat(np.arange(len(start)), end - start)
    place = np.arange(int((end - start).sum())) - np.repeat(np.cumsum(end - start) - (end - start), end - start)
    at = np.repeat(start, end - start) + place  # byte of the raw buffer; pad index is one more
    last = np.repeat(end, end - start)
    feats, owner = [], []
    for n in (2, 3, 4):
        g = np.zeros(len(at), U64)
        for j in range(n):
            # the gram starts at the byte before `at`; what lies beyond the word's end is blank
            here = at - 1 + j
            c = np.where((here >= last) | ((j == 0) & (place == 0)), U64(32), pad[np.minimum(here, len(raw)) + 1])
            g = g * U64(257) + c
        ok = (at + n - 2) <= last
        feats.append((mix64(g[ok] * U64(31) + U64(n)) >> U64(64 - BITS)).astype(np.int32))
        owner.append(word[ok])
    # the word itself, hashed over letters only
    c = low[at]
    p = np.cumprod(np.full(64, 1099511628211, U64))
    hw = np.bincount(word, weights=None, minlength=len(start))  # bytes a word
    v = np.where(c == 32, U64(0), c) * p[np.minimum(place, 63)]
    first = np.cumsum(hw) - hw
    lex = mix64(np.add.reduceat(v, first)) if len(start) else np.zeros(0, U64)
    feats.append((lex >> U64(64 - BITS)).astype(np.int32))
    owner.append(np.arange(len(start)))
    return np.concatenate(owner), np.concatenate(feats)


def emissions(raw: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Label scores of each word: the mean weight of its n-grams plus its own weight, scaled by feature count."""
    owner, f = byte_features(raw, start, end, h)
    out = np.zeros((len(start), weights.shape[1]), np.float32)
    for k in range(weights.shape[1]):
        out[:, k] = np.bincount(owner, weights[f, k], minlength=len(start))
    return out


def marginals(e: np.ndarray, trans: np.ndarray, bounds: np.ndarray, pairs: bool = False) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """Posterior label probabilities of every word by forward-backward, all sequences in step; with pairs, also the
    expected number of times each label follows each.

    e: word scores, words of a sequence together; bounds: first word of each sequence and the end.
    """
    n, L = e.shape
    out, expected = np.zeros((n, L), e.dtype), np.zeros((L, L))
    length = np.diff(bounds)
    order = np.argsort(-length, kind="stable")
    length, first = length[order], bounds[:-1][order]
    T = np.exp(trans).astype(e.dtype)
    x = np.exp(e - e.max(1, keepdims=True)) if n else e
    alive = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), "left")  # sequences longer than t
    a = None
    fwd = np.zeros((n, L), e.dtype)
    for t, m in enumerate(alive):
        i = first[:m] + t
        a = x[i] if t == 0 else (a[:m] @ T) * x[i]
        a /= a.sum(1, keepdims=True)
        fwd[i] = a
    b = np.ones((len(length), L), e.dtype)
    for t in range(len(alive) - 1, -1, -1):
        m = alive[t]
        i = first[:m] + t
        p = fwd[i] * b[:m]
        out[i] = p / p.sum(1, keepdims=True)
        b[:m] = x[i] * b[:m]  # what this word and all later ones say, by this word's label
        if pairs and t:
            before = fwd[i - 1]
            expected += T * ((before / ((before @ T) * b[:m]).sum(1, keepdims=True)).T @ b[:m])
        b[:m] = b[:m] @ T.T
        b[:m] /= b[:m].sum(1, keepdims=True)
    return (out, expected) if pairs else out


def gradient(w: np.ndarray, t: np.ndarray, owner: np.ndarray, f: np.ndarray, gold: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the log-likelihood of the gold labels by the feature weights and the transitions: found less expected counts.

    owner, f: which feature is on which word."""
    L = len(t)
    e = np.stack([np.bincount(owner, w[f, k], minlength=len(gold)) for k in range(L)], 1)
    post, expected = marginals(e, t, bounds, pairs=True)
    diff = np.eye(L)[gold] - post
    same = np.ones(max(len(gold) - 1, 0), bool)
    inner = bounds[1:-1]
    same[inner[(inner > 0) & (inner < len(gold))] - 1] = False
    found = np.zeros((L, L))
    np.add.at(found, (gold[:-1][same], gold[1:][same]), 1)
    return np.stack([np.bincount(f, diff[owner, k], minlength=len(w)) for k in range(L)], 1), found - expected


def fit(seqs: list[tuple[bytes, list[int]]], n_labels: int, rounds: int = 40, rate: float = 0.3, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """(feature weights, transitions) by AdaGrad on the conditional log-likelihood of (text, word labels) sequences."""
    raw = np.frombuffer(b"\n".join(s for s, _ in seqs), np.uint8)
    offs = np.cumsum([0] + [len(s) + 1 for s, _ in seqs])
    offs[-1] -= 1
    row, start, end, h = words(raw, offs, BLANK)
    gold = np.concatenate([np.asarray(y) for _, y in seqs])
    bounds = np.searchsorted(row, np.arange(len(seqs) + 1))
    owner, f = byte_features(raw, start, end, h)
    w, t = np.zeros((1 << BITS, n_labels)), np.zeros((n_labels, n_labels))
    gw, gt = np.full_like(w, 1e-3), np.full_like(t, 1e-3)
    for _ in range(rounds):
        grad, gtr = gradient(w, t, owner, f, gold, bounds)
        grad, gtr = grad - decay * len(start) * w, gtr - 0.01 * t
        gw += grad**2
        gt += gtr**2
        w += rate * grad / np.sqrt(gw)
        t += rate * gtr / np.sqrt(gt)
    return w.astype(np.float32), np.clip(t, -6, 6)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def spliced(cut: list[tuple[str, int]]) -> list[tuple[bytes, list[int]]]:
    """Training sequences of (words, label): every other one is followed by one from elsewhere, so that switches are seen."""
    step = max(1, int(len(cut) * 0.382))
    out = []
    for i, (text, k) in enumerate(cut):
        w = text.split(" ")
        text2, k2 = cut[(i + step) % len(cut)] if i % 2 else ("", k)
        w2 = text2.split(" ") if text2 else []
        out.append((" ".join(w + w2).encode(), [k] * len(w) + [k2] * len(w2)))
    return out


PREDICTED = "doc_id long, lang_pred string, score double, n_switched long"


def _predict(batches: Iterator[pa.RecordBatch], weights: np.ndarray, trans: np.ndarray, langs: list[str]) -> Iterator[pa.RecordBatch]:
    L = len(langs)
    names = np.array([*langs, "und"], dtype=object)
    for batch in batches:
        for i, j, raw, offs in text_chunks(batch.column(1), STEP_BYTES):
            part = pa.LargeStringArray.from_buffers(j - i, pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw)))
            share, switched = _shares(part, weights, trans)
            total, top = share.sum(1), share.argmax(1)
            lang = names[np.where(total > 0, top, L)]
            score = np.where(total > 0, share[np.arange(j - i), top] / np.maximum(total, 1e-300), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(lang.tolist(), pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(switched)], names=["doc_id", "lang_pred", "score", "n_switched"])


def _shares(texts: pa.Array, weights: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: expected letters of each label, and how often the best label changes between words."""
    n, L = len(texts), weights.shape[1]
    e_all, row_all, let_all = [], [], []
    for i, _, raw, offs in text_chunks(texts):
        row, start, end, h = words(raw, offs, BLANK)
        if not len(start):
            continue
        at = np.concatenate([[0], np.cumsum(LETTER[raw])])
        letters = at[end] - at[start]
        keep = letters > 0
        e_all.append(emissions(raw, start[keep], end[keep], h[keep], weights))
        row_all.append(row[keep] + i)
        let_all.append(letters[keep])
    share, switched = np.zeros((n, L)), np.zeros(n, np.int64)
    if row_all:
        row, letters = np.concatenate(row_all), np.concatenate(let_all)
        post = marginals(np.concatenate(e_all), trans, np.searchsorted(row, np.arange(n + 1)))
        for k in range(L):
            share[:, k] = np.bincount(row, post[:, k] * letters, minlength=n)
        best = post.argmax(1)
        switched = np.bincount(row[1:][(best[1:] != best[:-1]) & (row[1:] == row[:-1])], minlength=n).astype(np.int64)
    return share, switched


def train(docs: DataFrame, sample: int = SAMPLE, sequences: int = SEQUENCES) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, weights, transitions) from documents with a lang that are not held out: at most `sample` of each
    language, and at most `sequences` of the sequences their whole texts are cut into."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    known = docs.select(F.col("doc_id").cast("long"), "lang", "text").where(~held_out() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    # the smallest hashes of each language first within each slice of the hash, then over the slices: no language in one task
    slice_ = Window.partitionBy("lang", "s").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.select("doc_id", "lang").withColumn("s", F.pmod(F.xxhash64("doc_id"), F.lit(256)))
    ids = ids.withColumn("r", F.row_number().over(slice_)).where(F.col("r") <= sample).withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample)
    chosen = F.broadcast(ids.select("doc_id"))  # at most `sample` ids a language
    # whole texts, cut into sequences of words that hold a letter; of these the smallest hashes
    words_ = F.filter(F.split(F.min("text"), r"[\x20\x09-\x0D]+"), lambda x: x.rlike(r"\p{L}"))
    cut = known.join(chosen, "doc_id", "left_semi").groupBy("doc_id", "lang").agg(words_.alias("w")).where(F.size("w") > 0)
    cut = cut.select("doc_id", "lang", F.explode(F.transform(F.sequence(F.lit(1), F.size("w"), F.lit(SPAN)), lambda i: F.struct(i.alias("i"), F.array_join(F.slice("w", i, SPAN), " ").alias("words")))).alias("s"))
    cut = cut.select("lang", "s.words", F.xxhash64("doc_id", "s.i").alias("h"), "doc_id", "s.i")
    rank = Window.partitionBy("lang").orderBy("h", "doc_id", "i")
    rows = cut.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= sequences).orderBy("h", "doc_id", "i").collect()
    langs = sorted({r.lang for r in rows})
    if not langs:
        return [], np.zeros((1 << BITS, 0), np.float32), np.zeros((0, 0))
    w, t = fit(spliced([(r.words, langs.index(r.lang)) for r in rows]), len(langs))
    return langs, w, t


def predict_language(docs: DataFrame, model: tuple | None = None) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, n_switched (label changes between words).

    A text that is null or has no letter is `und` with score 0, as is every text where no labelled document is there to
    learn from. Only doc_id and text are read for a prediction, and lang for training; null doc_ids are not held out
    and not learned from; repeated rows get the same answer; an empty table gives no rows.
    """
    langs, w, t = model or train(docs)
    rows = docs.select(F.col("doc_id").cast("long"), F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    if not langs:
        return rows.select("doc_id", held_out().alias("held_out"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_switched"))
    out = arrow_map(rows, lambda b: _predict(b, w, t, langs), PREDICTED, 10_000, 16 << 20)  # forward-backward takes texts in step
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_switched")
