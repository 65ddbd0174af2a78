"""Secret scans: two character Markov models, random strings against ordinary identifiers, by log-likelihood ratio.

Both models are order-1 chains with additive smoothing, trained here from labelled samples that a seeded rule writes
(SAMPLES strings of each label); no corpus row takes part in the fit. A run of SHORTEST characters or more is a secret
if its log-likelihood ratio, a transition counted once, is EVIDENCE or more (random is a hundred thousand times likelier) and its ratio a character is
above the one that one in a thousand held-out ordinary strings passes. A UUID names a thing and is no secret.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import arrow_map

ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
UUID = re.compile(r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")
KINDS = ("assign", "access", "hex", "random")
SAMPLES = 3000
SHORTEST, EVIDENCE = 16, 11.5  # CANDIDATE states the first too

# fixed values: common parts of identifiers and words
PARTS = (
    "get set user name value index count list data file path node token key hash cache config default request response "
    "server client handler manager service factory builder parser reader writer buffer stream string number array object "
    "table column row query filter group order select insert update delete create remove first last next previous parent "
    "child size length width height color style button label image video audio message error warning debug info trace "
    "the and of that with from this have which their would there about could other these into than then some what when "
    "und der die das nicht eine auch sich werden haben durch einer les des une pour dans avec sont plus cette mais los las "
    "una por para con como pero sus entre cuando sobre tion ment ung heit keit lich isch able ness ing tive ado ente"
).split()
ALPHABETS = (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-",
    "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "0123456789abcdef",
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "abcdefghijklmnopqrstuvwxyz",
)
STATES = "^ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CODE = np.zeros(256, np.int64)
CODE[[ord(c) for c in STATES]] = np.arange(len(STATES))


def samples(seed: int, n: int = SAMPLES) -> tuple[list[str], list[str]]:
    """Labelled samples by rule: (random strings, ordinary identifiers)."""
    rnd = random.Random(seed)
    secret = ["".join(rnd.choices(rnd.choice(ALPHABETS), k=rnd.randint(20, 64))) for _ in range(n)]
    plain = []
    for _ in range(n):
        parts = [rnd.choice(PARTS) for _ in range(rnd.randint(3, 9))]
        style = rnd.randrange(7)
        text = ("".join(parts), "_".join(parts), "-".join(parts), "/".join(parts), "".join(p.title() for p in parts), "_".join(parts).upper(), parts[0] + "".join(p.title() for p in parts[1:]))[style]
        if rnd.random() < 0.25:
            text += rnd.choice(("", "_", "-", "/")) + str(rnd.randrange(10 ** rnd.randint(1, 4)))
        if rnd.random() < 0.06:
            text = rnd.choice("-=_+/") * rnd.randint(20, 60)
        if rnd.random() < 0.05:
            text = f"{rnd.randint(1900, 2100)}-{rnd.randint(1, 12):02}-{rnd.randint(1, 28):02}-{text}"
        if len(text) >= 12:
            plain.append(text)
    return secret, plain


def fit(strings: list[str], add: float = 0.5) -> np.ndarray:
    """Log transition probabilities between characters, from the start state."""
    counts = np.full((len(STATES), len(STATES)), add)
    for s in strings:
        c = CODE[np.frombuffer(("^" + s).encode(), np.uint8)]
        np.add.at(counts, (c[:-1], c[1:]), 1)
    return np.log(counts / counts.sum(1, keepdims=True))


@lru_cache(1)
def model() -> tuple[np.ndarray, float]:
    """(ratio table, threshold a character)."""
    secret, plain = samples(1)
    ratio = fit(secret) - fit(plain)
    _, held = samples(2, 2 * SAMPLES)
    scores = sorted(score(x, ratio) for x in held if len(x) >= SHORTEST)
    return ratio, max(0.3, scores[int(len(scores) * 0.999)])


def score(text: str, ratio: np.ndarray) -> float:
    """Log-likelihood ratio a character that the string is random rather than ordinary."""
    c = CODE[np.frombuffer(("^" + text).encode("ascii"), np.uint8)]
    return float(ratio[c[:-1], c[1:]].sum()) / len(text)


def base_spans(text: str, low: str | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the fixed patterns find."""
    out = []
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX_LONG.finditer(text)]
    if any(w in (low or text.lower()) for w in ("passw", "secret", "token", "api")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    return sorted(out)


def evidence(text: str, ratio: np.ndarray) -> float:
    """The ratio summed over distinct transitions: padding and repeated patterns say nothing new."""
    c = CODE[np.frombuffer(("^" + text).encode("ascii"), np.uint8)]
    return float(ratio.ravel()[np.unique(c[:-1] * len(STATES) + c[1:])].sum())


def is_secret(text: str, ratio: np.ndarray, least: float) -> bool:
    return score(text, ratio) > least and evidence(text, ratio) >= EVIDENCE and not UUID.fullmatch(text)


def added_spans(text: str, ratio: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the runs that the models call secret."""
    return [(m.start(), 3, m.end()) for m in CANDIDATE.finditer(text) if is_secret(m[0], ratio, least)]


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, n_random long, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ratio, least = model()
    say = lambda x: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in x)
    empty = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        rows = []
        for text in batch.column(1):
            text = text.as_py() or ""
            base = base_spans(text)
            more = [x for x in added_spans(text, ratio, least) if not any(a < x[2] and x[0] < b for a, _, b in base)]
            n = [sum(k == i for _, k, _ in base) for i in range(3)]
            rows.append((*n, hashlib.sha256(say(base).encode()).hexdigest() if base else empty, len(more), say(sorted(base + more))))
        cols = list(zip(*rows)) if rows else [[]] * 6
        kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "n_random", "spans"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, n_random, spans.

    Spans are kind:start:end in code points, by start, then kind. Null text counts as empty; null and repeated doc_ids
    pass through; other columns are not read. Overlapping spans of different base kinds all stay; an added span
    (kind random) overlaps none of the base ones. Texts are read whole, however long; an empty table gives no rows.
    """
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), _scan, SCHEMA)
