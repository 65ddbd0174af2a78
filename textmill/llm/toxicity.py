"""Toxicity by fuzzy lexicon hits in context.

The lexicon is learned: of labelled documents, those terms and stems that stand much more often in toxic than in clean
ones, with their log-odds; a short list of stated terms is added. Each distinct word of a batch that can match becomes a
Levenshtein automaton that is intersected with a trie of the lexicon, so misspelled and disguised terms are caught at the
edit distance the term's length allows. A window of words around each hit tells quotation (quote marks around it, a verb
of reporting) from abuse (second person, exclamation). A logistic score over evidence and counts is fitted on the
labelled documents. Learning takes at most TOXIC_ROWS toxic and CLEAN_ROWS clean documents (those of the smallest hash).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import _pow, arrow_map, discard, mix64, shingle_sets, text_chunks, words, written

U64 = np.uint64
TOXIC_ROWS, CLEAN_ROWS = 4000, 8000
WINDOW = 8

# fixed values: terms of abuse
LEXICON = (
    "idiot moron loser scum trash pathetic worthless stupid disgusting clown imbecile dumbass jackass asshole bastard "
    "bitch cretin degenerate dimwit freak garbage halfwit hateful lowlife maggot parasite pervert psycho retard "
    "scumbag subhuman swine vermin wanker weirdo wretch "
    "connard salope ordure abruti crétin arschloch schlampe abschaum dummkopf trottel gilipollas imbécil cabrón estúpido basura"
).split()
REPORT = re.compile(r"\b(said|says|called|calls|word|words|term|quote|quoted|wrote|writes|insult|insulted|slur|dit|mot|terme|sagte|wort|begriff|dijo|palabra)\b", re.I)
YOU = re.compile(r"\b(you|your|you're|youre|u|ur|tu|toi|vous|du|dich|dir|ihr|eres|usted|te)\b|!", re.I)
LEET = str.maketrans("013457@$!|+", "oieastasiit")
#: Ordinary words within the allowed distance of a term.
ORDINARY = frozenset(
    "idiom idioms boron moran maron mormon baron lose loses lost closer loner loners laser lasers lover lovers lower lowers poser posers user users hoser leser löser "
    "loyer poser doser oser loger scam scams sum sums scrum scud slum swum cum scup crash brash thrash rash tras trass crown crowns blown flown lown clow clowned "
    "batch botch butch birch pitch witch ditch hitch itch fitch aitch mitch break breaks wreak creak reak frank shine spine twine wine swing sine seine saine swipe chine swain "
    "weird regard petard psych psyche cretan dastard garage fateful verein banker tanker hanker wander ranker walker anker winker wankel wrench retch slope galope escalope ordre bordure "
    "trotter trottet carbón apathetic mirthless toothless wordless workless worthiness discussing disputing digesting disrupting regenerate regenerates regenerated generate degenerative".split()
)
def allowed(term: str) -> int:
    """The edit distance at which a term is caught."""
    return 0 if len(term) <= 3 else 1 if len(term) <= 8 else 2


def trie(lexicon: Iterable[str]) -> dict:
    root: dict = {}
    for term in lexicon:
        node = root
        for c in term:
            node = node.setdefault(c, {})
        node[""] = term
    return root


class Automaton:
    """Deterministic Levenshtein automaton of a word: states are rows of distances, cut off beyond `most` edits."""

    def __init__(self, word: str, most: int):
        self.word, self.most, self.steps = word, most, {}
        self.start = tuple(min(i, most + 1) for i in range(len(word) + 1))

    def step(self, state: tuple, c: str) -> tuple:
        known = self.steps.get((state, c))
        if known is None:
            row = [min(state[0] + 1, self.most + 1)]
            for i, w in enumerate(self.word):
                row.append(min(state[i + 1] + 1, row[i] + 1, state[i] + (w != c), self.most + 1))
            known = self.steps[state, c] = tuple(row)
        return known

    def live(self, state: tuple) -> bool:
        return min(state) <= self.most


LEET_CODES = {ord(a): ord(b) for a, b in zip("013457@$!|+", "oieastasiit")}
SMALL = 0x250  # code points whose case and kind are tabled
IS_LETTER = np.array([chr(i).isalpha() for i in range(SMALL)])
AS_LETTER = np.array([LEET_CODES.get(i, i if IS_LETTER[i] else 0) for i in range(SMALL)], np.uint32)
#: Lengths of the prefixes that may be learned as stems.
STEM = range(4, 11)


class Codes:
    """Hashes of stretches of one array of code points, from prefix sums of a polynomial."""

    def __init__(self, codes: np.ndarray):
        n = len(codes) + 1
        self.total = np.concatenate([np.zeros(1, U64), np.cumsum(mix64(codes.astype(U64) + U64(1)) * _pow(BASE, n)[: n - 1], dtype=U64)])
        self.inverse = _pow(pow(BASE, -1, 1 << 64), n)

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the code points from each a up to each b."""
        return (self.total[b] - self.total[a]) * self.inverse[a]


BASE = 0x9E3779B97F4A7C15


def laid_out(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all strings, where each starts, where each ends)."""
    ends = np.cumsum(np.array([len(x) for x in strings], np.int64))
    return np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32), np.concatenate([[0], ends[:-1]]).astype(np.int64), ends


def less_one(c: Codes, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which stretch, hash) of each stretch from a to b without one of its code points."""
    n = b - a
    which = np.repeat(np.arange(len(a)), n)
    ends = np.cumsum(n)
    k = np.arange(ends[-1] if len(n) else 0) + np.repeat(a - (ends - n), n)
    return which, (c.total[k] - c.total[a[which]]) * c.inverse[a[which]] + (c.total[b[which]] - c.total[k + 1]) * c.inverse[a[which] + 1]


def less_two(c: Codes, a: np.ndarray, n: int) -> np.ndarray:
    """Hashes, a row for each stretch of n code points from a, without two of them."""
    i, j = np.triu_indices(n, 1)
    a = a[:, None]
    return (c.total[a + i] - c.total[a]) * c.inverse[a] + (c.total[a + j] - c.total[a + i + 1]) * c.inverse[a + 1] + (c.total[a + n] - c.total[a + j + 1]) * c.inverse[a + 2]


class Found:
    """Membership of 64-bit hashes in a fixed set: a table of bits first, the sorted set for what passes."""

    def __init__(self, *hashes: np.ndarray):
        self.sorted = np.unique(np.concatenate([np.zeros(0, U64), *(h.ravel() for h in hashes)]))
        self.shift = U64(64 - max(16, int(len(self.sorted) * 32).bit_length()))
        self.bits = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bits[(self.sorted >> self.shift).astype(np.int64)] = True

    def has(self, h: np.ndarray) -> np.ndarray:
        out = self.bits[(h >> self.shift).astype(np.int64)]
        if len(self.sorted) and out.any():
            place = np.minimum(np.searchsorted(self.sorted, h[out]), len(self.sorted) - 1)
            out[out] = self.sorted[place] == h[out]
        return out


class Lexicon:
    """Terms and stems with their evidence, terms that are matched exactly only, and ordinary words that stand for none.

    `near` tells in bulk which letter strings can match at all: those that equal a term, begin with a stem, or share with
    a term what is left when as many letters as it allows edits are taken out of each (terms of more than PAIRS letters:
    hold one third of it at its place). Only these are walked through the trie, one by one.
    """

    PAIRS = 16

    def __init__(self, terms: dict[str, float], stems: dict[str, float] | None = None, ordinary: Iterable[str] = (), exact_only: Iterable[str] = ()):
        self.terms, self.stems, self.ordinary, self.exact_only = dict(terms), dict(stems or {}), frozenset(ordinary) - set(terms), frozenset(exact_only)
        self._build()

    def __getstate__(self):
        return self.terms, self.stems, self.ordinary, self.exact_only

    def __setstate__(self, state):
        self.terms, self.stems, self.ordinary, self.exact_only = state
        self._build()

    def _build(self) -> None:
        def whole(strings):
            codes, a, b = laid_out(strings)
            return Codes(codes).hash(a, b)

        self.fuzzy = sorted(t for t in self.terms if allowed(t) and t not in self.exact_only)
        self.trie = trie(self.fuzzy)
        self.exact = Found(whole(list(self.terms)))
        self.by_length = {n: Found(whole([s for s in self.stems if len(s) == n])) for n in sorted({len(s) for s in self.stems}, reverse=True)}
        codes, a, b = laid_out(self.fuzzy)
        c, n = Codes(codes), b - a
        self.one = Found(c.hash(a, b), less_one(c, a, b)[1])
        self.shortest, self.longest = int(min(n, default=0)), int(max(n, default=0))
        pairs = np.flatnonzero((np.array([allowed(t) for t in self.fuzzy], np.int64) > 1) & (n <= self.PAIRS))
        self.lengths = {x for m in set(n[pairs].tolist()) for x in range(m - 2, m + 3)}
        self.two = Found(c.hash(a[pairs], b[pairs]), less_one(c, a[pairs], b[pairs])[1], *(less_two(c, a[pairs][n[pairs] == m], m) for m in set(n[pairs].tolist())))
        thirds = [(len(t) // 3, t) for t in self.fuzzy if len(t) > self.PAIRS]
        self.heads = {k: Found(whole([t[:k] for m, t in thirds if m == k])) for k in {m for m, _ in thirds}}
        self.tails = {k: Found(whole([t[-k:] for m, t in thirds if m == k])) for k in {m for m, _ in thirds}}
        spots = {(k + d, len(t) - 2 * k) for k, t in thirds for d in (-1, 0, 1)}
        self.middles = {(at, m): Found(whole([t[k:-k] for k, t in thirds if abs(k - at) <= 1 and len(t) - 2 * k == m])) for at, m in spots}

    def near(self, codes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the letters from each a up to each b can stand for a term."""
        c, n = Codes(codes), b - a
        h = c.hash(a, b)
        out = self.exact.has(h) | self.one.has(h) | self.two.has(h)
        for k, found in self.by_length.items():
            at = np.flatnonzero(n > k)
            out[at] |= found.has(c.hash(a[at], a[at] + k))
        for k in (1, 2):  # endings
            at = np.flatnonzero(n > k + 3)
            out[at] |= self.exact.has(c.hash(a[at], b[at] - k))
        at = np.flatnonzero((n >= self.shortest - 1) & (n <= self.longest + 1) & ~out)
        which, h = less_one(c, a[at], b[at])
        out[at[which[self.one.has(h) | (self.two.has(h) if self.lengths else False)]]] = True
        for m in self.lengths & set(n.tolist()):
            at = np.flatnonzero((n == m) & ~out)
            out[at] = self.two.has(less_two(c, a[at], m)).any(1)
        at = np.flatnonzero((n >= self.PAIRS - 1) & (n <= self.longest + 2) & ~out) if self.heads else n[:0]
        for k, found in self.heads.items():
            out[at] |= found.has(c.hash(a[at], a[at] + k))
        for k, found in self.tails.items():
            out[at] |= found.has(c.hash(b[at] - k, b[at]))
        for (k, m), found in self.middles.items():
            sure = at[n[at] >= k + m]
            out[sure] |= found.has(c.hash(a[sure] + k, a[sure] + k + m))
        return out

    def lookup(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest term within its allowed distance (ties: the first in code-point order), by walking
        the automaton and the trie together. Two letters exchanged and a plural ending are one edit; a word that begins
        with a stem is that stem, `stem-` with no edit; ordinary words are no term."""
        if word in self.terms:
            return word, 0
        if word in self.ordinary:
            return None
        for n in self.by_length:
            if len(word) > n and word[:n] in self.stems:
                return word[:n] + "-", 0
        best = None
        if self.shortest - 1 <= len(word) <= self.longest + 2:
            auto = Automaton(word, 2 if len(word) > 6 else 1)  # terms of two edits have 9 letters or more
            stack = [(self.trie, auto.start)]
            while stack:
                node, state = stack.pop()
                term = node.get("")
                if term and state[-1] <= allowed(term) and (best is None or (state[-1], term) < (best[1], best[0])):
                    best = (term, state[-1])
                for c, below in node.items():
                    if c:
                        nxt = auto.step(state, c)
                        if auto.live(nxt):
                            stack.append((below, nxt))
        if best is None or best[1] > 1:
            near = [word[:i] + word[i + 1] + word[i] + word[i + 2 :] for i in range(len(word) - 1)] if len(word) <= self.longest else []
            near += [word[: -len(e)] for e in ("s", "es", "en") if word.endswith(e)]
            near = [t for t in near if t in self.terms and t not in self.exact_only and allowed(t)]
            best = (min(near), 1) if near else best
        return best

    def match(self, token: str) -> tuple[str, int] | None:
        """The term a lower-case token stands for, the nearest of: its runs of letters, and all of it with digits and
        signs read as letters and the rest left out (at least one edit)."""
        parts = LETTERS.findall(token)
        found = [self.lookup(x) for x in parts]
        bare = "".join(c for c in token.translate(LEET) if c.isalpha())
        if bare and parts != [token]:
            other = self.lookup(bare)
            found.append(other and (other[0], other[1] + 1))
        return min((x for x in found if x and x[1] <= 2), key=lambda x: (x[1], x[0]), default=None)

    def weight(self, term: str) -> float:
        return self.stems[term[:-1]] if term.endswith("-") else self.terms[term]


LETTERS = re.compile(r"[^\W\d_]+")


def candidates(tokens: list[bytes], lexicon: Lexicon) -> tuple[list[str], np.ndarray]:
    """The tokens in lower case, and which of them can match."""
    low = b"\n".join(tokens).decode("utf-8", "replace").lower()
    codes = np.frombuffer(low.encode("utf-32-le"), np.uint32)
    tabled = codes < SMALL
    small = np.where(tabled, codes, 0)
    letter = IS_LETTER[small]
    for i in np.flatnonzero(~tabled).tolist():
        letter[i] = chr(codes[i]).isalpha()
    token = np.cumsum(codes == 10)
    token[codes == 10] -= 1
    edge = np.diff(np.concatenate([[0], letter.view(np.int8), [0]]))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out = np.zeros(len(tokens), bool)
    out[token[a[lexicon.near(codes, a, b)]]] = True
    mixed = np.zeros(len(tokens), bool)  # tokens with other than letters are read as letters throughout
    mixed[token[~letter & (codes != 10)]] = True
    mixed &= ~out
    keep = mixed[token] & (codes != 10)
    read = np.where(tabled, AS_LETTER[small], np.where(letter, codes, 0))
    keep &= read > 0
    if keep.any():
        of, read = token[keep], read[keep]
        a = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        b = np.append(a[1:], len(of))
        out[of[a[lexicon.near(read, a, b)]]] = True
    return low.split("\n"), out


def find_hits(raw: np.ndarray, offs: np.ndarray, lexicon: Lexicon, known: dict) -> Iterator[tuple[int, str, str, int, bool, bool]]:
    """(row, token, term, edits, quoted, direct) of each word that stands for a term."""
    row, start, end, h = words(raw, offs)
    if not len(h):
        return
    distinct, at, back = np.unique(h, return_index=True, return_inverse=True)
    keys = distinct.tolist()
    new = [i for i, k in enumerate(keys) if k not in known]
    if new:
        body = raw.tobytes()
        low, can = candidates([body[start[i] : end[i]] for i in at[new].tolist()], lexicon)
        for i, k in enumerate(new):
            got = lexicon.match(low[i]) if can[i] else None
            known[keys[k]] = got and (low[i], *got)
    hit = np.fromiter((known[k] is not None for k in keys), bool, len(keys))
    for t in np.flatnonzero(hit[back]):
        r = row[t]
        a, b = max(t - WINDOW, int(np.searchsorted(row, r))), min(t + WINDOW + 1, int(np.searchsorted(row, r, "right")))
        left = raw[start[a] : start[t]].tobytes().decode("utf-8", "replace")
        own = raw[start[t] : end[t]].tobytes().decode("utf-8", "replace")
        right = raw[end[t] : end[b - 1]].tobytes().decode("utf-8", "replace")
        opened = re.search(r"[\"“«„'‘][^\"“”«»„]*$", " " + left) or re.match(r"[\"“«„'‘]", own)
        closed = re.match(r"[^\"“”«»„]*[\"”»“'’]", right) or re.search(r"[\"”»“'’][.,;:!?]*$", own)
        quoted = bool(opened and closed) or bool(REPORT.search(left) and (opened or closed))
        token, term, edits = known[int(h[t])]
        yield int(r), token, term, edits, quoted, bool(not quoted and YOU.search(left + " " + right))


COUNTS = ("n_plain", "n_fuzzy", "n_quoted", "n_direct")


def measure(raw: np.ndarray, offs: np.ndarray, lexicon: Lexicon, known: dict) -> np.ndarray:
    """Per text: plain, misspelled, quoted hits, hits at the second person; evidence of its distinct terms: sum, largest."""
    out, seen = np.zeros((len(offs) - 1, 6)), set()
    for r, _, term, edits, quoted, direct in find_hits(raw, offs, lexicon, known):
        out[r, 2 if quoted else int(edits > 0)] += 1
        out[r, 3] += direct
        if not quoted and not edits and (r, term) not in seen:
            seen.add((r, term))
            out[r, 4] += lexicon.weight(term)
            out[r, 5] = max(out[r, 5], lexicon.weight(term))
    return out


#: Prior weights: bias, evidence (sum, largest, number of plain hits), misspelled, quoted hits, hits at the second person.
PRIOR = np.array([-4.0, 0.6, 0.8, 0.5, 3.0, -0.3, 0.4])
MOST = 12.0  # beyond this sum evidence does not add up


def design(m: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(m)), np.minimum(m[:, 4], MOST), m[:, 5], np.log1p(m[:, 0]), np.minimum(m[:, 1], 1) + np.log1p(m[:, 1]), np.log1p(m[:, 2]), np.log1p(m[:, 3])])


def fit(m: np.ndarray, y: np.ndarray, strength: float = 0.5) -> np.ndarray:
    """Logistic weights by Newton steps, halved until the penalised loss falls, drawn towards the prior."""
    x, w = design(m), PRIOR.copy()

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - y @ z + strength / 2 * ((w - PRIOR) ** 2).sum()

    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w)), x.T @ (p - y) + strength * (w - PRIOR))
        k = 1.0
        while k > 1e-6 and loss(w - k * step) > loss(w):
            k /= 2
        w = w - k * step
    return w


HITS = "doc_id long, n_plain long, n_fuzzy long, n_quoted long, n_direct long, evidence double, strongest double"


def _measured(batches: Iterator[pa.RecordBatch], lexicons: list[Lexicon], split: bool) -> Iterator[pa.RecordBatch]:
    """With split, column 2 is a text's half, and it is measured by the lexicon of the other half."""
    known: list[dict] = [{} for _ in lexicons]
    names = ["doc_id", *COUNTS, "evidence", "strongest"]
    for batch in batches:
        for half, lexicon in enumerate(lexicons):
            part = batch.filter(pc.equal(batch.column(2), 1 - half)) if split else batch
            got = [measure(raw, offs, lexicon, known[half]) for _, _, raw, offs in text_chunks(part.column(1))]
            m = np.concatenate(got) if got else np.zeros((0, 6))
            if len(known[half]) > 500_000:
                known[half].clear()
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(m[:, i].astype(np.int64)) for i in range(4)), pa.array(m[:, 4]), pa.array(m[:, 5])], names=names)


def measured(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), lambda b: _measured(b, [lexicon], False), HITS)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, toxic: int, clean: int) -> DataFrame:
    """(doc_id, text, half, y) of labelled documents that are not held out: those of the smallest hashes, at most `toxic`
    and `clean` of each label; a doc_id labelled twice counts once (the larger label), one of two texts with the first."""
    known = labels.where("toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).where(~held_out() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    most = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((1, toxic), (0, clean))]
    picked = F.broadcast(most[0].unionByName(most[1]))  # at most toxic + clean pairs of numbers
    rows = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null").join(picked, "doc_id")
    return rows.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", (F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(2))).cast("int").alias("half"), "y")


def _sketch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, raw, offs in text_chunks(batch.column(1)):
            sets = [s[:size].view(np.int64) for s in shingle_sets(raw, offs)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([s.tolist() for s in sets], pa.list_(pa.int64()))], names=["doc_id", "grams"])


def without_copies(rows: DataFrame, size: int = 8) -> DataFrame:
    """Rows whose smallest shingle hashes are in no row of a smaller doc_id: copies say nothing new about a word."""
    sk = arrow_map(rows.select("doc_id", "text"), lambda b: _sketch(b, size), "doc_id long, grams array<long>").select("doc_id", F.explode("grams").alias("gram"))
    first = sk.groupBy("gram").agg(F.min("doc_id").alias("first"))
    later = sk.join(first, "gram").where("first < doc_id").select("doc_id").distinct()
    return rows.join(later, "doc_id", "left_anti")


def _odds(halves: tuple[int, ...], n: dict) -> tuple:
    """Log-odds of a term between toxic and clean documents of the halves, and that less two standard errors."""
    a, b = (sum((F.col(f"{c}{h}") for h in halves), F.lit(0.5)) for c in "ab")
    size = [sum(n.get((y, h), 0) for h in halves) + 1.0 for y in (1, 0)]
    odds = F.log(a / size[0]) - F.log(b / size[1])
    return odds, odds - 2 * F.sqrt(1 / a + 1 / b)


MODELS = ((0,), (1,), (0, 1))
LEAST, SURE, FORMS, USUAL = 3, 1.0, 4, 5
SEED_WEIGHT = 3.5
QUOTED = r"[\"“«„][^\"“”«»„]{1,80}[\"”»“]"


def learn(rows: DataFrame) -> list[Lexicon]:
    """Lexicons from half 0, half 1 and both of labelled rows.

    Quoted stretches are left out. A term is a run of letters in at least LEAST toxic documents whose log-odds, less two standard errors, are above SURE.
    So is a stem, a prefix of FORMS words that each lean towards toxic documents. Words of USUAL documents that begin with
    a stem but do not lean towards toxic documents are ordinary. Counts are aggregated in Spark; only what passes these bounds is collected.
    The list of stated terms is added.
    """
    n = {(r.y, r.half): r["count"] for r in rows.groupBy("y", "half").count().collect()}
    sides = [F.sum(((F.col("y") == y) & (F.col("half") == h)).cast("double")).alias(f"{c}{h}") for y, c in ((1, "a"), (0, "b")) for h in (0, 1)]
    odds = [_odds(m, n) for m in MODELS]
    toxic = [sum((F.col(f"a{h}") for h in m), F.lit(0.0)) for m in MODELS]
    named = [F.when((a >= LEAST) & (sure > SURE), lean).alias(f"w{i}") for i, (a, (lean, sure)) in enumerate(zip(toxic, odds))]
    some = F.coalesce(*[F.col(f"w{i}") for i in range(3)]).isNotNull()
    runs = F.split(F.lower(F.regexp_replace("text", QUOTED, " ")), r"[^\p{L}]+")
    prefixes = lambda w: F.array(*[F.when(F.length(w) > k, F.substring(w, 1, k)) for k in STEM])
    counts = written(rows.select("y", "half", F.explode(F.array_distinct(runs)).alias("term")).where("term <> ''").groupBy("term").agg(*sides), "toxicity-words")
    found = counts.select("term", *named).where(some).collect()
    terms = [{r.term: r[f"w{i}"] for r in found if r[f"w{i}"] is not None} for i in range(3)]
    lean = counts.where((toxic[2] >= 2) & (odds[2][0] > SURE)).select(F.explode(prefixes(F.col("term"))).alias("stem")).where("stem is not null")
    lean = lean.groupBy("stem").agg(F.count(F.lit(1)).alias("forms")).where(F.col("forms") >= FORMS).select("stem")
    every = rows.select("y", "half", F.explode(F.array_distinct(F.flatten(F.transform(runs, prefixes)))).alias("stem")).where("stem is not null")
    got = every.groupBy("stem").agg(*sides).join(lean, "stem").select("stem", *named).where(some).collect()
    stems = [{r.stem: r[f"w{i}"] for r in got if r[f"w{i}"] is not None} for i in range(3)]
    begins = [F.substring("term", 1, k).isin(short) for k in STEM if (short := [s for s in set().union(*stems) if len(s) == k])]
    often = sum((F.col(c) for c in ("a0", "a1", "b0", "b1")), F.lit(0.0)) >= USUAL
    usual = counts.where(often & (odds[2][0] <= SURE)).where(reduce(or_, begins)) if begins else counts.limit(0)
    ordinary = {r.term for r in usual.select("term").collect()}
    discard(counts)
    return [Lexicon({**dict.fromkeys(LEXICON, SEED_WEIGHT), **t}, s, ORDINARY | ordinary) for t, s in zip(terms, stems)]


def _misspelled(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    """(term, half, y) of each misspelled term of each text."""
    known: dict = {}
    for batch in batches:
        half, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        for i, _, raw, offs in text_chunks(batch.column(1)):
            found = sorted({(i + r, term) for r, _, term, edits, _, _ in find_hits(raw, offs, lexicon, known) if edits})
            row = np.array([r for r, _ in found], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([t for _, t in found], pa.string()), pa.array(half[row]), pa.array(y[row])], names=["term", "half", "y"])


def train(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC_ROWS, clean: int = CLEAN_ROWS) -> tuple[Lexicon, list[float]]:
    """(lexicon, weights) from at most `toxic` and `clean` labelled documents that are not held out.

    Weights are fitted on each half of the sample as measured by the lexicon of the other half, so that a term counts as
    it does in texts it was not learned from. A term whose near misses stand in more clean than toxic documents (by two or
    more) is matched exactly only.
    """
    rows = written(sample(docs, labels, toxic, clean), "toxicity-sample")
    fresh = written(without_copies(rows), "toxicity-fresh")
    lexicons = learn(fresh)
    near = arrow_map(fresh, lambda b: _misspelled(b, lexicons[2]), "term string, half int, y int").groupBy("term", "half", "y").count().collect()
    loose = []
    for halves in MODELS:
        clean = Counter()
        for r in near:
            clean[r.term] += r["count"] * (r.half in halves) * (1 - 2 * r.y)
        loose.append({t for t, k in clean.items() if k > 1})
    lexicons = [Lexicon(x.terms, x.stems, x.ordinary, e) for x, e in zip(lexicons, loose)]
    halves = arrow_map(fresh.select("doc_id", "text", "half"), lambda b: _measured(b, lexicons[:2], True), HITS)
    got = halves.join(fresh.select("doc_id", "y"), "doc_id").collect()  # six numbers for each row of the bounded sample
    discard(rows, fresh)
    if not got:
        return lexicons[2], PRIOR.tolist()
    got.sort(key=lambda r: r.doc_id)
    m = np.array([[r.n_plain, r.n_fuzzy, r.n_quoted, r.n_direct, r.evidence, r.strongest] for r in got], float)
    return lexicons[2], fit(m, np.array([r.y for r in got], float)).tolist()


def score_toxicity(docs: DataFrame, labels: DataFrame | None = None, lexicon: Lexicon | None = None, weights: list[float] | None = None, least: float = 0.7) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, n_plain, n_fuzzy, n_quoted, n_direct, evidence, strongest.

    With labels the lexicon and the weights are learned from them; without, the stated terms and the prior stand. Null
    and empty texts have no hits and get the score of that. A null doc_id is not held out. Only doc_id and text are
    read; repeated rows are scored alike; texts are read whole, however long; an empty table gives no rows.
    """
    if weights is None and labels is not None:
        lexicon, weights = train(docs, labels)
    lexicon, weights = lexicon or Lexicon(dict.fromkeys(LEXICON, SEED_WEIGHT), ordinary=ORDINARY), weights or PRIOR.tolist()
    ln = lambda c: F.log1p(F.col(c).cast("double"))
    x = [F.lit(1.0), F.least(F.col("evidence"), F.lit(MOST)), F.col("strongest"), ln("n_plain"), F.least(F.col("n_fuzzy"), F.lit(1)) + ln("n_fuzzy"), ln("n_quoted"), ln("n_direct")]
    z = sum((c * F.lit(float(w)) for c, w in zip(x[1:], weights[1:])), F.lit(float(weights[0])))
    out = measured(docs, lexicon).withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"), *COUNTS, "evidence", "strongest")
