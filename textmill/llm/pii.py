"""Personal data spans by candidate gradient boosting, in DataFrame functions only.

Generators with high recall propose spans of four kinds, overlaps included: the fixed base patterns, looser shapes of
each kind, and base shapes that fail their check (a card number off by a digit). Boosted trees score each proposal by
its format and its context; a threshold a kind, calibrated on a held-out part of the labelled sample, decides. Base
spans always stay. The trees are fitted on the driver from a labelled sample that a seeded rule writes (SAMPLES texts,
no corpus row), whose features the same column expressions compute, and become nested CASE expressions.
"""

from __future__ import annotations

import json
import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SAMPLES = 1600
GROUP, STRIP = 256, 4096  # matches, characters

# Possessive where nothing that follows could match what is given back, and anchored to the start of a run where a
# later start cannot match: the same leftmost spans, without backtracking or quadratic scans over long runs.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GATE = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"(?:[0-9][\x20-]?){12}[0-9]", "phone": r"\+[0-9]"}
LOOSE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[({]at[\])}]\x20?[A-Za-z0-9-]++(?:\x20?(?:[\[({]dot[\])}]|\.)\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9.])[0-9]{4}([._/]|\x20{2})[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9.])",
    "phone": r"(?<![0-9+.-])(?:00[1-9][0-9]{0,2}(?:[\x20.()-]{1,2}[0-9]{2,4}){2,5}|\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4})(?![0-9])",
}
LOOSE_GATE = {"email": r"(?i)[\[({]at[\])}]", "ip": r"(?i)(?:[0-9a-f]{1,4}:){7}", "card": r"[0-9]{4}(?:[._/]|\x20\x20)[0-9]{4}", "phone": r"00[1-9][0-9 .()-]|[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"}
HINTS = {
    "email": r"(?i)mail|contact|write|reach|address|@",
    "ip": r"(?i)\bip\b|host|server|addr|login|from|client",
    "card": r"(?i)card|visa|master|amex|pay|charge|account|credit",
    "phone": r"(?i)phone|tel|call|fax|mobile|cell|dial|ring|whatsapp",
}
AGAINST = r"(?i)version|order|invoice|ticket|isbn|serial|build|part|model|ref|no\.|#|\$|€|%"
FEATURES = ("n_chars", "n_digits", "n_marks", "distinct", "luhn", "hint", "against", "glued", "base_shape", "k0", "k1", "k2", "k3")
SPAN = "array<struct<kind:int,start:int,end:int,hit:string,base_shape:boolean>>"


def let(value: Column, body) -> Column:
    """body(value) with the value computed once however often body names it, in lambdas too."""
    return F.transform(F.array(value), body)[0]


def found(text: Column, pattern: str, kind: int, base: bool) -> Column:
    """Leftmost non-overlapping matches with code-point bounds, from the lengths of what lies between them.

    Lengths are summed up within GROUP matches, and over groups, so the work is linear in the matches of a text."""
    pieces = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda g, h: F.struct(F.length(g).alias("g"), F.coalesce(F.length(h), F.lit(0)).alias("n"), h.alias("h")))
    span = lambda start, end, hit: F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), hit.alias("hit"), F.lit(base).alias("base_shape"))
    none = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + x["g"]
        return F.struct((a + x["n"]).alias("at"), F.when(x["h"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span(a, a + x["n"], x["h"])))).alias("out"))

    def grouped(ps: Column) -> Column:
        groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(ps) - 1) / GROUP).cast("int")), lambda i: F.aggregate(F.slice(ps, i * GROUP + 1, F.lit(GROUP)), none, step))
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        before = lambda gs: F.aggregate(gs, begin, lambda acc, g: F.struct((acc["at"] + g["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]
        return let(groups, lambda gs: F.flatten(F.zip_with(gs, before(gs), lambda g, at: F.transform(g["out"], lambda x: span(x["start"] + at, x["end"] + at, x["hit"])))))

    return let(pieces, lambda ps: F.when(F.size(ps) <= GROUP, F.aggregate(ps, none, step)["out"]).otherwise(grouped(ps)))


def strips(spans: Column, text: Column) -> Column:
    """The spans by the strip of the text they touch; few spans are one strip."""
    at = F.sequence(F.lit(0), F.floor(F.length(text) / STRIP).cast("int"))
    return F.when(F.size(spans) <= GROUP, F.array(spans)).otherwise(F.transform(at, lambda b: F.filter(spans, lambda s: (s["start"] < (b + 1) * STRIP) & (s["end"] > b * STRIP))))


def beside(strips_: Column, x: Column) -> Column:
    """What can overlap x."""
    first = F.floor(x["start"] / STRIP).cast("int")
    return F.when(F.size(strips_) == 1, strips_[0]).otherwise(F.flatten(F.slice(strips_, first + 1, F.floor(x["end"] / STRIP).cast("int") - first + 1)))


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a short digit string passes the mod-10 check."""
    value = lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))
    return F.aggregate(F.transform(F.split(F.reverse(d), ""), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def passes(kind: str, hit: Column) -> Column:
    """The check of a base match."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    n = F.length(digits(hit))
    if kind == "card":
        return F.when(n.between(13, 19), luhn(digits(hit))).otherwise(False)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _checked(kind: str, well: bool = True):
    return lambda x: passes(kind, x["hit"]) if well else ~passes(kind, x["hit"])


def proposals(docs: DataFrame) -> DataFrame:
    """Adds _text, _shapes (base matches, checked or not) and _loose (matches of the looser shapes)."""
    text = F.col("_text")
    none = F.array().cast(SPAN)
    gated = lambda gate, pattern, k, base: F.when(F.contains(text, F.lit("@")) if gate == "@" else text.rlike(gate), found(text, pattern, k, base)).otherwise(none)
    out = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    for k, name in enumerate(KINDS):
        out = out.withColumn(f"_base{k}", gated(GATE[name], BASE[name], k, True)).withColumn(f"_loose{k}", gated(LOOSE_GATE[name], LOOSE[name], k, False))
    return out


def features(text: Column, x: Column) -> Column:
    """Format and context of one proposal as a struct of numbers."""
    near = F.substring(text, F.greatest(x["start"] - 39, F.lit(1)), F.least(x["start"], F.lit(40)))
    edge = F.concat(F.substring(text, x["start"], F.when(x["start"] > 0, 1).otherwise(0)), F.lit(" "), F.substring(text, x["end"] + 1, F.lit(1)))
    d = digits(x["hit"])
    num = lambda c: c.cast("double")
    hint = F.coalesce(*[F.when(x["kind"] == k, near.rlike(HINTS[name])) for k, name in enumerate(KINDS)])
    values = [
        num(F.length(x["hit"])), num(F.length(d)), num(F.length(F.regexp_replace(x["hit"], "[A-Za-z0-9]", ""))), num(F.size(F.array_distinct(F.split(d, "")))),
        num(F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)), num(hint), num(near.rlike(AGAINST)), num(edge.rlike("[A-Za-z0-9_#/=]")), num(x["base_shape"]), *[num(x["kind"] == k) for k in range(4)],
    ]
    return F.struct(*[v.alias(n) for v, n in zip(values, FEATURES)])


def labelled(seed: int = 7, n: int = SAMPLES) -> list[tuple[str, int]]:
    """(text with one proposal, 1 if it is personal data), written by rule."""
    r = random.Random(seed)
    num = lambda k: "".join(r.choices("0123456789", k=k))
    word = lambda: "".join(r.choices("abcdefghilmnoprstuv", k=r.randint(3, 8)))

    def checked(d: str) -> str:
        total = sum(int(c) if i % 2 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d)))
        return d + str(-total % 10)

    yes = {
        "email": lambda: f"{word()}{r.choice(['', '.' + word()])}{r.choice([' [at] ', '[at]', '(at)', ' (at) ', '{at}'])}{word()}{r.choice([' [dot] ', '[dot]', '.', '(dot)'])}{r.choice(['com', 'org', 'net', 'de'])}",
        "ip": lambda: ":".join(f"{r.randrange(65536):x}" for _ in range(8)),
        "card": lambda: r.choice([".", "/", "_", "  "]).join(checked(r.choice("3456") + num(14))[i : i + 4] for i in range(0, 16, 4)),
        "phone": lambda: r.choice([f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"{num(3)}.{num(3)}.{num(4)}", f"00{r.choice('123456789')}{num(1)} {num(3)} {num(3)} {num(3)}"]),
    }
    no = {
        "email": lambda: f"{word()} (at) {word()} {word()}" if r.random() < 0.3 else f"x(at)y.{num(2)}",
        "ip": lambda: r.choice([":".join(r.choice(["0", "1", "00", num(2)]) for _ in range(8)), ":".join(num(2) for _ in range(8))]),
        "card": lambda: r.choice([".", "/", "_", "  "]).join(num(4) for _ in range(4)) if r.random() < 0.5 else num(r.choice([13, 14, 15, 16, 17, 18])),
        "phone": lambda: r.choice([f"{num(3)} {num(3)} {num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"{num(3)}.{num(3)}.{num(4)}", f"+{num(r.randint(3, 7))}", f"00{num(2)}.{num(3)}.{num(3)}"]),
    }
    hints = {"email": ["mail me:", "contact", "write to", "address:"], "ip": ["ip", "host", "login from", "server addr"], "card": ["card", "visa", "pay with", "credit account"], "phone": ["phone", "tel.", "call", "mobile", "fax"]}
    plain, against = ["and then", "there was", "", "of the", "see"], ["order", "invoice", "version", "serial", "part", "ticket #", "ref", "model"]
    out = []
    for i in range(n):
        kind, label = KINDS[i % 4], r.random() < 0.5
        lead = r.choice(hints[kind] if r.random() < 0.6 else plain) if label else r.choice(against if r.random() < 0.5 else plain if r.random() < 0.8 else hints[kind])
        tail = r.choice([" today", ".", "", " thanks"]) if label or r.random() < 0.6 else r.choice(["/7", "_x", "=a", "#"])
        out.append((f"{word()} {lead} {(yes if label else no)[kind]()}{tail}", int(label)))
    return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, rate: float = 0.3) -> list[tuple]:
    """Trees of depth 2 by logistic boosting: (feature, cut, (feature, cut, low, high), (feature, cut, low, high))."""
    score, out = np.zeros(len(y)), []
    cuts = [np.unique(np.quantile(c, np.linspace(0.05, 0.95, 12), method="nearest")) for c in x.T]

    def split(rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple:
        best = (-1.0, 0, 0.0)
        for f in range(x.shape[1]):
            for c in cuts[f]:
                low = x[rows, f] <= c
                gl, hl, gr, hr = g[rows][low].sum(), h[rows][low].sum(), g[rows][~low].sum(), h[rows][~low].sum()
                gain = gl * gl / (hl + 1) + gr * gr / (hr + 1)
                if gain > best[0] + 1e-9:
                    best = (gain, f, float(c))
        return best[1:]

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        f, c = split(np.arange(len(y)), g, h)
        sides = []
        for rows in (np.flatnonzero(x[:, f] <= c), np.flatnonzero(x[:, f] > c)):
            f2, c2 = split(rows, g, h)
            low = x[rows, f2] <= c2
            leaf = [round(float(rate * g[r].sum() / (h[r].sum() + 1)), 6) for r in (rows[low], rows[~low])]
            score[rows[low]] += leaf[0]
            score[rows[~low]] += leaf[1]
            sides.append((f2, c2, *leaf))
        out.append((f, c, *sides))
    return out


def predict(trees: list[tuple], x: np.ndarray) -> np.ndarray:
    one = lambda t: np.where(x[:, t[0]] <= t[1], t[2], t[3])
    return sum(np.where(x[:, f] <= c, one(a), one(b)) for f, c, a, b in trees)


_fitted: list = []


def fitted(spark: SparkSession) -> tuple[list[tuple], list[float]]:
    """(trees, a threshold for each kind), once a process: fitted on three quarters of the sample, calibrated on the
    rest, where a threshold is the lowest score with precision of 0.98 or more above it."""
    if not _fitted:
        rows = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps([{"text": t, "y": y} for t, y in labelled()])), "array<struct<text:string,y:int>>")).alias("r")).select("r.*")
        rows = proposals(rows)
        spans = F.concat(*[F.col(f"_base{k}") for k in range(4)], *[F.col(f"_loose{k}") for k in range(4)])
        got = rows.select("y", "_text", F.explode(spans).alias("x")).select("y", features(F.col("_text"), F.col("x")).alias("f")).select("y", "f.*").collect()
        data = np.array([[float(v) for v in r] for r in got])
        x, y, held = data[:, 1:], data[:, 0], np.arange(len(data)) % 4 == 3
        trees = boost(x[~held], y[~held])
        least = []
        for k in range(4):
            mine = held & (x[:, FEATURES.index(f"k{k}")] == 1)
            s, t = predict(trees, x[mine]), y[mine]
            order = np.argsort(-s)
            good = np.cumsum(t[order]) / np.arange(1, len(t) + 1) >= 0.98
            least.append(float(s[order][np.flatnonzero(good)[-1]]) if good.any() else 1e9)
        _fitted.append((trees, least))
    return _fitted[0]


def score(trees: list[tuple], f: Column) -> Column:
    leaf = lambda t: F.when(f[FEATURES[t[0]]] <= t[1], F.lit(t[2])).otherwise(F.lit(t[3]))
    parts = [F.when(f[FEATURES[a]] <= c, leaf(x)).otherwise(leaf(y)) for a, c, x, y in trees]
    while len(parts) > 1:
        parts = [sum(parts[i + 1 : i + 4], parts[i]) for i in range(0, len(parts), 4)]
    return parts[0]


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added.

    Spans are kind:start:end in code points by kind, then start. An added span overlaps no base span, nor an added one
    with a higher score (an equal score: an earlier start). Null text counts as empty; null and repeated doc_ids pass
    through; texts are read whole, however long, and however many spans they hold; other columns are not read; an empty
    table gives no rows.
    """
    trees, least = fitted(docs.sparkSession)
    rows = proposals(docs.select(F.col("doc_id").cast("long"), "text"))
    for k, name in enumerate(KINDS):
        rows = rows.withColumn(f"_b{k}", F.filter(f"_base{k}", _checked(name)))
    rows = rows.withColumn("_base", F.concat(*[F.col(f"_b{k}") for k in range(4)]))
    apart = lambda a, b: (a["end"] <= b["start"]) | (b["end"] <= a["start"])
    rest = F.concat(*[F.filter(f"_base{k}", _checked(name, False)) for k, name in enumerate(KINDS)], *[F.col(f"_loose{k}") for k in range(4)])
    loose = let(strips(F.col("_base"), F.col("_text")), lambda base: F.filter(rest, lambda x: F.forall(beside(base, x), lambda b: apart(x, b))))
    rows = rows.withColumn("_rest", F.when(F.size(F.concat(*[F.col(f"_base{k}") for k in range(4)], *[F.col(f"_loose{k}") for k in range(4)])) > F.size("_base"), loose).otherwise(F.array().cast(SPAN)))
    rows = rows.withColumn("_rest", F.transform("_rest", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), features(F.col("_text"), x).alias("f"))))
    rows = rows.withColumn("_rest", F.transform("_rest", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), score(trees, x["f"]).alias("s"))))
    enough = F.filter("_rest", lambda x: x["s"] >= F.element_at(F.array(*[F.lit(v) for v in least]), x["kind"] + 1))
    rows = rows.withColumn("_rest", enough)
    better = lambda a, b: (a["s"] > b["s"]) | ((a["s"] == b["s"]) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["kind"] < b["kind"]))))
    rows = rows.withColumn("_added", let(strips(F.col("_rest"), F.col("_text")), lambda rest: F.filter("_rest", lambda x: F.forall(beside(rest, x), lambda o: apart(x, o) | ~better(o, x)))))
    plain = lambda c: F.transform(c, lambda x: F.struct(x["kind"].alias("k"), x["start"].alias("a"), x["end"].alias("b")))
    say = lambda c: F.array_join(F.transform(c, lambda x: F.concat(F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["k"] + 1), F.lit(":"), x["a"].cast("string"), F.lit(":"), x["b"].cast("string"))), ",")
    base, every = plain(F.col("_base")), F.array_sort(F.concat(plain(F.col("_base")), plain(F.col("_added"))))
    return rows.select(
        "doc_id", *[F.size(f"_b{k}").cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(say(base), 256).alias("base_sha256"), say(every).alias("spans"), F.size("_added").cast("long").alias("n_added"),
    )
