"""Column functions of the corpus rules; everything stays inside the JVM."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab

#: The code points that Python's str.strip removes; with U+200B for normalisation.
_SPACES = r"\x{0009}-\x{000d}\x{001c}-\x{0020}\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
EDGES = f"^[{_SPACES}]+|[{_SPACES}]+$"
BLANKS = rf"[{_SPACES}\x{{200b}}]+"
CJK = r"[\x{4e00}-\x{9fff}]"


def _digit_class() -> str:
    """Regex class of what str.isdigit accepts: decimal digits and the other code points with a digit value."""
    other = [c for c in range(0x110000) if chr(c).isdigit() and unicodedata.category(chr(c)) != "Nd"]
    spans: list[list[int]] = []
    for c in other:
        if spans and spans[-1][1] == c - 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return r"[\p{Nd}" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans) + "]"


DIGIT = _digit_class()


def strip(t: Column) -> Column:
    return F.regexp_replace(t, EDGES, "")


def normalise(t: Column) -> Column:
    """Every run of white space (U+200B included) is one space; none at the edges."""
    return F.regexp_replace(F.regexp_replace(t, BLANKS, " "), "^ +| +$", "")


def has_cjk(word: str) -> bool:
    return any("一" <= c <= "鿿" for c in word)


def any_of(t: Column, words) -> Column:
    """Whether any word occurs. Words with ideographs are only looked for in texts that have one."""
    words = list(dict.fromkeys(words))
    # a literal array keeps the generated code small however long the list is
    some = lambda ws: F.exists(F.array(*[F.lit(w) for w in ws]), lambda w: F.contains(t, w))
    plain, cjk = [w for w in words if not has_cjk(w)], [w for w in words if has_cjk(w)]
    parts = ([some(plain)] if plain else []) + ([t.rlike(CJK) & some(cjk)] if cjk else [])
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)


def count_of(t: Column, word: str) -> Column:
    """Non-overlapping occurrences of a word."""
    return ((F.length(t) - F.length(F.replace(t, F.lit(word), F.lit("")))) / F.lit(len(word))).cast("int")


def is_sensitive(t: Column) -> Column:
    words = [w for group in vocab.SENSITIVE.values() for w in group]
    return any_of(t, words) | (t.rlike(CJK) & reduce(lambda a, b: a | b, [t.rlike("(?i)" + p) for p in vocab.SENSITIVE_PATTERNS]))


def is_colloquial(t: Column) -> Column:
    return any_of(t, vocab.COLLOQUIAL) | t.rlike(vocab.PUNCTUATION_RUN) | reduce(lambda a, b: a | b, [t.rlike(p) for p in vocab.COLLOQUIAL_PATTERNS])


def has_academic_features(t: Column) -> Column:
    return t.rlike("|".join(vocab.ACADEMIC_PATTERNS))


def classic_count(t: Column) -> Column:
    """Occurrences of all entries of the classical list, an entry listed twice counted twice."""
    singles = [w for w in vocab.CLASSIC if len(w) == 1]
    once, twice = "".join(dict.fromkeys(singles)), "".join(w for w in dict.fromkeys(singles) if singles.count(w) > 1)
    chars = F.length(t) - F.length(F.translate(t, once, ""))
    for w in twice:
        chars = chars + (singles.count(w) - 1) * count_of(t, w)
    many = F.array(*[F.lit(w) for w in vocab.CLASSIC if len(w) > 1])
    words = F.aggregate(many, F.lit(0), lambda n, w: n + ((F.length(t) - F.length(F.replace(t, w, F.lit("")))) / F.length(w)).cast("int"))
    return F.when(t.rlike(CJK), chars + words).otherwise(F.lit(0))


def is_classic(t: Column) -> Column:
    dense = F.length(t) > 0
    share = classic_count(t) / F.length(t)
    return F.when(any_of(t, vocab.MODERN) | ~dense, False).otherwise((share > 0.02) | t.rlike(vocab.CLASSIC_PATTERN))


def text_type(t: Column) -> Column:
    return F.when(is_classic(t), "classic_chinese").otherwise("modern_chinese")


def redundancy(t: Column) -> Column:
    n = F.length(t)
    return F.when(n > 0, (n - F.length(F.translate(t, vocab.REDUNDANT_CHARS, ""))) / n).otherwise(0.0)


def rounded(x: Column, digits: int) -> Column:
    """x to so many decimals as Python's round and C's printf have it: the double's exact value counts, and only a true
    tie goes to the even digit. bround takes the shortest decimal for the value: 0.085, a little above the tie, gives 0.08.

    The product with the power of ten is taken with its rounding error (Dekker's split), which says on which side of a
    seeming tie x lies. Values of 2^40 and more, infinities and NaN are left to bround."""
    scale = float(10**digits)

    def near(v: Column) -> Column:
        p, far = v * scale, v * 134217729.0
        high = far - (far - v)
        error = (high * scale - p) + (v - high) * scale
        n = F.when((p - F.floor(p) == 0.5) & (error != 0.0), F.floor(p) + (error > 0.0).cast("int")).otherwise(F.rint(p))
        return F.when(F.abs(v) < float(2**40), n / scale).otherwise(F.bround(v, digits))

    return F.get(F.transform(F.array(x.cast("double")), near), F.lit(0))  # x is worked out once


def question_type(t: Column) -> Column:
    """First type one of whose words occurs; else calculate for a digit with a sign of arithmetic; else fallback."""
    out = F
    for kind, words in vocab.QUESTION_TYPES.items():
        out = out.when(any_of(t, words), kind)
    return out.when(any_of(t, vocab.CALCULATE_SIGNS) & t.rlike(DIGIT), "calculate").otherwise("fallback")


def hash_unit(key: Column, seed: int | str, salt: str = "") -> Column:
    """A number in [0, 1) that depends on the key, the seed and the salt alone."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), F.lit(salt)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers; 0.0 where it is not defined."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def hashed_bigrams(t: Column, size: int = 64) -> Column:
    """The built-in embedder: counts of character bigrams by CRC bucket."""
    n = F.length(t)
    grams = F.when(n >= 2, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.crc32(F.substring(t, i, F.lit(2))) % size)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.size(F.filter(grams, lambda g: g == k)).cast("double"))
