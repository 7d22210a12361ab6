"""Column expressions for text analysis.

Every function takes and returns ``pyspark.sql.Column`` objects, so the
same builders work on a plain column (row form) and on the lambda variable
of ``F.transform``/``F.filter`` (array form).  All of them are built-in
JVM expressions: nothing here leaves the JVM.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from importlib import resources

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


# ---------------------------------------------------------------------------
# Tokenising
# ---------------------------------------------------------------------------
def tokenize(text: Column) -> Column:
    """Word tokens of ``text`` in order (array<string>): Unicode word boundaries
    for all scripts.  Matches without a letter or digit (a lone ``_``) are
    dropped, longer ones cut into pieces of ``MAX_TOKEN_LENGTH``.  A text without
    characters of further scripts is read with the short pattern, which finds the
    same words."""
    most = P.MAX_TOKEN_LENGTH
    def cut(t):
        starts = F.sequence(F.lit(0), F.floor((F.length(t) - 1) / most).cast("int"))
        return F.transform(starts, lambda i: F.substr(t, i * most + 1, F.lit(most)))

    def words(pattern, kept):
        def pieces(found):
            whole = F.when(F.exists(found, lambda t: F.length(t) > most), F.flatten(F.transform(found, cut))).otherwise(found)
            return F.filter(whole, lambda t: t.rlike(kept))

        # the matches are bound to a lambda variable, so that the pattern runs once a text
        return F.element_at(F.transform(F.array(F.regexp_extract_all(text, F.lit(pattern), 0)), pieces), 1)

    short = text.rlike(P.LATIN_TEXT_RX) | ~text.rlike(P.OTHER_SCRIPT_RX)
    return F.when(short, words(P.TOKEN_RUNS_RX, P.ALNUM_RX)).otherwise(words(P.TOKEN_RX_ALL, P.WORD_RX))


def whitespace_tokenize(text: Column) -> Column:
    """Split on runs of whitespace; empty pieces dropped."""
    return F.filter(F.split(text, r"\s+"), lambda t: F.length(t) > 0)


def unit_count(text: Column) -> Column:
    """Number of pieces when splitting on a single blank (empty pieces count)."""
    return F.size(F.split(text, " ", -1))


# ---------------------------------------------------------------------------
# Flags
# ---------------------------------------------------------------------------
def full_match(term: Column, pattern: str) -> Column:
    """Java ``Matcher.matches`` semantics on top of ``rlike`` (which finds)."""
    return term.rlike("^(?:" + pattern + r")\z")


# Cheap necessary conditions that let codegen skip most regex evaluations.
def _guard(flag: str, term: Column) -> Column | None:
    if flag == "EmailAddress":
        return term.contains("@")
    if flag in ("UrlAddress", "Acronym"):
        return term.contains(".")
    if flag in ("Date", "PhoneNumber", "Number"):
        return term.rlike("[0-9]")
    if flag == "Roman":
        return term.rlike("^[MDCLXVI]")
    return None


class TokenRule:
    """A user rule: full-match ``regex`` sets every flag in ``flags``."""

    def __init__(self, regex: str, *flags: str):
        unknown = [f for f in flags if f not in P.FLAG_ORDER]
        if unknown:
            raise ValueError(f"unknown token flags: {unknown}")
        self.regex = regex
        self.flags = list(flags)

    def matches(self, term: Column) -> Column:
        return full_match(term, self.regex)


DEFAULT_RULES = [TokenRule(rx, flag) for flag, rx in P.FLAG_RULES]


def flags(term: Column, rules: list[TokenRule] | None = None) -> Column:
    """array<string> of the flags whose rule fully matches ``term`` (in flag
    declaration order, distinct); ``[Word]`` when none matches."""
    rules = DEFAULT_RULES if rules is None else rules
    per_flag: dict[str, list[Column]] = {}
    for rule in rules:
        cond = rule.matches(term)
        if rule in DEFAULT_RULES:
            guard = _guard(rule.flags[0], term)
            if guard is not None:
                cond = guard & cond
        for flag in rule.flags:
            per_flag.setdefault(flag, []).append(cond)
    items = []
    for flag in P.FLAG_ORDER:
        if flag in per_flag:
            cond = per_flag[flag][0]
            for c in per_flag[flag][1:]:
                cond = cond | c
            items.append(F.when(cond, F.lit(flag)))
    found = F.array_compact(F.array(*items)) if items else F.array().cast("array<string>")
    flagged = F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(P.DEFAULT_FLAG)))
    if rules is DEFAULT_RULES:
        # No default rule can match without a digit, '.', '@' or a leading
        # Roman letter: one anchored check settles most words.
        plain = term.rlike(r"^[^MDCLXVI0-9.@][^0-9.@]*$")
        return F.when(plain, F.array(F.lit(P.DEFAULT_FLAG))).otherwise(flagged)
    return flagged


def is_final(flag_array: Column) -> Column:
    """Exactly one flag, and it is not the default ``Word``."""
    return (F.size(flag_array) == 1) & (F.element_at(flag_array, 1) != F.lit(P.DEFAULT_FLAG))


def has_any_flag(flag_array: Column, marked: list[str]) -> Column:
    if not marked:
        return F.lit(True)
    return F.arrays_overlap(flag_array, F.array(*[F.lit(m) for m in marked]))


def when_flagged(flag_array: Column, marked: list[str], include: bool = True) -> Column:
    """Condition under which a conditional step applies to a token: any
    overlap with ``marked`` → ``include``, otherwise ``not include``; an
    empty ``marked`` list → always ``include``."""
    if not marked:
        return F.lit(include)
    hit = has_any_flag(flag_array, marked)
    return hit if include else ~hit


def is_punctuation(term: Column) -> Column:
    return term.rlike(P.PUNCT_RX)


# ---------------------------------------------------------------------------
# Diacritic folding
# ---------------------------------------------------------------------------
# Letters without a canonical decomposition and their ASCII
# spelling.
FOLD_SPECIAL = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE",
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D",
    "ł": "l", "Ł": "L", "þ": "th", "Þ": "TH", "ħ": "h", "Ħ": "H",
    "ı": "i", "ŀ": "l", "Ŀ": "L", "ŧ": "t", "Ŧ": "T", "ŋ": "n", "Ŋ": "N",
    "ſ": "s", "ĸ": "q", "ƒ": "f",
}


@lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(from_chars, to_chars, multi_char_pairs) for ASCII folding, built by
    rule: Latin letters U+00C0..U+024F and U+1E00..U+1EFF whose canonical
    decomposition is ASCII letters plus combining marks fold to those
    letters; a small fixed table covers letters without decomposition."""
    single_from, single_to, multi = [], [], []
    ranges = list(range(0x00C0, 0x0250)) + list(range(0x1E00, 0x1F00))
    for cp in ranges:
        ch = chr(cp)
        if ch in FOLD_SPECIAL:
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if base and base != ch and base.isascii() and base.isalpha():
            if len(base) == 1:
                single_from.append(ch)
                single_to.append(base)
            else:
                multi.append((ch, base))
    for ch, rep in FOLD_SPECIAL.items():
        if len(rep) == 1:
            single_from.append(ch)
            single_to.append(rep)
        else:
            multi.append((ch, rep))
    return "".join(single_from), "".join(single_to), tuple(multi)


def fold_ascii(term: Column) -> Column:
    """Replace accented Latin letters by their ASCII base letters."""
    src, dst, multi = fold_tables()
    out = F.translate(term, src, dst)
    for ch, rep in multi:
        out = F.replace(out, F.lit(ch), F.lit(rep))
    # pure-ASCII terms (most of them) have nothing to fold
    return F.when(F.octet_length(term) == F.length(term), term).otherwise(out)


@lru_cache(maxsize=1)
def _fold_map() -> dict[int, str]:
    src, dst, multi = fold_tables()
    return str.maketrans(dict(zip(src, dst, strict=True)) | dict(multi))


def fold_ascii_py(s: str) -> str:
    return s if s.isascii() else s.translate(_fold_map())


# ---------------------------------------------------------------------------
# Stopwords (bundled list)
# ---------------------------------------------------------------------------
@lru_cache(maxsize=1)
def bundled_stopwords() -> tuple[str, ...]:
    """A short list of Romanian function words (articles, pronouns,
    prepositions, conjunctions, auxiliaries), with both spellings of s and t
    with a mark below.  A fuller list is a parameter: see ``read_stopwords``."""
    text = resources.files("quarry.resources").joinpath("function_words_ro.txt").read_text("utf-8")
    return tuple(w.strip() for w in text.split("\n") if w.strip())


@lru_cache(maxsize=1)
def bundled_stopwords_folded() -> tuple[str, ...]:
    """Second list: the first one folded line by line."""
    return tuple(fold_ascii_py(w) for w in bundled_stopwords())


# ---------------------------------------------------------------------------
# Length norm (one byte, lossy above a threshold)
# ---------------------------------------------------------------------------
def _bit_length(x: Column) -> Column:
    return F.when(x <= 0, F.lit(0)).otherwise(F.length(F.bin(x)))


def encode_length(n: Column) -> Column:
    """Byte code of a document length: exact below NORM_FREE_VALUES, then a
    4-bit float (3 mantissa bits + exponent) of ``n - NORM_FREE_VALUES``."""
    free = P.NORM_FREE_VALUES
    x = (n - F.lit(free)).cast("long")
    shift = _bit_length(x) - 4
    normal = F.call_function("shiftright", x, shift).bitwiseAND(7).bitwiseOR(
        F.call_function("shiftleft", shift + 1, F.lit(3)))
    enc = F.when(x < 8, x).otherwise(normal)
    return F.when(n < free, n.cast("long")).otherwise(F.lit(free) + enc).cast("int")


def decode_length(b: Column) -> Column:
    """Inverse of ``encode_length`` (the smallest length with that code)."""
    free = P.NORM_FREE_VALUES
    i = (b - F.lit(free)).cast("long")
    bits = i.bitwiseAND(7)
    shift = F.call_function("shiftright", i, F.lit(3)) - 1
    dec = F.when(shift == -1, bits).otherwise(
        F.call_function("shiftleft", bits.bitwiseOR(8), shift.cast("int")))
    return F.when(b < free, b.cast("long")).otherwise(F.lit(free) + dec).cast("int")


def lossy_length(n: Column) -> Column:
    return decode_length(encode_length(n))


def lossy_length_py(n: int) -> int:
    free = P.NORM_FREE_VALUES
    shift = max((n - free).bit_length() - 4, 0) if n >= free else 0
    return free + ((n - free) >> shift << shift) if shift else n
