"""TXT-11: Romanian stemming (the published Snowball algorithm, cedilla
spelling ş/ţ).

``stem_word`` is a small per-word helper.  Spark work stays columnar: the
Arrow UDF receives a whole batch of token lists, stems each *distinct* term
of the batch once (with a per-worker cache across batches — term frequency
is Zipfian, so the cache absorbs almost all calls) and maps the results back
by index, so the per-token cost is a vectorised take.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

VOWELS = set("aeiouăâî")

# Suffix tables of the algorithm (cedilla ş/ţ spelling).
STEP0 = {
    "ul": "", "ului": "",
    "aua": "a",
    "ea": "e", "ele": "e", "elor": "e",
    "ii": "i", "iua": "i", "iei": "i", "iile": "i", "iilor": "i", "ilor": "i",
    "ile": "i",  # not after "ab"
    "atei": "at",
    "aţie": "aţi", "aţia": "aţi",
}
COMBO = {
    **dict.fromkeys(["abilitate", "abilitati", "abilităi", "abilităţi"], "abil"),
    "ibilitate": "ibil",
    **dict.fromkeys(["ivitate", "ivitati", "ivităi", "ivităţi"], "iv"),
    **dict.fromkeys(
        ["icitate", "icitati", "icităi", "icităţi", "icator", "icatori", "iciv", "iciva",
         "icive", "icivi", "icivă", "ical", "icala", "icale", "icali", "icală"], "ic"),
    **dict.fromkeys(
        ["ativ", "ativa", "ative", "ativi", "ativă", "aţiune", "atoare", "ator", "atori",
         "ătoare", "ător", "ători"], "at"),
    **dict.fromkeys(
        ["itiv", "itiva", "itive", "itivi", "itivă", "iţiune", "itoare", "itor", "itori"], "it"),
}
STANDARD_DELETE = [
    "at", "ata", "ată", "ati", "ate", "ut", "uta", "ută", "uti", "ute", "it", "ita", "ită",
    "iti", "ite", "ic", "ica", "ice", "ici", "ică", "abil", "abila", "abile", "abili", "abilă",
    "ibil", "ibila", "ibile", "ibili", "ibilă", "oasa", "oasă", "oase", "os", "osi", "oşi",
    "ant", "anta", "ante", "anti", "antă", "ator", "atori", "itate", "itati", "ităi", "ităţi",
    "iv", "iva", "ive", "ivi", "ivă",
]
STANDARD_IUNE = ["iune", "iuni"]
STANDARD_IST = ["ism", "isme", "ist", "ista", "iste", "isti", "istă", "işti"]
VERB_AFTER_CONSONANT = [
    "are", "ere", "ire", "âre", "ind", "ând", "indu", "ându", "eze", "ească", "ez", "ezi",
    "ează", "esc", "eşti", "eşte", "ăsc", "ăşti", "ăşte", "am", "ai", "au", "eam", "eai",
    "ea", "eaţi", "eau", "iam", "iai", "ia", "iaţi", "iau", "ui", "aşi", "arăm", "arăţi",
    "ară", "uşi", "urăm", "urăţi", "ură", "işi", "irăm", "irăţi", "iră", "âi", "âşi", "ârăm",
    "ârăţi", "âră", "asem", "aseşi", "ase", "aserăm", "aserăţi", "aseră", "isem", "iseşi",
    "ise", "iserăm", "iserăţi", "iseră", "âsem", "âseşi", "âse", "âserăm", "âserăţi",
    "âseră", "usem", "useşi", "use", "userăm", "userăţi", "useră",
]
VERB_DELETE = [
    "ăm", "aţi", "em", "eţi", "im", "iţi", "âm", "âţi", "seşi", "serăm", "serăţi", "seră",
    "sei", "se", "sesem", "seseşi", "sese", "seserăm", "seserăţi", "seseră",
]
VOWEL_SUFFIXES = ["a", "e", "i", "ie", "ă"]

_STANDARD = {s: "del" for s in STANDARD_DELETE}
_STANDARD.update({s: "iune" for s in STANDARD_IUNE})
_STANDARD.update({s: "ist" for s in STANDARD_IST})
_VERB = {s: "cons" for s in VERB_AFTER_CONSONANT}
_VERB.update({s: "del" for s in VERB_DELETE})


def _longest(word: str, table, lo: int = 0) -> str | None:
    """Longest suffix of ``word`` in ``table`` that starts at or after ``lo``.
    The verb step searches inside RV only; the other steps take the longest
    suffix of the whole word and then test its region themselves."""
    best = None
    for s in table:
        if len(word) - len(s) >= lo and word.endswith(s) and (best is None or len(s) > len(best)):
            best = s
    return best


def _prelude(w: str) -> str:
    chars = list(w)
    for i in range(1, len(chars) - 1):
        if chars[i] in "ui" and chars[i - 1] in VOWELS and chars[i + 1] in VOWELS:
            chars[i] = chars[i].upper()
    return "".join(chars)


def _regions(w: str) -> tuple[int, int, int]:
    n = len(w)
    isv = [c in VOWELS for c in w]

    def after_next(start: int, want_vowel: bool) -> int:
        for j in range(start, n):
            if isv[j] == want_vowel:
                return j + 1
        return n

    rv = n
    if n >= 2:
        if isv[0]:
            rv = after_next(2, True) if not isv[1] else after_next(2, False)
        else:
            rv = after_next(2, True) if not isv[1] else min(3, n)
    # R1 / R2: after the first non-vowel following a vowel
    def region(start: int) -> int:
        j = start
        while j < n and not isv[j]:
            j += 1
        while j < n and isv[j]:
            j += 1
        return min(j + 1, n) if j < n else n

    p1 = region(0)
    p2 = region(p1)
    return rv, p1, p2


@lru_cache(maxsize=1_000_000)
def stem_word(word: str) -> str:
    if len(word) < 2:
        return word
    w = _prelude(word)
    rv, p1, p2 = _regions(w)

    # step 0
    s = _longest(w, STEP0)
    if s is not None and len(w) - len(s) >= p1:
        if s == "ile" and w[: -len(s)].endswith("ab"):
            pass
        else:
            w = w[: -len(s)] + STEP0[s]

    # step 1 (repeat) + step 2
    removed = False
    while True:
        s = _longest(w, COMBO)
        if s is None or len(w) - len(s) < p1:
            break
        w = w[: -len(s)] + COMBO[s]
        removed = True
    s = _longest(w, _STANDARD)
    if s is not None and len(w) - len(s) >= p2:
        kind = _STANDARD[s]
        stem = w[: -len(s)]
        if kind == "del":
            w = stem
            removed = True
        elif kind == "ist":
            w = stem + "ist"
            removed = True
        elif stem.endswith("ţ"):
            w = stem[:-1] + "t"
            removed = True

    # step 3: verb suffixes, inside RV
    if not removed:
        s = _longest(w, _VERB, rv)
        if s is not None:
            stem = w[: -len(s)]
            if _VERB[s] == "del":
                w = stem
            elif len(stem) - 1 >= rv and (stem[-1] == "u" or stem[-1] not in VOWELS):
                w = stem

    # step 4: final vowel inside RV
    s = _longest(w, VOWEL_SUFFIXES)
    if s is not None and len(w) - len(s) >= rv:
        w = w[: -len(s)]

    return w.replace("I", "i").replace("U", "u")


def _stem_list_array(arr: pa.Array) -> pa.Array:
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    flat = pc.list_flatten(arr)
    if len(flat) == 0:
        return arr
    enc = pc.dictionary_encode(flat)
    uniq = enc.dictionary.to_pylist()
    stems = pa.array([None if u is None else stem_word(u) for u in uniq], pa.string())
    mapped = stems.take(enc.indices)
    offsets = arr.offsets
    if arr.offset or offsets[0].as_py() != 0:
        start = offsets[0].as_py()
        offsets = pc.subtract(offsets, start)
    return pa.ListArray.from_arrays(offsets, mapped, mask=arr.is_null())


@F.arrow_udf(ArrayType(StringType()))
def stem_terms(terms: pa.Array) -> pa.Array:
    """Arrow UDF: array<string> → array<string>, each term stemmed."""
    return _stem_list_array(terms)


@F.arrow_udf(StringType())
def stem_term(term: pa.Array) -> pa.Array:
    """Arrow UDF: string → string (distinct terms of the batch stemmed once)."""
    if isinstance(term, pa.ChunkedArray):
        term = term.combine_chunks()
    enc = pc.dictionary_encode(term)
    uniq = enc.dictionary.to_pylist()
    stems = pa.array([None if u is None else stem_word(u) for u in uniq], pa.string())
    return stems.take(enc.indices)


def stem_array(arr: Column) -> Column:
    """Replace the term of every token of an analysed array by its stem."""
    stemmed = stem_terms(F.transform(arr, lambda x: x["term"]))
    return F.zip_with(
        arr,
        stemmed,
        lambda x, s: F.struct(x["pos"].alias("pos"), x["ord"].alias("ord"), s.alias("term"), x["flags"].alias("flags")),
    )
