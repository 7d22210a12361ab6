"""Fixed values that results depend on.

Everything in this module must stay exactly as written: token-type
patterns, flag names and their order, the emotion label order and the
sizes used by the conversation encoders.  The Java-flavoured patterns run
unchanged in Spark (``java.util.regex``); the ``*_RE2`` variants are the
same languages written for RE2 (DuckDB), which lacks look-around and
back-references.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Token flags, in their natural (declaration) order.
# ---------------------------------------------------------------------------
FLAG_ORDER = [
    "EmailAddress",
    "NamedEntity",
    "Punctuation",
    "PhoneNumber",
    "UrlAddress",
    "Acronym",
    "Number",
    "Roman",
    "Word",
    "Date",
]
DEFAULT_FLAG = "Word"

# ---------------------------------------------------------------------------
# Token-type rules (full match, case-sensitive), in rule order.
# ---------------------------------------------------------------------------
EMAIL_RX = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+"
DATE_RX = (
    r"(?:(?:31(\/|-|\.)(?:0?[13578]|1[02]))\1|(?:(?:29|30)(\/|-|\.)(?:0?[13-9]|1[0-2])\2))"
    r"(?:(?:1[6-9]|[2-9]\d)?\d{2})$|^(?:29(\/|-|\.)0?2\3(?:(?:(?:1[6-9]|[2-9]\d)?"
    r"(?:0[48]|[2468][048]|[13579][26])|(?:(?:16|[2468][048]|[3579][26])00))))$|"
    r"^(?:0?[1-9]|1\d|2[0-8])(\/|-|\.)(?:(?:0?[1-9])|(?:1[0-2]))\4(?:(?:1[6-9]|[2-9]\d)?\d{2})"
)
PHONE_RX = r"[\+]?[(]?[0-9]{3}[)]?[-\s\.]?[0-9]{3}[-\s\.]?[0-9]{4,6}"
NUMBER_RX = r"[0-9]{1,2}([,.][0-9]{1,2})?"
ROMAN_RX = r"(?=[MDCLXVI])M*(C[MD]|D?C{0,3})(X[CL]|L?X{0,3})(I[XV]|V?I{0,3})"
URL_RX = (
    r"(https:\/\/www\.|http:\/\/www\.|https:\/\/|http:\/\/)?[a-zA-Z]{2,}(\.[a-zA-Z]{2,})"
    r"(\.[a-zA-Z]{2,})?\/[a-zA-Z0-9]{2,}|((https:\/\/www\.|http:\/\/www\.|https:\/\/|http:\/\/)?"
    r"[a-zA-Z]{2,}(\.[a-zA-Z]{2,})(\.[a-zA-Z]{2,})?)|(https:\/\/www\.|http:\/\/www\.|https:\/\/|"
    r"http:\/\/)?[a-zA-Z0-9]{2,}\.[a-zA-Z0-9]{2,}\.[a-zA-Z0-9]{2,}(\.[a-zA-Z0-9]{2,})?"
)
ACRONYM_RX = r"(?:[a-zA-Z]\.){2,}"

# (flag, Java pattern, cheap necessary condition as a SQL LIKE/contains hint)
FLAG_RULES = [
    ("EmailAddress", EMAIL_RX),
    ("Date", DATE_RX),
    ("PhoneNumber", PHONE_RX),
    ("Number", NUMBER_RX),
    ("Roman", ROMAN_RX),
    ("UrlAddress", URL_RX),
    ("Acronym", ACRONYM_RX),
]

# Punctuation-only token (POSIX punctuation class, ASCII).
PUNCT_RX = r"^\p{Punct}+$"
PUNCT_RX_RE2 = r"^[[:punct:]]+$"

# Capture-group subtoken patterns.
URL_SUBTOKEN_RX = r"(?:https?://)?([a-zA-Z-_0-9]+)"
URL_SUBTOKEN_RX_RE2 = r"(?:https?://)?([a-zA-Z\-_0-9]+)"
EMAIL_SUBTOKEN_RXS = [r"([a-zA-Z0-9_.+-]+)@", r"([a-zA-Z-_0-9]+|[a-zA-Z-_0-9]+\.?)+"]

# ---------------------------------------------------------------------------
# Word tokeniser (approximation of Unicode word boundaries for alphabetic
# scripts).  Valid in both Java regex and RE2; keep matches that contain a
# letter or digit.  Tokens longer than MAX_TOKEN_LENGTH are cut into pieces of that length.
# ---------------------------------------------------------------------------
TOKEN_RX = r"(?:\p{L}\p{M}*(?:[.:'’·]\p{L}\p{M}*)*|\p{N}(?:[.,;'’]\p{N})*|_)+"
# The same words by runs that never give back a character (Java): which part a character
# belongs to is settled by its neighbours.
TOKEN_RUNS_RX = r"(?:\p{L}[\p{L}\p{M}]*+(?:[.:'’·]\p{L}[\p{L}\p{M}]*+)*+|\p{N}++(?:[.,;'’]\p{N}++)*+|_++)++"
ALNUM_RX = r"[\p{L}\p{N}]"
MAX_TOKEN_LENGTH = 255

# ---------------------------------------------------------------------------
# Word break classes for all scripts (Java).  A character takes
# the marks and format characters behind it along.
# ---------------------------------------------------------------------------
_EXTEND = r"[\p{M}\u00AD\u200C-\u200F\u2060-\u2064\uFEFF\uFF9E\uFF9F]*"
_KATAKANA = r"[\p{IsKatakana}\u3031-\u3035\u309B\u309C\u30A0\u30FC\uFF70&&[^\uFF9E\uFF9F]]"
_SOUTHEAST = r"\p{IsThai}\p{IsLao}\p{IsMyanmar}\p{IsKhmer}"
_SINGLE = r"\p{IsHan}\p{IsHiragana}"
_JOIN = r"[_\u203F\u2040\u2054\uFE33\uFE34\uFE4D-\uFE4F\uFF3F]"
_LETTER = rf"[\p{{L}}&&[^{_SINGLE}{_SOUTHEAST}\p{{IsKatakana}}\u3031-\u3035\u309B\u309C\u30FC\uFF70]]"
_DIGIT = rf"[\p{{N}}&&[^{_SINGLE}{_SOUTHEAST}]]"
_MID_LETTER = r"[.:'’·\u0387\u055F\u05F4\u2018\u2024\u2027\uFE13\uFE52\uFE55\uFF07\uFF0E\uFF1A]"
_MID_DIGIT = r"[.,;'’\u037E\u0589\u060C\u060D\u066C\u07F8\u2018\u2024\u2044\uFE10\uFE14\uFE50\uFE52\uFE54\uFF07\uFF0C\uFF0E\uFF1B]"
_EMOJI = r"(?:[\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F900}-\x{1FAFF}](?:[\x{1F3FB}-\x{1F3FF}]|\uFE0F)?|[\u2194-\u27BF\u2B05-\u2B55]\uFE0F)"


def _token_rx_all() -> str:
    """Tokens of any script.  Runs of letters and digits, with the signs that
    may stand between two of a kind, and runs of Katakana are words; joiners tie
    words together; an ideograph or a Hiragana letter is a word of its own; a run
    of a script without spaces (Thai, Lao, Burmese, Khmer) is one word; so is an
    emoji sequence."""
    x = _EXTEND
    hebrew = rf"(?<=\p{{IsHebrew}})\"{x}\p{{IsHebrew}}{x}"
    letters = rf"{_LETTER}{x}(?:{_MID_LETTER}{x}{_LETTER}{x}|{hebrew}|{_LETTER}{x})*+"
    digits = rf"{_DIGIT}{x}(?:{_MID_DIGIT}{x}{_DIGIT}{x}|{_DIGIT}{x})*+"
    word = rf"(?:(?:{letters}|{digits})+|(?:{_KATAKANA}{x})+)"
    joined = rf"(?:{_JOIN}{x})*+{word}(?:(?:{_JOIN}{x})++{word})*(?:{_JOIN}{x})*+"
    emoji = rf"[\x{{1F1E6}}-\x{{1F1FF}}]{{2}}|{_EMOJI}(?:\u200D{_EMOJI})*"
    return rf"{joined}|[{_SINGLE}]{x}|(?:[{_SOUTHEAST}]{x})+|{emoji}"


TOKEN_RX_ALL = _token_rx_all()
# A quick check for texts of common Latin characters and dashes, quotes and spaces.
LATIN_TEXT_RX = r"^[\x00-\u00AC\u00AE-\u02FF\u2010-\u2017\u2019-\u2023]*+\z"
# Where no other character stands, TOKEN_RX finds the same words.
OTHER_SCRIPT_RX = (
    r"[^\x00-\u00AC\u00AE-\u02FF\u0370-\u0386\u0388-\u0482\u048A-\u055E\u0560-\u0588\u1E00-\u200B"
    r"\u2010-\u2017\u2019-\u2023\u2025\u2026\u2030-\u203E\u20A0-\u20CF\u2100-\u2193]"
)
WORD_RX = rf"[\p{{L}}\p{{N}}]|{_EMOJI}|[\x{{1F1E6}}-\x{{1F1FF}}]"

# ---------------------------------------------------------------------------
# Retrieval defaults.
# ---------------------------------------------------------------------------
BM25_K1 = 1.2
BM25_B = 0.75
TOP_K = 10
HITS_THRESHOLD = 1000
# One-byte length norm: values below this are stored exactly.
NORM_FREE_VALUES = 24
FUZZY_MAX_EXPANSIONS = 50
FUZZY_MAX_EDITS = 2

# ---------------------------------------------------------------------------
# Conversations.
# ---------------------------------------------------------------------------
EMOTIONS = ["neutral", "anger", "surprise", "sadness", "joy", "disgust", "fear"]
SPLITS = ["train", "trial", "test"]
SUBTASKS = ["1", "2"]
VIDEO_NAME_RX = r"dia\d+utt\d+\.mp4"
MAX_CONV_LEN = 33
MAX_UTTR_LEN = 93
BATCH_SIZE = 32
SPAN_WEIGHT_PRESENT = 0.75
SPAN_WEIGHT_ABSENT = 0.25
SEED = 33


def _expand_backrefs_date() -> str:
    """RE2 form of DATE_RX: one alternative per separator, back-references
    replaced by the literal separator (each alternative of the rule uses a
    single separator group, so the union is the same language)."""
    variants = []
    for sep in ("/", "-", "."):
        esc = "\\" + sep if sep in "/." else sep
        p = DATE_RX.replace(r"(\/|-|\.)", esc)
        for k in "1234":
            p = p.replace("\\" + k, esc)
        variants.append("(?:" + p + ")")
    return "|".join(variants)


# RE2 forms, used by the DuckDB oracle (full-match semantics there).
FLAG_RULES_RE2 = [
    ("EmailAddress", r"[a-zA-Z0-9_.+\-]+@[a-zA-Z0-9\-]+\.[a-zA-Z0-9\-.]+"),
    ("Date", _expand_backrefs_date()),
    ("PhoneNumber", PHONE_RX),
    ("Number", NUMBER_RX),
    # look-ahead dropped; the caller also requires a non-empty term
    ("Roman", r"M*(C[MD]|D?C{0,3})(X[CL]|L?X{0,3})(I[XV]|V?I{0,3})"),
    ("UrlAddress", URL_RX),
    ("Acronym", ACRONYM_RX),
]
