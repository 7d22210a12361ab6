"""Licence scans: an Aho-Corasick automaton finds notice phrases and identifier
tags; a shunting-yard parser evaluates the licence expressions after tags.

A map without shuffle over whole texts, in time linear in their length also where
a line holds many tags.  Null or empty text: no words, no labels, score 0.
Repeated rows are scanned row by row; further columns of the input are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quarry.llm.common import WORD_TABLE, map_batches, table

#: The phrases every scan counts, and their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further notices, which give labels only.
NOTICES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd 2 clause license": "bsd-2",
    "bsd 3 clause license": "bsd-3",
    "isc license": "isc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by 4 0": "cc-by",
    "cc0 1 0": "cc0",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
#: Tags before a licence expression, in lower case.
TAGS = ("spdx-license-identifier:", "license-expression:")
#: Whole identifiers after a tag, in lower case, and their labels; no other word is a licence.
_VERSION, _OR_LATER = r"(?:-\d+(?:\.\d+)*)?", r"(?:-only|-or-later|\+)?"
IDENTIFIERS = [(re.compile(pattern), label) for pattern, label in [
    (r"mit(?:-0)?", "mit"),
    (r"apache-2(?:\.0)?", "apache-2"),
    (rf"cc-by-nc(?:-sa|-nd)?{_VERSION}", "cc-by-nc"),
    (rf"cc-by-sa{_VERSION}", "cc-by-sa"),
    (rf"cc-by-nd{_VERSION}", "cc-by-nd"),
    (rf"cc-by{_VERSION}", "cc-by"),
    (rf"cc0{_VERSION}", "cc0"),
    (rf"agpl{_VERSION}{_OR_LATER}", "agpl"),
    (rf"lgpl{_VERSION}{_OR_LATER}", "lgpl"),
    (rf"gpl-2(?:\.\d+)?{_OR_LATER}", "gpl-2"),
    (rf"gpl-3(?:\.\d+)?{_OR_LATER}", "gpl-3"),
    (rf"mpl{_VERSION}", "mpl"),
    (rf"epl{_VERSION}", "epl"),
    (r"bsd-2(?:-clause)?", "bsd-2"),
    (r"bsd-3(?:-clause)?", "bsd-3"),
    (r"isc", "isc"),
    (r"unlicense", "public-domain"),
]]
FREEDOM = {"mit": 1.0, "apache-2": 1.0, "bsd-2": 1.0, "bsd-3": 1.0, "isc": 1.0, "cc0": 1.0, "public-domain": 1.0, "cc-by": 0.9, "cc-by-sa": 0.6, "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "gpl-2": 0.3, "gpl-3": 0.3, "agpl": 0.2, "cc-by-nc": 0.1, "cc-by-nd": 0.1, "all-rights-reserved": 0.0}
UNKNOWN = 0.2
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, expressions array<string>"
)


@lru_cache(maxsize=1024)
def licence_label(identifier: str) -> str | None:
    """The label of a whole licence identifier; None for any other word."""
    name = identifier.lower()
    return next((label for pattern, label in IDENTIFIERS if pattern.fullmatch(name)), None)


def longest_expression(text: str) -> tuple[list[str], int]:
    """The tokens of the longest complete licence expression that ``text`` begins
    with, and where it ends.  Reading stops at the first token that cannot go on
    with it, such as a word of the prose behind it."""
    tokens, whole, end, depth, expected = [], 0, 0, 0, "operand"
    for match in _TOKEN.finditer(text):
        token, op = match.group(), match.group().lower()
        if expected == "operand":
            if token == "(":
                depth += 1
            elif op not in _PRECEDENCE and token != ")" and licence_label(token):
                expected = "operator"
            else:
                break
        elif expected == "exception":
            if op in _PRECEDENCE or token in "()":
                break
            expected = "operator"
        elif token == ")" and depth:
            depth -= 1
        elif op in _PRECEDENCE:
            expected = "exception" if op == "with" else "operand"
        else:
            break
        tokens.append(token)
        if expected == "operator" and not depth:
            whole, end = len(tokens), match.end()
    return tokens[:whole], end


def evaluate(expression: str) -> tuple[set[str], float] | None:
    """Labels and freedom of the longest complete licence expression at the
    beginning: ``or`` takes the freer side, ``and`` the stricter, ``with`` keeps
    the licence and names an exception.  None if there is none."""
    out: list[tuple[set[str], float]] = []
    pending: list[str] = []

    def apply(op: str) -> None:
        right, left = out.pop(), out.pop()
        if op == "with":
            out.append(left)
        else:
            out.append((left[0] | right[0], (max if op == "or" else min)(left[1], right[1])))

    for token in longest_expression(expression)[0]:
        op = token.lower()
        if token == "(":
            pending.append(token)
        elif token == ")":
            while pending[-1] != "(":
                apply(pending.pop())
            pending.pop()
        elif op in _PRECEDENCE:
            while pending and pending[-1] != "(" and _PRECEDENCE[pending[-1]] >= _PRECEDENCE[op]:
                apply(pending.pop())
            pending.append(op)
        else:
            label = licence_label(token)  # an exception has none
            out.append(({label} if label else set(), FREEDOM.get(label, UNKNOWN)))
    while pending:
        apply(pending.pop())
    return out[0] if out else None


@lru_cache(maxsize=8)
def automaton(phrases: tuple[tuple[str, str, bool], ...]) -> ahocorasick.Automaton:
    """One automaton over ``" word word "`` patterns and tags, which have no
    label; bytes are read as Latin-1 so that one character is one byte."""
    out = ahocorasick.Automaton()
    for phrase, label, base in phrases:
        pattern = f" {phrase} "
        out.add_word(pattern, (len(pattern), label, base))
    for tag in TAGS:
        out.add_word(tag, (len(tag), None, False))
    out.make_automaton()
    return out


def scan(text: bytes | None, phrases: tuple[tuple[str, str, bool], ...]) -> tuple:
    words = (text or b"").translate(WORD_TABLE).split()
    padded = (b" " + b" ".join(words) + b" ").decode("latin-1")
    starts, base_labels, labels, freedom, expressions = [], set(), set(), [], []
    for end, (size, label, base) in automaton(phrases).iter(padded):
        labels.add(label)
        if base:
            base_labels.add(label)
            starts.append(end - size + 1)
    freedom += [FREEDOM.get(x, UNKNOWN) for x in labels]
    # Tags hold signs, which the words above have not; every tag holds a colon.
    lowered = text.lower().decode("latin-1") if text and b":" in text else ""
    tags = [(end + 1, end + 1 - size) for end, (size, label, _) in automaton(phrases).iter(lowered) if label is None]
    line_end = -1
    for i, (begin, _) in enumerate(tags):
        if line_end < begin:  # one search a line, however many tags it has
            line_end = text.find(b"\n", begin)
            line_end = len(text) if line_end < 0 else line_end
        # an expression ends before the next tag
        stop = min(line_end, tags[i + 1][1]) if i + 1 < len(tags) else line_end
        line = text[begin:stop].decode("utf-8", "replace").lstrip(" \t\r*/#-")
        found = evaluate(line)
        if found:
            expressions.append(line[: longest_expression(line)[1]])
            labels |= found[0]
            freedom.append(found[1])
    places = [padded.count(" ", 0, s) for s in (min(starts), max(starts))] if starts else [None, None]
    return len(words), len(starts), *places, ",".join(sorted(base_labels)), ",".join(sorted(labels)), min(freedom, default=0.0), expressions


def scan_licences(docs: DataFrame, base: dict[str, str] = BASE_PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """Counts and places of the base phrases, labels of all notices and tags,
    the evaluated expressions, and how freely the text may be used."""
    phrases = tuple((p, x, p in base) for p, x in {**notices, **base}.items())
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def of(batch: pa.RecordBatch) -> dict:
        rows = [scan(t.as_py(), phrases) for t in batch.column(1).cast(pa.binary())]
        return {"doc_id": batch.column(0), **dict(zip(names[1:], map(list, zip(*rows)), strict=True))}

    return map_batches(docs.select("doc_id", "text"), of, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))
