"""Secret scans: fixed patterns, and two character Markov models, one of random
strings and one of ordinary identifiers, compared by log-likelihood ratio.

Only DataFrame functions are used.  Places come from the pieces between matches,
whose lengths are summed up in a window over (document, kind).

* **Samples.** The models are first-order chains with an initial state over
  ``ALPHABET``.  Random strings are the values that the fixed patterns find (16
  characters or more, with a letter and a digit) and, for every document, the
  Base64 form of the SHA-256 of its id, so that the alphabet of keys is seen
  even where few keys are.  Ordinary identifiers are all other words of three
  characters or more.  Counts cover all documents; equal words are counted
  before their characters are looked at.
* **Model.** Additive smoothing by one half; the ratio of a step is rounded to
  thousandths of a nat, so that sums don't depend on their order.  The table has
  68 x 67 steps whatever the corpus.
* **Verdict.** A run of ``SHORTEST`` characters or more with a letter and a
  digit is a secret if its ratio is ``MARGIN`` or more.  It may lie inside a
  span of a fixed pattern; both are reported.

Null or empty text: no spans.  Repeated rows and rows without an id are judged
row by row.  Work is linear in a text's length.  Without any documents the models
are those of the smoothing alone.  Further columns are not read."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import Stages, table

#: The kinds in their order, with patterns and least lengths.  Runs of
#: one class of characters are matched from their least length on, which drops the
#: same matches as a later check does; an assigned value is checked later.
KINDS = ("assign", "access", "hex", "model")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
SHORTEST_VALUE = 6
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-"


@dataclass(frozen=True)
class Rules:
    """``shortest`` run of characters that is judged, ``margin`` in thousandths
    of a nat, ``sample``: least length of a labelled random string."""

    shortest: int = 20
    margin: int = 10_000
    sample: int = 16
    word: int = 3


def mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def matches(text: Column, kind: int, pattern: str, value: int) -> Column:
    """The matches of a pattern with the text before each, if there is one."""
    found = F.struct(
        F.lit(kind).alias("kind"),
        F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("sizes"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value)).alias("values"),
    )
    return F.when(text.rlike(pattern), found)


def scan(docs: DataFrame, rules: Rules) -> DataFrame:
    """(rid, doc_id, found): the matches of every kind in every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    runs = f"[0-9A-Za-z+/_=-]{{{rules.shortest},}}"
    kinds = [matches(text, k, p, v) for k, (p, v) in enumerate([(ASSIGN, 2), (ACCESS, 0), (HEX, 0), (runs, 0)])]
    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.array_compact(F.array(*kinds)).alias("found"))


def located(found: DataFrame) -> DataFrame:
    """(rid, kind, start, stop, value): a row for each match, with its place."""
    zipped = F.arrays_zip("f.gaps", "f.sizes", "f.values")
    each = found.select("rid", F.explode("found").alias("f")).select("rid", "f.kind", F.posexplode(zipped).alias("k", "m"))
    rows = each.select("rid", "kind", "k", "m.gaps", "m.sizes", "m.values").where("sizes is not null")
    line = Window.partitionBy("rid", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    stop = (F.sum("gaps").over(line) + F.sum("sizes").over(line)).cast("long")
    return rows.select("rid", "kind", (stop - F.col("sizes")).alias("start"), stop.alias("stop"), F.col("values").alias("value"))


def codes(word: Column) -> Column:
    """The numbers of a word's characters in the alphabet, from 1."""
    return F.transform(F.split(word, ""), lambda c: F.position(c, F.lit(ALPHABET)))


def steps(words: DataFrame) -> DataFrame:
    """Counts (random, prev, next) of the steps of counted words."""
    numbered = words.select("random", "n", codes(F.col("word")).alias("codes"))
    before = F.concat(F.array(F.lit(0)), F.slice("codes", F.lit(1), F.size("codes") - 1))
    pairs = numbered.select("random", "n", F.explode(F.arrays_zip(before.alias("prev"), F.col("codes").alias("next"))).alias("s"))
    return pairs.groupBy("random", F.col("s.prev").alias("prev"), F.col("s.next").alias("next")).agg(F.sum("n").alias("n"))


def samples(docs: DataFrame, found: DataFrame, rules: Rules) -> DataFrame:
    """Counted labelled words (random, word, n) of all documents."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rest = text
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.when(text.rlike(pattern), F.regexp_replace(rest, pattern, " ")).otherwise(rest)
    ordinary = docs.select(F.explode(F.split(rest, "[^0-9A-Za-z+/_=-]+")).alias("word")).where(F.length("word") >= rules.word)
    values = found.select(F.explode("found").alias("f")).where("f.kind < 3").select(F.explode("f.values").alias("word"))
    # A value may hold dots, which are no characters of the models.
    values = values.select(F.regexp_replace("word", "[^0-9A-Za-z+/_=-]", "").alias("word")).where((F.length("word") >= rules.sample) & mixed(F.col("word")))
    made = found.where("doc_id is not null").select(F.base64(F.unhex(F.sha2(F.col("doc_id").cast("string"), 256))).alias("word"))
    labelled = ordinary.withColumn("random", F.lit(False)).unionByName(values.unionByName(made).withColumn("random", F.lit(True)))
    return labelled.groupBy("random", "word").agg(F.count("*").alias("n"))


def ratios(counts: list) -> list[int]:
    """Log-likelihood ratios of all steps, in thousandths of a nat, at
    prev * 67 + next - 1."""
    size = len(ALPHABET)
    n = {(r.random, r.prev, r.next): r.n for r in counts}
    of = {(r, a): sum(n.get((r, a, b), 0) for b in range(1, size + 1)) for r in (True, False) for a in range(size + 1)}
    chance = lambda r, a, b: (n.get((r, a, b), 0) + 0.5) / (of[r, a] + 0.5 * size)
    return [round(1000 * math.log(chance(True, a, b) / chance(False, a, b))) for a in range(size + 1) for b in range(1, size + 1)]


def train(docs: DataFrame, found: DataFrame, rules: Rules = Rules()) -> list[int]:
    """The models' ratios; two counts for each step come to the driver."""
    return ratios(steps(samples(docs, found, rules)).collect())


def ratio(word: Column, model: list[int]) -> Column:
    """A word's log-likelihood ratio, in thousandths of a nat."""
    steps_of = F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")
    begin = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("prev"))
    step = lambda s, c: F.struct((s["sum"] + F.get(steps_of, s["prev"] * len(ALPHABET) + c - 1)).alias("sum"), c.alias("prev"))
    return F.aggregate(codes(word), begin, step, lambda s: s["sum"])


def find_secrets(docs: DataFrame, rules: Rules = Rules(), model: list[int] | None = None) -> DataFrame:
    """Per document its spans (start, kind, stop, value), by start and kind, in
    code points."""
    stages = Stages(docs.sparkSession, "secrets")
    found = stages.write(scan(docs, rules), "found")
    model = model or train(docs, found, rules)
    random = mixed(F.col("value")) & (ratio(F.col("value"), model) >= rules.margin)
    rows = located(found).where(((F.col("kind") == 0) & (F.length("value") >= SHORTEST_VALUE)) | F.col("kind").isin(1, 2) | ((F.col("kind") == 3) & random))
    spans = rows.groupBy(F.col("rid").alias("r")).agg(F.array_sort(F.collect_list(F.struct("start", "kind", "stop", "value"))).alias("spans"))
    none = F.expr("filter(array(struct(0L start, 0 kind, 0L stop, '' value)), x -> false)")
    return found.join(spans, F.col("rid") == F.col("r"), "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x.kind < 3)
    kinds = F.array(*map(F.lit, KINDS))
    line = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x.kind), x.start, x.stop)), ",")
    count = lambda k: F.size(F.filter("spans", lambda x: x.kind == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"),
    )


def oracle() -> str:
    rules, quoted = Rules(), ASSIGN.replace("'", "''")
    runs = f"[0-9A-Za-z+/_=-]{{{rules.shortest},}}"
    kinds = [(quoted, 2), (ACCESS, 0), (HEX, 0), (runs, 0)]
    each = " UNION ALL ".join(
        f"SELECT rid, {k} AS kind, unnest(range(len(v))) AS k, unnest(v) AS value, unnest(list_transform(m, lambda x: length(x))) AS size, "
        f"unnest(list_transform(list_slice(g, 1, len(v)), lambda x: length(x))) AS gap "
        f"FROM (SELECT rid, string_split_regex(text, '{p}') AS g, regexp_extract_all(text, '{p}') AS m, regexp_extract_all(text, '{p}', {v}) AS v FROM t WHERE regexp_matches(text, '{p}'))"
        for k, (p, v) in enumerate(kinds)
    )
    blank = "text"
    for p in (quoted, ACCESS, HEX):
        blank = f"regexp_replace({blank}, '{p}', ' ', 'g')"
    size = len(ALPHABET)
    mixed_ = "regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')"
    chars = "SELECT {0}, list_transform(string_split({1}, ''), lambda c: instr('" + ALPHABET + "', c)) AS c FROM {2}"
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
e AS ({each}),
w AS (SELECT rid, kind, k, value, size, sum(gap + size) OVER (PARTITION BY rid, kind ORDER BY k) AS stop FROM e),
l AS (
  SELECT false AS random, unnest(string_split_regex({blank}, '[^0-9A-Za-z+/_=-]+')) AS value FROM t
  UNION ALL SELECT true, regexp_replace(value, '[^0-9A-Za-z+/_=-]', '', 'g') FROM e WHERE kind < 3
  UNION ALL SELECT true, to_base64(unhex(sha256(CAST(doc_id AS VARCHAR)))) || '!' FROM t WHERE doc_id IS NOT NULL),
x AS (
  SELECT random, rtrim(value, '!') AS value, count(*) AS n FROM l
  WHERE CASE WHEN NOT random THEN length(value) >= {rules.word} ELSE value LIKE '%!' OR length(value) >= {rules.sample} AND {mixed_} END GROUP BY ALL),
y AS ({chars.format("random, n", "value", "x")}),
z AS (SELECT random, n, unnest(list_concat([0], list_slice(c, 1, len(c) - 1))) AS a, unnest(c) AS b FROM y),
q AS (SELECT random, a, b, sum(n) AS n FROM z GROUP BY ALL),
s AS (SELECT random, a, sum(n) AS n FROM q GROUP BY ALL),
grid AS (SELECT a, b FROM range({size + 1}) u(a), range(1, {size + 1}) v(b)),
p AS (
  SELECT grid.a, grid.b, random, ln((coalesce(q.n, 0) + 0.5) / (coalesce(s.n, 0) + 0.5 * {size})) AS lp
  FROM grid CROSS JOIN (VALUES (true), (false)) r(random) LEFT JOIN q USING (random, a, b) LEFT JOIN s USING (random, a)),
llr AS (SELECT a, b, CAST(round(1000 * (sum(lp) FILTER (random) - sum(lp) FILTER (NOT random))) AS BIGINT) AS r FROM p GROUP BY a, b),
cand AS ({chars.format("DISTINCT value", "value", f"w WHERE kind = 3 AND {mixed_}")}),
judged AS (
  SELECT value, sum(r) AS r FROM (SELECT value, unnest(list_concat([0], list_slice(c, 1, len(c) - 1))) AS a, unnest(c) AS b FROM cand) JOIN llr USING (a, b) GROUP BY value),
k AS (
  SELECT w.rid, w.kind, w.stop - w.size AS start, w.stop FROM w LEFT JOIN judged USING (value)
  WHERE kind = 0 AND length(value) >= {SHORTEST_VALUE} OR kind IN (1, 2) OR kind = 3 AND r >= {rules.margin} AND {mixed_}),
n AS (SELECT rid, start, kind, ['assign', 'access', 'hex', 'model'][kind + 1] || ':' || start || ':' || stop AS span FROM k),
f AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
         string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans FROM n GROUP BY rid)
SELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access, CAST(coalesce(n2, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN f USING (rid)"""
