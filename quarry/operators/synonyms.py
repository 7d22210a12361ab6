"""Synonyms from a table (TXT-9), for lists of any size.

The pairs become a trie keyed by the first word of their left sides; a branch
holds the rest of a left side and its right sides.  Each token is joined with
the trie on its term and brings the words that follow it; a branch fits if its
rest stands at the next positions, one after the other.  A left side of several
words is matched on whole tokens, one of a single word also on the pieces of a
URL.  Nothing becomes a literal of the plan.  Where its counted rows and bytes
allow, every task holds the trie and matches a batch of documents at once
(``synonym_rows``); a larger one is joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions import patterns as P
from ..session import BROADCAST_MAX_BYTES, broadcast_if_small, stage_table
from .synonym_rows import Trie, batch_words

#: Words of a left or right side are joined by this character.
JOINER = "\0"
#: Synonyms come behind the tokens of their position.
FIRST_ORD = 1000
#: Branches and bytes of a trie that every task holds.
HELD_BRANCHES, HELD_BYTES = 100_000, BROADCAST_MAX_BYTES // 4


def synonym_trie(pairs: DataFrame) -> DataFrame:
    """``pairs(term, synonym)`` → (word, branches): for the first word of each
    left side, the rest of it and its right sides, lowercased, repeated pairs once."""
    sides = pairs.where("term is not null and synonym is not null").select(F.split(F.lower("term"), JOINER).alias("l"), F.split(F.lower("synonym"), JOINER).alias("right")).distinct()
    rest = F.expr("slice(l, 2, greatest(size(l) - 1, 0))")
    return sides.groupBy(F.get("l", F.lit(0)).alias("word")).agg(F.array_sort(F.collect_list(F.struct(rest.alias("rest"), "right"))).alias("branches"))


def synonym_words(tokens: DataFrame, pairs: DataFrame, id_col: str = "doc_id", arr: str = "tokens", counted: bool = False) -> DataFrame:
    """(id, pos, word, left) of every synonym word: the k-th word of a right side
    at the position of its left side's first word plus k.  ``counted`` gives (id,
    pos, word, n), equal ones once; the rows of one id must lie together in one
    partition."""
    trie = synonym_trie(pairs)
    trie = stage_table(trie, "synonyms")
    size = trie.agg(F.max(F.expr("array_max(transform(branches, b -> size(b.rest)))")).alias("longest"), F.sum(F.size("branches")).alias("n"),
                    F.sum(F.expr("aggregate(branches, octet_length(word), (x, b) -> x + octet_length(array_join(b.rest, ' ')) + octet_length(array_join(b.right, ' ')))")).alias("bytes")).first()
    if size.longest is None:
        none = tokens.select(id_col, F.lit(0).alias("pos"), F.lit("").alias("word"), (F.lit(0).cast("long").alias("n") if counted else F.lit("").alias("left")))
        return none.where(F.lit(False))
    if size.n <= HELD_BRANCHES and size.bytes <= HELD_BYTES:
        held = tokens.sparkSession.sparkContext.broadcast(Trie([(r.word, r.branches) for r in trie.collect()], JOINER))
        schema = StructType([tokens.schema[id_col], StructField("pos", IntegerType()), StructField("word", StringType()), StructField("n", LongType()) if counted else StructField("left", StringType())])
        columns = tokens.select(id_col, *[F.transform(arr, lambda x: x[c]).alias(f"_{c}") for c in ("pos", "ord", "term")])  # noqa: B023
        return columns.mapInArrow(batch_words(held, to_arrow_schema(schema), counted), schema)
    longest = size.longest
    whole = tokens.select(id_col, F.col(arr).alias("a"), F.filter(arr, lambda x: x["ord"] == 0).alias("h"))
    follow = lambda x, j: F.transform(  # noqa: E731  the next whole tokens, as long as positions go on
        F.filter(F.slice("h", j + 2, F.lit(longest)), lambda y, k: y["pos"] == x["pos"] + k + 1), lambda y: y["term"])
    heads = F.transform("h", lambda x, j: F.struct(x["pos"].alias("pos"), x["term"].alias("term"), follow(x, j).alias("next")))
    pieces = F.transform(F.filter("a", lambda x: x["ord"] > 0), lambda x: F.struct(x["pos"].alias("pos"), x["term"].alias("term"), F.array().cast("array<string>").alias("next")))
    each = whole.select(id_col, F.explode(F.concat(heads, pieces)).alias("x")).select(id_col, "x.pos", F.col("x.term").alias("word"), "x.next")
    found = each.join(broadcast_if_small(trie), "word").select(id_col, "pos", "word", "next", F.explode("branches").alias("b"))
    found = found.where(F.expr("slice(next, 1, size(b.rest)) = b.rest"))
    left = F.array_join(F.concat(F.array("word"), "b.rest"), JOINER)
    words = found.select(id_col, "pos", left.alias("left"), F.posexplode("b.right").alias("k", "w"))
    words = words.select(id_col, (F.col("pos") + F.col("k")).alias("pos"), F.col("w").alias("word"), "left")
    return words.groupBy(id_col, "pos", "word").agg(F.count(F.lit(1)).alias("n")) if counted else words


def inject_synonyms_table(tokens: DataFrame, pairs: DataFrame, id_col: str = "doc_id", arr: str = "tokens") -> DataFrame:
    """``tokens`` with the synonyms of a table added to each row's array, behind
    the tokens of their position, in the order of the words."""
    staged = stage_table(tokens, "tokens")
    words = synonym_words(staged, pairs, id_col, arr)
    token = F.struct(
        F.col("pos").cast("int").alias("pos"), F.lit(FIRST_ORD).alias("ord"), F.col("word").alias("term"), F.array(F.lit(P.DEFAULT_FLAG)).alias("flags"))
    added = words.groupBy(F.col(id_col).alias("_id")).agg(F.array_sort(F.collect_list(token)).alias("_s"))
    both = F.concat(arr, F.coalesce(F.transform("_s", lambda x, j: F.struct(x["pos"].alias("pos"), (x["ord"] + j).cast("int").alias("ord"), x["term"].alias("term"), x["flags"].alias("flags"))),
                                    F.expr(f"slice({arr}, 1, 0)")))
    order = lambda a, b: F.when(a["pos"] != b["pos"], a["pos"] - b["pos"]).otherwise(a["ord"] - b["ord"])
    joined = staged.join(added, F.col(id_col) == F.col("_id"), "left")
    return joined.withColumn(arr, F.array_sort(both, order)).select(*tokens.columns)
