"""Large files read by many tasks: numbered lines, and the objects of JSON
arrays.

Spark's text source cuts a file into byte ranges ("blocks") at a separator of
one character, which works for every file system that Spark reads.  What is
numbered in a file is numbered within each block first; one small row a block
then gives the sums over the blocks before it.

* **Lines**: line number = lines in earlier blocks + place within the block.
* **JSON**: the separator is ``}``, so a record is a piece that ends with a
  closing brace.  Quotes before a piece (escaped ones left out) tell whether it
  begins inside a string; then braces and brackets outside of strings give the
  depth; an object of the outer array ends where the depth is back at the
  array's.  Pieces of one object, a few a piece of nesting, are put together
  again.  Files may hold an array of objects, objects one after the other, or
  JSON lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, stage_table

BLOCK = ["source", "block"]


def text_blocks(df: DataFrame) -> DataFrame:
    """(source, block, value) of a text read or of a micro-batch of one."""
    return df.select(F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"), "value")


def _before(blocks: DataFrame, total: str, name: str) -> DataFrame:
    """Sums of ``total`` over the earlier blocks of a file."""
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn(name, F.coalesce(F.sum(total).over(earlier), F.lit(0)))


def number_lines(blocks: DataFrame) -> DataFrame:
    """(source, line_no, value): lines numbered from 0 in each file.  Rows of a
    block stand together in its partition, in file order."""
    rows = blocks.withColumn("_m", F.monotonically_increasing_id())
    counts = stage_table(rows.groupBy(*BLOCK).agg(F.min("_m").alias("_first"), F.count(F.lit(1)).alias("_n")), "blocks")
    starts = broadcast_if_small(_before(counts, "_n", "_lines").drop("_n"), known_rows=counts.count())
    return rows.join(starts, BLOCK).select("source", (F.col("_lines") + F.col("_m") - F.col("_first")).cast("int").alias("line_no"), "value")


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """Lines of every file under ``paths`` with their numbers."""
    return number_lines(text_blocks(spark.read.option("recursiveFileLookup", "true").text(paths)))


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def json_objects(spark: SparkSession, path: str) -> DataFrame:
    """(source, object_no, json): the objects of the JSON files at ``path``."""
    read = spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(path)
    bare = F.regexp_replace("value", r"(?s)\\.", "")  # escapes only stand in strings
    pieces = text_blocks(read).withColumns({"_m": F.monotonically_increasing_id(), "_quotes": _count(bare, '"')})
    pieces = stage_table(pieces, "json-pieces")

    def with_before(df: DataFrame, value: str, name: str) -> DataFrame:
        sums = stage_table(df.groupBy(*BLOCK).agg(F.sum(value).alias("_total")), "blocks")
        return df.join(broadcast_if_small(_before(sums, "_total", name).drop("_total"), known_rows=sums.count()), BLOCK)

    line = Window.partitionBy(*BLOCK).orderBy("_m")
    until, here = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(Window.unboundedPreceding, 0)
    opening = F.regexp_extract(F.min_by("value", "_m"), r"^[\s\x{FEFF}]*(\[?)", 1)
    outer = pieces.where("block = 0").groupBy("source").agg(F.length(opening).alias("_outer"))  # 1 within an array
    rows = with_before(pieces, "_quotes", "_quoted")
    inside = (F.col("_quoted") + F.coalesce(F.sum("_quotes").over(until), F.lit(0))) % 2
    rows = rows.withColumn("_inside", inside)
    # parts between quotes are outside and inside of strings by turns
    parts = F.filter(F.split(bare, '"', -1), lambda _, i: (i + F.col("_inside")) % 2 == 0)
    plain = F.array_join(parts, "")
    closes = ((F.col("_inside") + F.col("_quotes")) % 2 == 0).cast("int")
    rows = rows.select(*BLOCK, "_m", closes.alias("_closes"), (_count(plain, "{[") - _count(plain, "}]") - closes).alias("_step"))
    rows = with_before(stage_table(rows, "json-steps"), "_step", "_above")
    depth = F.col("_above") + F.sum("_step").over(here)
    rows = rows.withColumn("_depth", depth).join(F.broadcast(outer) if outer.count() <= 100_000 else outer, "source")
    ends = stage_table(rows.select(*BLOCK, "_m", ((F.col("_closes") == 1) & (F.col("_depth") == F.col("_outer"))).cast("long").alias("_end")), "json-ends")
    ends = with_before(ends, "_end", "_ended")
    number = F.col("_ended") + F.coalesce(F.sum("_end").over(until), F.lit(0))
    numbered = ends.withColumn("object_no", number).select(*BLOCK, "_m", "object_no", "_end")
    whole = pieces.select(*BLOCK, "_m", "value").join(numbered, [*BLOCK, "_m"])
    found = whole.groupBy("source", "object_no").agg(F.max("_end").alias("_end"), F.array_sort(F.collect_list(F.struct("block", "_m", "value"))).alias("p"))
    text = F.concat(F.array_join(F.transform("p", lambda x: x["value"]), "}"), F.lit("}"))
    return found.where("_end = 1").select("source", "object_no", F.regexp_replace(text, r"^[\s,\x{FEFF}]*\[?[\s]*(?=\{)", "").alias("json"))
