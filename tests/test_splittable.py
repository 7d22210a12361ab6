"""One large file read by several tasks gives what a whole read gives."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from quarry.sources import splittable as SP
from quarry.sources.resources import read_queries


@pytest.fixture()
def small_blocks(spark):
    """Byte ranges of a few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "64"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lines_of_a_large_file(spark, small_blocks, tmpdir_fresh):
    rnd = random.Random(1)
    lines = ["".join(rnd.choice("abcé ") for _ in range(rnd.choice([0, 0, 3, 40, 90]))) for _ in range(400)]
    path = os.path.join(tmpdir_fresh, "q.txt")
    with open(path, "w", newline="") as f:
        f.write("".join(x + rnd.choice(["\n", "\r\n"]) for x in lines))
    with open(os.path.join(tmpdir_fresh, "r.txt"), "w") as f:
        f.write("one\n\ntwo")
    read = SP.text_blocks(spark.read.text(path))
    assert read.select("block").distinct().count() > 10 and read.rdd.getNumPartitions() > 10
    got = {(r.source.split("/")[-1], r.line_no): r.value for r in SP.read_lines(spark, tmpdir_fresh).collect()}
    assert got == {**{("q.txt", i): x for i, x in enumerate(lines)}, ("r.txt", 0): "one", ("r.txt", 1): "", ("r.txt", 2): "two"}
    queries = read_queries(spark, tmpdir_fresh).collect()
    assert sorted(r.query for r in queries) == sorted([x for x in lines if x] + ["one", "two"])
    assert len({r.query_id for r in queries}) == len(queries)


def _objects(n):
    rnd = random.Random(3)
    words = ['a "quoted" } word', "back\\slash", "}{][", "tail\\", "é漢\n\t", "", '\\"}', "x" * 700]
    return [{"id": i, "list": [{"t": rnd.choice(words), "in": {"d": [1, {"e": rnd.choice(words)}]}} for _ in range(rnd.randint(0, 4))], "k}[": rnd.choice(words)} for i in range(n)]


@pytest.mark.parametrize("form", ["compact", "indented", "lines", "empty"])
def test_objects_of_a_large_array(spark, small_blocks, tmpdir_fresh, form):
    objects = [] if form == "empty" else _objects(120)
    text = {"compact": json.dumps(objects), "indented": " \n" + json.dumps(objects, indent=3, ensure_ascii=False) + "\n", "empty": "[ ]\n",
            "lines": "\n".join(map(json.dumps, objects)) + "\n"}[form]
    path = os.path.join(tmpdir_fresh, "a.json")
    with open(path, "w") as f:
        f.write(text)
    rows = SP.json_objects(spark, path).collect()
    assert sorted(r.object_no for r in rows) == list(range(len(objects)))
    assert [json.loads(r.json) for r in sorted(rows, key=lambda r: r.object_no)] == objects
    if objects:
        assert spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_block_start")).distinct().count() > 10
