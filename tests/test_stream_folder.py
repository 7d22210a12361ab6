"""A table that is a folder of part files, read as a stream."""

from quarry.plans import live


def test_index_stream_of_a_folder_of_part_files(spark, tmpdir_fresh):
    docs = spark.createDataFrame([(i, f"word{i % 5} common") for i in range(40)], "doc_id long, text string")
    docs.repartition(7).write.parquet(f"{tmpdir_fresh}/documents.parquet")
    got = {r.term: (r.df, r.ttf) for r in live.stream_index_terms(spark, tmpdir_fresh).collect()}
    assert got == {"common": (40, 40), **{f"word{i}": (8, 8) for i in range(5)}}
