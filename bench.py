"""Headline timings at one scale factor; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each timing is one Spark action (noop write or a small collect) on the
whole tables; the index is built and written once, then queried.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from quarry.operators import analyzer as A  # noqa: E402
from quarry.operators import expansion as X  # noqa: E402
from quarry.operators import index as I  # noqa: E402
from quarry.operators import search as S  # noqa: E402
from quarry.operators import sampling as SM  # noqa: E402
from quarry.operators import metrics as M  # noqa: E402
from quarry.operators import conversations as C  # noqa: E402
from quarry.operators.rowindex import with_row_index  # noqa: E402
from quarry.plans import structured as ST  # noqa: E402
from quarry.plans import dialogue as D  # noqa: E402
from quarry.plans.tables import load  # noqa: E402
from quarry.session import ensure_checkpoint_dir, get_session, spread  # noqa: E402
from quarry.streaming import streams as STR  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    times = {}

    def timed(name, fn):
        t = time.time()
        fn()
        times[name] = round(time.time() - t, 3)

    docs = load(spark, sf, "documents", spread_rows=True)
    opts = A.AnalyzerOptions(stem=True)
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/bench-index-{int(time.time() * 1000)}"

    timed("analyze_documents", lambda: run(A.analyze(docs, "doc_id", "text", opts)))
    timed("index_build", lambda: I.write_index(I.build_index(docs, opts), base))
    timed("expansions_build", lambda: X.write_expansions(spark.read.parquet(f"{base}/terms"), base))
    idx = I.read_index(spark, base)

    conv = load(spark, sf, "conversations")
    numbered = with_row_index(conv.select("conv_id", "turn", "text"), ["conv_id", "turn"], "query_id")
    numbered = numbered.select("query_id", F.col("text").alias("query")).cache()
    numbered.count()
    for n in (1, 100, 1000):
        qs = numbered.where(F.col("query_id") < n)
        timed(f"run_queries_{n}", lambda qs=qs: run(S.run_queries(idx, qs, stem=True)))
    numbered.unpersist()

    # one clause a passage, from the same word in every round
    for kind, word in (("search_phrase", 1), ("search_prefix", 1), ("search_fuzzy", 2)):
        cl = ST.CLAUSES[kind](spark, sf).where(F.col("clause_id") == word)
        timed(kind, lambda cl=cl: run(S.search(idx, cl, stem=True)))

    timed("pair_table", lambda: run(C.pair_table(
        C.explode_utterances(D.nested(spark, sf)).select("conversation_ID", "pos", F.array(F.length("text")).alias("features")))))
    emb = load(spark, sf, "embeddings", spread_rows=True)

    def weights_f1():
        w = SM.apply_weights(emb, SM.balanced_weights(emb, "label", 10), "label")
        pred = w.select(F.col("label").alias("ref"), (F.array_position(F.slice("embedding", 1, 10),
                        F.array_max(F.slice("embedding", 1, 10))) - 1).cast("int").alias("pred"), "weight")
        M.f1_score(pred, "pred", "ref", "weighted").collect()
    timed("balanced_weights_f1", weights_f1)

    def stream():
        schema = load(spark, sf, "events").schema
        ev = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
        h, _ = STR.stream_mean(ev, "value", ["event_type"])
        h.awaitTermination()
    timed("stream_mean_available_now", stream)

    n_docs = docs.count()
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_sec", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(sf.rstrip("/")), "cpus": int(cpus),
        "documents_per_sec_index": round(n_docs / times["index_build"], 1) if times["index_build"] else None,
    }))


if __name__ == "__main__":
    main()
