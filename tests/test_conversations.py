import json
import os

import pytest
from pyspark.sql import functions as F

from quarry.functions import vectors as V
from quarry.operators import conversations as C
from quarry.operators import explore as X
from quarry.operators import metrics as M
from quarry.operators import sampling as S
from quarry.sources.conversations import read_all_splits, read_conversations

SAMPLE = [{
    "conversation_ID": 1,
    "conversation": [
        {"utterance_ID": 1, "text": "We won the cup today !", "speaker": "Ana", "emotion": "joy"},
        {"utterance_ID": 2, "text": "Oh my , really ?", "speaker": "Dan", "emotion": "surprise"},
        {"utterance_ID": 3, "text": "Fine .", "speaker": "Ana"}],
    "emotion-cause_pairs": [["1_joy", "1_won the cup"], ["2_surprise", "1_won the cup"]],
}]


@pytest.fixture(scope="module")
def data_dir(tmp_path_factory):
    root = tmp_path_factory.mktemp("ecac")
    for split in ("train", "trial", "test"):
        d = root / split / "subtask_1"
        d.mkdir(parents=True)
        (d / f"{split}.json").write_text(json.dumps(SAMPLE))
    d2 = root / "train" / "subtask_2"
    d2.mkdir(parents=True)
    (d2 / "train.json").write_text(json.dumps(SAMPLE))
    return str(root)


def test_read_and_labels(spark, data_dir):
    df = read_conversations(spark, data_dir, "train", "1")
    r = df.first()
    assert (r.has_spans, r.has_emotions, r.has_causes, r.has_video) == (True, True, True, False)
    u = C.explode_utterances(df)
    labels = [x.l for x in u.select(C.encode_emotion(F.col("emotion")).alias("l")).orderBy(F.col("pos")).collect()]
    assert labels == [4, 2, None]
    padded = C.emotion_labels(df).first().emotion_labels
    assert padded[:3] == [4, 2, 0] and len(padded) == 33 and set(padded[3:]) == {0}
    pairs = C.parse_pairs(df)
    assert [(p.utterance, p.cause) for p in pairs.orderBy("pair_idx").collect()] == [(0, 0), (1, 0)]
    spans = C.locate_spans(pairs, u).orderBy("pair_idx").collect()
    assert (spans[0].boc, spans[0].eoc, spans[0].found) == (3, 13, True)
    cl = C.cause_labels(pairs, u).orderBy("pos").collect()
    assert [c.cause_label for c in cl] == [1, 0, 0]


def test_video_and_errors(spark, data_dir):
    df = read_conversations(spark, data_dir, "train", "2")
    names = [r.video_name for r in C.explode_utterances(df).orderBy("pos").collect()]
    assert names == ["dia1utt1.mp4", "dia1utt2.mp4", "dia1utt3.mp4"]
    with pytest.raises(ValueError):
        read_conversations(spark, data_dir, "dev", "1")
    with pytest.raises(FileNotFoundError):
        read_conversations(spark, data_dir, "trial", "2")
    assert read_all_splits(spark, data_dir, "1").select("split").distinct().count() == 3


def test_unknown_emotion_fails(spark):
    df = spark.createDataFrame([("rage",)], "e string")
    with pytest.raises(Exception):
        df.select(C.encode_emotion(F.col("e"))).collect()


def test_nest_round_trip_and_spans(spark, data_dir):
    df = read_conversations(spark, data_dir, "train", "1")
    u = C.explode_utterances(df).select("conversation_ID", "pos", "utterance_ID", "text")
    back = C.explode_utterances(C.nest_utterances(u))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, u.collect()))
    tok = C.utterance_tokens(C.explode_utterances(df))
    m = C.span_matrix(C.locate_spans(C.parse_pairs(df), C.explode_utterances(df)), tok).orderBy("utterance").collect()
    assert [(r.utterance, r.cause, r.start, r.stop, r.span_mask) for r in m] == [(0, 0, 2, 4, 1), (1, 0, 2, 4, 1)]


def test_split_batches_weights(spark):
    ids = spark.range(0, 103).select(F.col("id"))
    sp = S.split_exact(ids, [0.65, 0.2, 0.15], 33, "id", ["a", "b", "c"])
    counts = {r.split: r["count"] for r in sp.groupBy("split").count().collect()}
    assert counts == {"a": 67, "b": 21, "c": 15}
    assert sp.select("id").distinct().count() == 103
    b = S.assign_batches(S.shuffle(ids, 33, "id"), 32, drop_last=True)
    assert b.count() == 96 and b.groupBy("batch_id").count().where("count > 32").count() == 0
    lab = spark.createDataFrame([(0,), (0,), (1,)], "label int")
    w = {r.label: r.weight for r in S.balanced_weights(lab, "label", 2).collect()}
    assert w == pytest.approx({0: 0.75, 1: 1.5})
    with pytest.raises(Exception):
        S.balanced_weights(lab, "label", 3).collect()
    cc = {r.label: r["count"] for r in S.class_counts(spark.createDataFrame([(2,)], "label int")).collect()}
    assert cc == {0: 0, 1: 0, 2: 1}


def test_vectors_and_metrics(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0], 1), ([0.0, 0.0, 5.0], 2)], "l array<double>, y int")
    r = df.select(F.aggregate(V.softmax(F.col("l")), F.lit(0.0), lambda a, x: a + x).alias("s"),
                  V.argmax(F.col("l")).alias("am")).collect()
    assert all(abs(x.s - 1) < 1e-12 for x in r) and [x.am for x in r] == [1, 2]
    p = spark.createDataFrame([(0, 0), (1, 1), (1, 0), (2, 2)], "pred int, ref int")
    micro = M.f1_score(p, average="micro").first().f1
    assert micro == pytest.approx(0.75)  # micro F1 = accuracy
    binary = M.f1_score(p, average="binary").first().f1
    assert binary == pytest.approx(2 * 1 / (2 + 1))
    empty = M.mean_metric(spark.createDataFrame([], "v double"), "v").first().v
    assert empty == 0.0


def test_extension_points_and_metric_sink(spark, tmp_path):
    from quarry.operators.extension import accuracy, custom_metric, filter_with
    from quarry.sources.sinks import append_metrics

    p = spark.createDataFrame([(0, 0), (1, 1), (1, 0), (2, 2)], "pred int, ref int")
    assert filter_with(p, lambda d: d.pred == d.ref).count() == 3
    assert custom_metric(p, accuracy()).first().accuracy == pytest.approx(0.75)
    out = str(tmp_path / "metrics")
    m = spark.createDataFrame([("train", "loss", 0, 1.5), ("valid", "loss", 0, 2.0)], "split string, metric string, step int, value double")
    append_metrics(m, out)
    append_metrics(m, out)
    back = spark.read.parquet(out)
    assert back.count() == 4 and back.where("split = 'valid'").count() == 2


def test_long_conversations_and_pairs_without_span(spark):
    flat = spark.createDataFrame([(1, i, f"u{i}") for i in range(40)], "conversation_ID long, pos int, text string")
    assert C.nest_utterances(flat).select(F.size("conversation")).first()[0] == 40
    assert C.pair_mask(flat).count() == 1600
    df = spark.createDataFrame([(1, [["3_joy", "2"]])], "conversation_ID long, `emotion-cause_pairs` array<array<string>>")
    assert C.parse_pairs(df).first().span is None


def test_concat_text_of_a_large_group(spark):
    df = spark.range(0, 10_001).select(F.lit(1).alias("k"), F.col("id").alias("o"), F.lit("x").alias("text"))
    assert X.concat_text(df, "k", "o").select(F.length("text")).first()[0] == 20_001
