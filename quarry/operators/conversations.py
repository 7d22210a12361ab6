"""Conversation shaping and labels (CNV-1..19).

Data model (declared, never inferred)::

    conversation_ID: long
    conversation: array<struct<utterance_ID:long, text:string, speaker:string,
                               emotion:string, video_name:string>>
    emotion-cause_pairs: array<array<string>>

Per-conversation work uses array functions inside the row (a conversation
is bounded: at most ``MAX_CONV_LEN`` turns, longer ones are rejected before
any per-conversation collection).  Work that relates rows of different
conversations or utterances (span lookup, char → token, pair tables) uses
equi-joins on the conversation key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import patterns as P
from .rowindex import with_row_index

UTTERANCE = T.StructType([
    T.StructField("utterance_ID", T.LongType(), False),
    T.StructField("text", T.StringType(), True),
    T.StructField("speaker", T.StringType(), True),
    T.StructField("emotion", T.StringType(), True),
    T.StructField("video_name", T.StringType(), True),
])
CONVERSATION = T.StructType([
    T.StructField("conversation_ID", T.LongType(), False),
    T.StructField("conversation", T.ArrayType(UTTERANCE), True),
    T.StructField("emotion-cause_pairs", T.ArrayType(T.ArrayType(T.StringType())), True),
])
PAIRS = "`emotion-cause_pairs`"

BOS_ID, PAD_ID, EOS_ID, UNK_ID = 0, 1, 2, 3
FIRST_TERM_ID = 4


# --------------------------------------------------------------------------- CNV-1
def add_flags(df: DataFrame, split: str, subtask: str) -> DataFrame:
    """has_spans = train ∧ subtask 1; has_emotions = has_causes = train;
    has_video = subtask 2."""
    if split not in P.SPLITS:
        raise ValueError("invalid split type")
    if subtask not in P.SUBTASKS:
        raise ValueError("invalid subtask type")
    train = split == "train"
    return df.select(
        "*",
        F.lit(train and subtask == "1").alias("has_spans"),
        F.lit(train).alias("has_emotions"),
        F.lit(train).alias("has_causes"),
        F.lit(subtask == "2").alias("has_video"),
    )


# --------------------------------------------------------------------------- CNV-2/3
def video_name(conv_id: Column, utt_id: Column, given: Column) -> Column:
    fallback = F.concat(F.lit("dia"), conv_id.cast("string"), F.lit("utt"), utt_id.cast("string"), F.lit(".mp4"))
    return F.coalesce(F.nullif(given, F.lit("")), fallback)


def fill_video(df: DataFrame, video_dir: str, subtask: str = "2") -> DataFrame:
    """Subtask 2: every utterance gets ``video_name`` (given, else
    ``dia{conv}utt{utt}.mp4``) and ``video_path`` = video_dir/name."""
    if subtask != "2":
        return df

    def fill(u: Column) -> Column:
        name = video_name(F.col("conversation_ID"), u["utterance_ID"], u["video_name"])
        return F.struct(u["utterance_ID"].alias("utterance_ID"), u["text"].alias("text"), u["speaker"].alias("speaker"),
                        u["emotion"].alias("emotion"), name.alias("video_name"),
                        F.concat(F.lit(video_dir.rstrip("/") + "/"), name).alias("video_path"))

    return df.withColumn("conversation", F.transform("conversation", fill))


def check_video_names(files: DataFrame, name_col: str = "name") -> DataFrame:
    """Rows whose file name is not ``dia<n>utt<n>.mp4`` (full match); an
    empty listing is an error."""
    if files.isEmpty():
        raise FileNotFoundError("no files were found")
    return files.where(~F.col(name_col).rlike(r"^(?:" + P.VIDEO_NAME_RX + r")\z"))


# --------------------------------------------------------------------------- CNV-4/5
def emotion_map() -> Column:
    return F.create_map(*[c for i, e in enumerate(P.EMOTIONS) for c in (F.lit(e), F.lit(i))])


def encode_emotion(emotion: Column, strict: bool = True) -> Column:
    """Fixed 7-way label; a missing emotion has no label; an unknown one is an
    error (``strict``) or null."""
    label = F.try_element_at(emotion_map(), emotion)
    if not strict:
        return label
    return (F.when(emotion.isNull(), F.lit(None).cast("int"))
            .when(label.isNull(), F.raise_error(F.concat(F.lit("unknown emotion: "), emotion)).cast("int"))
            .otherwise(label))


def decode_emotion(label: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(e) for e in P.EMOTIONS]), (label + 1).cast("int"))


# --------------------------------------------------------------------------- CNV-6
def explode_utterances(df: DataFrame) -> DataFrame:
    """One row per utterance with its 0-based position."""
    e = df.select("conversation_ID", F.posexplode("conversation").alias("pos", "u"))
    return e.select("conversation_ID", F.col("pos").cast("int").alias("pos"), "u.*")


def nest_utterances(flat: DataFrame) -> DataFrame:
    """Inverse of ``explode_utterances`` (order by ``pos``), for conversations
    of any length; the steps that pad raise on one over the maximum."""
    fields = [c for c in flat.columns if c not in ("conversation_ID", "pos")]
    g = flat.groupBy("conversation_ID").agg(F.sort_array(F.collect_list(F.struct("pos", *fields))).alias("c"))
    return g.select("conversation_ID", F.transform("c", lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("conversation"))


def reject_long(flat: DataFrame, max_len: int = P.MAX_CONV_LEN) -> DataFrame:
    """Conversations with more than ``max_len`` utterances (partial count, no
    collection): the rows a strict pipeline reports instead of padding."""
    n = flat.groupBy("conversation_ID").agg(F.count(F.lit(1)).alias("n_turns"))
    return n.where(F.col("n_turns") > max_len)


# --------------------------------------------------------------------------- CNV-13/14
def pad_array(arr: Column, n: int, value=0) -> Column:
    """Truncate or pad ``arr`` to exactly ``n`` items."""
    return F.slice(F.concat(arr, F.array_repeat(F.lit(value), n)), 1, n)


def length_mask(k: Column, n: int) -> Column:
    """1 for the first ``k`` slots, 0 for the padding up to ``n``."""
    kk = F.least(k, F.lit(n)).cast("int")
    return F.concat(F.array_repeat(F.lit(1), kk), F.array_repeat(F.lit(0), F.lit(n) - kk))


# --------------------------------------------------------------------------- CNV-7
def emotion_labels(df: DataFrame, n: int = P.MAX_CONV_LEN) -> DataFrame:
    """Padded per-conversation label array (missing label → 0)."""
    labels = F.transform("conversation", lambda u: F.coalesce(encode_emotion(u["emotion"]), F.lit(0)))
    too_long = F.size("conversation") > n
    return df.select(
        "conversation_ID",
        F.when(too_long, F.raise_error(F.lit("conversation longer than the maximum")).cast("array<int>"))
        .otherwise(pad_array(labels, n, 0)).alias("emotion_labels"),
    )


# --------------------------------------------------------------------------- CNV-8/9/10
def parse_pairs(df: DataFrame, full_span: bool = False) -> DataFrame:
    """(conversation_ID, pair_idx, utterance, cause, emotion, span): ids
    0-based; the span is the second ``_`` piece (``full_span``: everything
    after the first ``_``), null where a cause has none."""
    e = df.select("conversation_ID", F.posexplode(PAIRS).alias("pair_idx", "p"))
    eff, cau = F.element_at("p", 1), F.element_at("p", 2)
    eparts, cparts = F.split(eff, "_"), F.split(cau, "_")
    span = (F.regexp_extract(cau, r"^[^_]*_(.*)$", 1) if full_span else F.try_element_at(cparts, F.lit(2)))
    return e.select(
        "conversation_ID", F.col("pair_idx").cast("int").alias("pair_idx"),
        (F.element_at(eparts, 1).try_cast("int") - 1).alias("utterance"),
        (F.element_at(cparts, 1).try_cast("int") - 1).alias("cause"),
        F.try_element_at(eparts, F.lit(2)).alias("emotion"),
        span.alias("span"),
    )


def locate_spans(pairs: DataFrame, utterances: DataFrame) -> DataFrame:
    """Character span of each pair's text inside its cause utterance: first
    occurrence, 0-based start, inclusive end; not found → -1 (``found``)."""
    u = utterances.select("conversation_ID", F.col("pos").alias("cause"), F.col("text").alias("cause_text"))
    j = pairs.join(u, ["conversation_ID", "cause"], "left")
    boc = F.instr(F.col("cause_text"), F.col("span")) - 1
    return j.select(
        *pairs.columns,
        boc.alias("boc"),
        (boc + F.length("span") - 1).alias("eoc"),
        (boc >= 0).alias("found"),
    )


def cause_labels(pairs: DataFrame, utterances: DataFrame) -> DataFrame:
    """Per utterance: 1 when it is the cause of any pair."""
    causes = pairs.select("conversation_ID", F.col("cause").alias("pos")).distinct().withColumn("is_cause", F.lit(1))
    return utterances.select("conversation_ID", "pos").join(causes, ["conversation_ID", "pos"], "left").select(
        "conversation_ID", "pos", F.coalesce("is_cause", F.lit(0)).alias("cause_label"))


# --------------------------------------------------------------------------- tokens
def utterance_tokens(utterances: DataFrame, max_len: int | None = P.MAX_UTTR_LEN) -> DataFrame:
    """Word pieces of each utterance (split on single blanks, empty pieces
    skipped) with character offsets; token index 0 is the begin marker, so
    content tokens are 1..max_len-2 (the rest is cut; None: nothing is)."""
    words = F.split("text", " ", -1)
    lens = F.transform(words, lambda w: F.length(w) + 1)
    # one fold that carries the running sum; its last entry is the end of the text
    starts = F.aggregate(lens, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    pieces = F.filter(F.arrays_zip(words.alias("w"), starts.alias("s")), lambda p: p["w"].isNotNull())
    t = utterances.select("conversation_ID", "pos", F.filter(pieces, lambda p: F.length(p["w"]) > 0).alias("tk"))
    if max_len is not None:
        t = t.select("conversation_ID", "pos", F.slice("tk", 1, max_len - 2).alias("tk"))
    e = t.select("conversation_ID", "pos", F.posexplode("tk").alias("i", "t"))
    return e.select("conversation_ID", "pos", (F.col("i") + 1).cast("int").alias("token"),
                    F.col("t.w").alias("word"), F.col("t.s").alias("start"),
                    (F.col("t.s") + F.length("t.w")).alias("end"))


def char_to_token(points: DataFrame, tokens: DataFrame, char_col: str, out_col: str) -> DataFrame:
    """Token containing character ``char_col`` of utterance (conversation_ID,
    cause); null when no token covers it.  Range join with equi keys."""
    t = tokens.select(F.col("conversation_ID").alias("_c"), F.col("pos").alias("_p"), F.col("token").alias("_tok"),
                      F.col("start").alias("_s"), F.col("end").alias("_e"))
    cond = ((F.col("conversation_ID") == F.col("_c")) & (F.col("cause") == F.col("_p"))
            & (F.col("_s") <= F.col(char_col)) & (F.col(char_col) < F.col("_e")))
    j = points.join(t, cond, "left")
    return j.select(*points.columns, F.col("_tok").alias(out_col))


def span_matrix(spans: DataFrame, tokens: DataFrame, mask_mode: str = "sum") -> DataFrame:
    """(conversation_ID, utterance, cause) → start / stop token of the span;
    a later pair overwrites an earlier one; no token → 0.  ``mask_mode`` "sum":
    the mask is 1 unless start and stop are both 0, as the reference has it;
    "present": 1 wherever a token was found, also at place 0."""
    if mask_mode not in ("sum", "present"):
        raise ValueError("mask_mode must be 'sum' or 'present'")
    s = char_to_token(spans, tokens, "boc", "start_tok")
    s = char_to_token(s, tokens, "eoc", "stop_tok")
    g = s.groupBy("conversation_ID", "utterance", "cause").agg(
        F.max_by(F.struct(F.coalesce("start_tok", F.lit(0)).alias("start"), F.coalesce("stop_tok", F.lit(0)).alias("stop"),
                          (F.col("start_tok").isNotNull() | F.col("stop_tok").isNotNull()).alias("found")), "pair_idx").alias("m"))
    mask = (F.col("m.start") + F.col("m.stop")) != 0 if mask_mode == "sum" else F.col("m.found")
    return g.select("conversation_ID", "utterance", "cause", F.col("m.start").alias("start"), F.col("m.stop").alias("stop"),
                    mask.cast("int").alias("span_mask"))


# --------------------------------------------------------------------------- CNV-15/18
def pair_mask(utterances: DataFrame) -> DataFrame:
    """Every (i, j) of valid turns of a conversation (outer product of the
    conversation mask); self-join on the conversation key."""
    a = utterances.select("conversation_ID", F.col("pos").alias("i"))
    b = utterances.select("conversation_ID", F.col("pos").alias("j"))
    return a.join(b, "conversation_ID").select("conversation_ID", "i", "j", F.lit(1).alias("mask"))


def pair_table(features: DataFrame, feat: str = "features", causes: DataFrame | None = None) -> DataFrame:
    """(conversation_ID, i, j, features of i followed by features of j): every
    turn as emotion with every turn as cause.  ``causes`` gives the cause side
    features of its own; else both sides have the same."""
    other = features if causes is None else causes
    a = features.select("conversation_ID", F.col("pos").alias("i"), F.col(feat).alias("fa"))
    b = other.select("conversation_ID", F.col("pos").alias("j"), F.col(feat).alias("fb"))
    return a.join(b, "conversation_ID").select("conversation_ID", "i", "j", F.concat("fa", "fb").alias("features"))


# --------------------------------------------------------------------------- CNV-16
def token_vocabulary(tokens: DataFrame) -> DataFrame:
    """(word, id): ids from FIRST_TERM_ID by (count desc, word asc); the
    ranking uses the distributed row index, not a single-task window."""
    counts = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    ranked = with_row_index(counts, [F.desc("n"), F.asc("word")], "rank")
    return ranked.select("word", (F.col("rank") + FIRST_TERM_ID).cast("int").alias("id"), "n")


def encode_tokens(tokens: DataFrame, vocab: DataFrame, utterances: DataFrame, n: int = P.MAX_UTTR_LEN) -> DataFrame:
    """Per utterance: input ids [BOS, ids…, EOS] padded with PAD to ``n`` and
    the attention mask (1 on BOS/content/EOS)."""
    ids = tokens.join(vocab.select("word", "id"), "word", "left").select(
        "conversation_ID", "pos", "token", F.coalesce("id", F.lit(UNK_ID)).alias("id"))
    per = ids.groupBy("conversation_ID", "pos").agg(F.sort_array(F.collect_list(F.struct("token", "id"))).alias("t"))
    per = utterances.select("conversation_ID", "pos").join(per, ["conversation_ID", "pos"], "left")
    content = F.transform(F.coalesce("t", F.array().cast("array<struct<token:int,id:int>>")), lambda x: x["id"])
    seq = F.concat(F.array(F.lit(BOS_ID)), content, F.array(F.lit(EOS_ID)))
    return per.select("conversation_ID", "pos", pad_array(seq, n, PAD_ID).alias("input_ids"),
                      length_mask(F.size(seq), n).alias("attention_mask"))


# --------------------------------------------------------------------------- CNV-19
def span_text(words: Column, start: Column, stop: Column) -> Column:
    """Words of token positions start..stop (token 0 = begin marker) joined
    by blanks; empty when start + stop = 0."""
    return F.when(start + stop == 0, F.lit("")).otherwise(
        F.array_join(F.slice(words, F.greatest(start, F.lit(1)), stop - F.greatest(start, F.lit(1)) + 1), " "))
