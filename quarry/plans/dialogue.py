"""Registered conversation, sampling, weighting and exploration plans
(CNV, SMP, WGT, EDA) with their SQL twins.

The driver's ``conversations`` table (conv_id, turn, role, text) carries
no labels, so both engines derive them identically:

* utterance_ID = turn + 1, speaker = role;
* emotion label = (conv_id·31 + turn·7) mod 7, emotion = its name;
* video_name: turn mod 3 = 0 → ``clip{conv}_{turn}.mp4``, 1 → '' , 2 → null;
* pairs: every turn t ≥ 1 is caused by turn t−1; the span is words 2–4
  (split on single blanks) of the cause text.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..operators import conversations as C
from ..operators import explore as X
from ..operators import sampling as S
from .sqlgen import q
from .tables import load

VIDEO_DIR = "data/train/subtask_2/video"
EMO_SQL = "[" + ", ".join(q(e) for e in P.EMOTIONS) + "]"


# --------------------------------------------------------------------------- derived inputs
def utterances(spark, sf):
    c = load(spark, sf, "conversations", spread_rows=True)
    label = (F.col("conv_id") * 31 + F.col("turn") * 7) % 7
    video = (F.when(F.col("turn") % 3 == 0, F.concat(F.lit("clip"), F.col("conv_id").cast("string"), F.lit("_"),
                                                      F.col("turn").cast("string"), F.lit(".mp4")))
             .when(F.col("turn") % 3 == 1, F.lit("")).otherwise(F.lit(None).cast("string")))
    return c.select(
        F.col("conv_id").alias("conversation_ID"), F.col("turn").cast("int").alias("pos"),
        (F.col("turn") + 1).alias("utterance_ID"), "text", F.col("role").alias("speaker"),
        C.decode_emotion(label).alias("emotion"), video.alias("video_name"))


def nested(spark, sf):
    """Conversations in the nested JSON shape, with emotion-cause pairs."""
    u = utterances(spark, sf)
    w = Window.partitionBy("conversation_ID").orderBy("pos")
    prev = F.lag("text").over(w)
    span = F.array_join(F.slice(F.split(prev, " ", -1), 2, 3), " ")
    pair = F.when(F.col("pos") >= 1, F.array(
        F.concat(F.col("utterance_ID").cast("string"), F.lit("_"), F.col("emotion")),
        F.concat(F.col("pos").cast("string"), F.lit("_"), span)))
    u = u.select("*", pair.alias("pair"))
    g = u.groupBy("conversation_ID").agg(
        F.sort_array(F.collect_list(F.struct("pos", "utterance_ID", "text", "speaker", "emotion", "video_name"))).alias("c"),
        F.sort_array(F.collect_list(F.when(F.col("pair").isNotNull(), F.struct("pos", "pair")))).alias("p"))
    return g.select(
        "conversation_ID",
        F.transform("c", lambda x: F.struct(*[x[f].alias(f) for f in ("utterance_ID", "text", "speaker", "emotion", "video_name")])).alias("conversation"),
        F.transform("p", lambda x: x["pair"]).alias("emotion-cause_pairs"))


def _pairs(spark, sf):
    return C.parse_pairs(nested(spark, sf))


def _spans(spark, sf):
    return C.locate_spans(_pairs(spark, sf), C.explode_utterances(nested(spark, sf)))


def _tokens(spark, sf):
    return C.utterance_tokens(C.explode_utterances(nested(spark, sf)))


def _jn(c, sep=","):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), sep)


# --------------------------------------------------------------------------- CNV
def conv_flags(spark, sf):
    return C.add_flags(nested(spark, sf), "train", "1").select(
        "conversation_ID", "has_spans", "has_emotions", "has_causes", "has_video")


def fill_video(spark, sf):
    f = C.fill_video(nested(spark, sf), VIDEO_DIR, "2")
    return C.explode_utterances(f).select("conversation_ID", "pos", "video_name", "video_path")


def check_video_names(spark, sf):
    f = C.explode_utterances(C.fill_video(nested(spark, sf), VIDEO_DIR, "2"))
    return C.check_video_names(f, "video_name").select("conversation_ID", "pos", "video_name")


def encode_emotion(spark, sf):
    u = utterances(spark, sf)
    lab = C.encode_emotion(F.col("emotion"))
    return u.select("conversation_ID", "pos", "emotion", lab.alias("label"), C.decode_emotion(lab).alias("decoded"))


def explode_utterances(spark, sf):
    """CNV-6 round trip: nested → rows → nested → rows."""
    once = C.explode_utterances(nested(spark, sf))
    again = C.explode_utterances(C.nest_utterances(once))
    return again.select("conversation_ID", "pos", "utterance_ID", "text", "speaker", "emotion")


def emotion_labels(spark, sf):
    return C.emotion_labels(nested(spark, sf)).select("conversation_ID", _jn(F.col("emotion_labels")).alias("labels"))


def parse_pairs(spark, sf):
    return _pairs(spark, sf)


def locate_spans(spark, sf):
    return _spans(spark, sf)


def cause_labels(spark, sf):
    return C.cause_labels(_pairs(spark, sf), C.explode_utterances(nested(spark, sf)))


def char_to_token(spark, sf):
    s = _spans(spark, sf)
    t = _tokens(spark, sf)
    s = C.char_to_token(s, t, "boc", "start_tok")
    return C.char_to_token(s, t, "eoc", "stop_tok").select(
        "conversation_ID", "pair_idx", "utterance", "cause", "boc", "eoc", "start_tok", "stop_tok")


def span_matrix(spark, sf):
    return C.span_matrix(_spans(spark, sf), _tokens(spark, sf))


def span_presence(spark, sf):
    """CNV-12a: the span mask that also holds a span at token 0; tokens count
    from 0 here."""
    tokens = _tokens(spark, sf).withColumn("token", F.col("token") - 1)
    return C.span_matrix(_spans(spark, sf), tokens, mask_mode="present")


def pad_masks(spark, sf):
    """CNV-13/14: per utterance the token count and the padded mask."""
    t = _tokens(spark, sf).groupBy("conversation_ID", "pos").agg(F.count(F.lit(1)).alias("n_tok"))
    u = C.explode_utterances(nested(spark, sf)).select("conversation_ID", "pos")
    j = u.join(t, ["conversation_ID", "pos"], "left").select(
        "conversation_ID", "pos", (F.coalesce("n_tok", F.lit(0)) + 2).alias("n_tokens"))
    return j.select("*", F.array_join(C.length_mask(F.col("n_tokens"), P.MAX_UTTR_LEN).cast("array<string>"), "").alias("mask"))


def pair_mask(spark, sf):
    return C.pair_mask(C.explode_utterances(nested(spark, sf)))


def encode_tokens(spark, sf):
    t = _tokens(spark, sf)
    u = C.explode_utterances(nested(spark, sf))
    vocab = C.token_vocabulary(C.utterance_tokens(u, None))  # counted on whole utterances; only the encoding cuts
    e = C.encode_tokens(t, vocab, u)
    return e.select("conversation_ID", "pos", _jn(F.col("input_ids")).alias("input_ids"),
                    F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_attended"))


def encode_conversations(spark, sf):
    """CNV-17: conversation mask, labels, cause labels and span count."""
    n = nested(spark, sf)
    u = C.explode_utterances(n)
    labels = C.emotion_labels(n)
    causes = C.cause_labels(_pairs(spark, sf), u).groupBy("conversation_ID").agg(
        F.sort_array(F.collect_list(F.struct("pos", "cause_label"))).alias("c"))
    causes = causes.select("conversation_ID", C.pad_array(F.transform("c", lambda x: x["cause_label"]), P.MAX_CONV_LEN, 0).alias("cause_labels"))
    spans = C.span_matrix(_spans(spark, sf), _tokens(spark, sf)).groupBy("conversation_ID").agg(
        F.sum("span_mask").alias("n_spans"))
    base = n.select("conversation_ID", C.length_mask(F.size("conversation"), P.MAX_CONV_LEN).alias("conv_mask"))
    out = base.join(labels, "conversation_ID").join(causes, "conversation_ID", "left").join(spans, "conversation_ID", "left")
    return out.select("conversation_ID", _jn(F.col("conv_mask"), "").alias("conv_mask"),
                      _jn(F.col("emotion_labels")).alias("emotion_labels"),
                      _jn(F.coalesce("cause_labels", C.pad_array(F.array().cast("array<int>"), P.MAX_CONV_LEN, 0))).alias("cause_labels"),
                      F.coalesce("n_spans", F.lit(0)).alias("n_spans"))


def pair_table(spark, sf):
    u = C.explode_utterances(nested(spark, sf))
    feats = u.select("conversation_ID", "pos", F.array(F.col("pos").cast("long"), T.unit_count(F.col("text")).cast("long"),
                                                      F.length("text").cast("long")).alias("features"))
    p = C.pair_table(feats)
    return p.select("conversation_ID", "i", "j", _jn(F.col("features")).alias("features"))


def span_text(spark, sf):
    m = C.span_matrix(_spans(spark, sf), _tokens(spark, sf))
    words = _tokens(spark, sf).groupBy("conversation_ID", "pos").agg(
        F.sort_array(F.collect_list(F.struct("token", "word"))).alias("w"))
    words = words.select("conversation_ID", F.col("pos").alias("cause"), F.transform("w", lambda x: x["word"]).alias("words"))
    j = m.join(words, ["conversation_ID", "cause"], "left")
    return j.select("conversation_ID", "utterance", "cause", "start", "stop",
                    C.span_text(F.coalesce("words", F.array().cast("array<string>")), F.col("start"), F.col("stop")).alias("text"))


# --------------------------------------------------------------------------- SMP / WGT
def _conv_ids(spark, sf):
    return load(spark, sf, "conversations").select(F.col("conv_id").alias("id")).distinct()


def split_exact(spark, sf):
    return S.split_exact(_conv_ids(spark, sf), [0.65, 0.20, 0.15], P.SEED, "id", ["train", "valid", "test"])


def shuffle(spark, sf):
    tr = split_exact(spark, sf).where(F.col("split") == "train").select("id")
    return S.shuffle(tr, P.SEED, "id")


def _doc_batches(spark, sf):
    d = load(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return S.assign_batches(S.shuffle(d, P.SEED, "id"), P.BATCH_SIZE, drop_last=True)


def assign_batches(spark, sf):
    return _doc_batches(spark, sf).select("id", "order", "batch_id", "in_batch")


def collate(spark, sf):
    c = S.collate(_doc_batches(spark, sf), ["id"])
    return c.select("batch_id", "batch_len", _jn(F.col("id")).alias("ids"))


def _emb(spark, sf):
    return load(spark, sf, "embeddings", spread_rows=True)


def class_counts(spark, sf):
    return S.class_counts(_emb(spark, sf), "label")


def balanced_weights(spark, sf):
    w = S.balanced_weights(_emb(spark, sf), "label", 10)
    return w.select("label", F.round("weight", 6).alias("weight"))


def chain(spark, sf):
    """SMP-5 / WGT-3: label → class weights → attach, as one composed transform."""
    u = utterances(spark, sf)
    weights = S.balanced_weights(u.select(C.encode_emotion(F.col("emotion")).alias("label")), "label", 7)
    step1 = lambda df: df.select("conversation_ID", "pos", C.encode_emotion(F.col("emotion")).alias("label"))
    step2 = lambda df: S.apply_weights(df, weights, "label")
    out = S.chain(step1, step2)(u)
    return out.select("conversation_ID", "pos", "label", F.round("weight", 6).alias("weight"))


# --------------------------------------------------------------------------- EDA
def _utt_rows(spark, sf):
    return load(spark, sf, "conversations", spread_rows=True)


def conversation_lengths(spark, sf):
    return X.conversation_lengths(_utt_rows(spark, sf))


def tokens_per_utterance(spark, sf):
    return X.tokens_per_utterance(_utt_rows(spark, sf))


def units_per_utterance(spark, sf):
    return X.units_per_utterance(_utt_rows(spark, sf))


def histogram(spark, sf):
    return X.histogram(X.units_per_utterance(_utt_rows(spark, sf)), "n_units")


def category_counts(spark, sf):
    return X.category_counts(utterances(spark, sf), "emotion")


def concat_text(spark, sf):
    return X.text_parts(_utt_rows(spark, sf), "conv_id", ["turn"], rows_a_part=3)


def top_terms(spark, sf):
    return X.top_terms(utterances(spark, sf), "emotion", "text", 200)


QUERIES = {
    "conv_flags": conv_flags, "fill_video": fill_video, "check_video_names": check_video_names,
    "encode_emotion": encode_emotion, "explode_utterances": explode_utterances, "emotion_labels": emotion_labels,
    "parse_pairs": parse_pairs, "locate_spans": locate_spans, "cause_labels": cause_labels,
    "char_to_token": char_to_token, "span_matrix": span_matrix, "span_presence": span_presence, "pad_masks": pad_masks, "pair_mask": pair_mask,
    "encode_tokens": encode_tokens, "encode_conversations": encode_conversations, "pair_table": pair_table,
    "span_text": span_text,
    "split_exact": split_exact, "shuffle": shuffle, "assign_batches": assign_batches, "collate": collate,
    "class_counts": class_counts, "balanced_weights": balanced_weights, "chain": chain,
    "conversation_lengths": conversation_lengths, "tokens_per_utterance": tokens_per_utterance,
    "units_per_utterance": units_per_utterance, "histogram": histogram, "category_counts": category_counts,
    "concat_text": concat_text, "top_terms": top_terms,
}

# --------------------------------------------------------------------------- SQL
U = f"""u AS (
  SELECT conv_id AS conversation_ID, CAST(turn AS INTEGER) AS pos, turn + 1 AS utterance_ID, text, role AS speaker,
         {EMO_SQL}[((conv_id * 31 + turn * 7) % 7) + 1] AS emotion,
         CAST((conv_id * 31 + turn * 7) % 7 AS INTEGER) AS label,
         CASE WHEN turn % 3 = 0 THEN 'clip' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) || '.mp4'
              WHEN turn % 3 = 1 THEN '' ELSE NULL END AS video_name
  FROM conversations)"""
PAIRS_SQL = f"""{U},
  up AS (SELECT *, lag(text) OVER (PARTITION BY conversation_ID ORDER BY pos) AS prev FROM u),
  pr AS (SELECT conversation_ID, CAST(row_number() OVER (PARTITION BY conversation_ID ORDER BY pos) - 1 AS INTEGER) AS pair_idx,
                CAST(utterance_ID AS VARCHAR) || '_' || emotion AS eff,
                CAST(pos AS VARCHAR) || '_' || array_to_string(string_split(prev, ' ')[2:4], ' ') AS cau
         FROM up WHERE pos >= 1),
  pairs AS (SELECT conversation_ID, pair_idx,
                   TRY_CAST(string_split(eff, '_')[1] AS INTEGER) - 1 AS utterance,
                   TRY_CAST(string_split(cau, '_')[1] AS INTEGER) - 1 AS cause,
                   string_split(eff, '_')[2] AS emotion, string_split(cau, '_')[2] AS span FROM pr),
  spans AS (SELECT p.*, instr(c.text, p.span) - 1 AS boc, instr(c.text, p.span) - 1 + length(p.span) - 1 AS eoc,
                   instr(c.text, p.span) - 1 >= 0 AS found
            FROM pairs p LEFT JOIN u c ON c.conversation_ID = p.conversation_ID AND c.pos = p.cause),
  w0 AS (SELECT conversation_ID, pos, string_split(text, ' ') AS ws FROM u),
  w1 AS (SELECT conversation_ID, pos, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS k FROM w0),
  w2 AS (SELECT *, coalesce(sum(length(word) + 1) OVER (PARTITION BY conversation_ID, pos ORDER BY k
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM w1),
  w3 AS (SELECT conversation_ID, pos, word, start, start + length(word) AS "end",
                row_number() OVER (PARTITION BY conversation_ID, pos ORDER BY k) AS token FROM w2 WHERE length(word) > 0),
  toks AS (SELECT conversation_ID, pos, CAST(token AS INTEGER) AS token, word, start, "end" FROM w3
           WHERE token <= {P.MAX_UTTR_LEN - 2}),
  c2t AS (SELECT s.*, a.token AS start_tok, b.token AS stop_tok FROM spans s
          LEFT JOIN toks a ON a.conversation_ID = s.conversation_ID AND a.pos = s.cause AND a.start <= s.boc AND s.boc < a."end"
          LEFT JOIN toks b ON b.conversation_ID = s.conversation_ID AND b.pos = s.cause AND b.start <= s.eoc AND s.eoc < b."end"),
  smat AS (SELECT conversation_ID, utterance, cause, m.start AS start, m.stop AS stop,
                  CAST(m.start + m.stop <> 0 AS INTEGER) AS span_mask
           FROM (SELECT conversation_ID, utterance, cause,
                        max_by({{'start': coalesce(start_tok, 0), 'stop': coalesce(stop_tok, 0)}}, pair_idx) AS m
                 FROM c2t GROUP BY conversation_ID, utterance, cause)),
  causes AS (SELECT u.conversation_ID, u.pos,
                    CASE WHEN EXISTS (SELECT 1 FROM pairs p WHERE p.conversation_ID = u.conversation_ID AND p.cause = u.pos)
                         THEN 1 ELSE 0 END AS cause_label FROM u)"""


def _pad_sql(list_expr: str, n: int, v) -> str:
    return f"list_resize({list_expr}, {n}, {v})"


def _split_sql(src: str) -> str:
    """split_exact in SQL over ``src(id)``."""
    f = [0.65, 0.20, 0.15]
    return f"""
  ids AS ({src}),
  ranked AS (SELECT id, row_number() OVER (ORDER BY md5('{P.SEED}|' || CAST(id AS VARCHAR)), id) - 1 AS i FROM ids),
  nn AS (SELECT count(*) AS n FROM ids),
  sz AS (SELECT n, CAST(floor(n * {f[0]}) AS BIGINT) AS s0, CAST(floor(n * {f[1]}) AS BIGINT) AS s1,
                CAST(floor(n * {f[2]}) AS BIGINT) AS s2 FROM nn),
  sz2 AS (SELECT *, n - s0 - s1 - s2 AS r FROM sz),
  bnd AS (SELECT s0 + CASE WHEN r > 0 THEN 1 ELSE 0 END AS b0,
                 s0 + CASE WHEN r > 0 THEN 1 ELSE 0 END + s1 + CASE WHEN r > 1 THEN 1 ELSE 0 END AS b1 FROM sz2),
  splits AS (SELECT id, CASE WHEN i < b0 THEN 'train' WHEN i < b1 THEN 'valid' ELSE 'test' END AS split, i
             FROM ranked, bnd)"""


_BATCH_SQL = f"""WITH
  d AS (SELECT doc_id AS id FROM documents),
  o AS (SELECT id, row_number() OVER (ORDER BY md5('{P.SEED}|' || CAST(id AS VARCHAR)), id) - 1 AS "order" FROM d),
  full_n AS (SELECT (count(*) // {P.BATCH_SIZE}) * {P.BATCH_SIZE} AS f FROM d),
  b AS (SELECT id, "order", CAST("order" // {P.BATCH_SIZE} AS BIGINT) AS batch_id,
               CAST("order" % {P.BATCH_SIZE} AS INTEGER) AS in_batch FROM o, full_n WHERE "order" < f)"""

_TOKRX = q(P.TOKEN_RX)
_ALNUM = q(P.ALNUM_RX)
_TOKCOUNT = f"len(list_filter(regexp_extract_all(text, {_TOKRX}, 0), lambda t: regexp_matches(t, {_ALNUM})))"

SQL = {
    "conv_flags": "SELECT DISTINCT conv_id AS conversation_ID, true AS has_spans, true AS has_emotions, "
                  "true AS has_causes, false AS has_video FROM conversations",
    "fill_video": f"""WITH {U}
        SELECT conversation_ID, pos, v AS video_name, '{VIDEO_DIR}/' || v AS video_path FROM (
          SELECT conversation_ID, pos, coalesce(nullif(video_name, ''),
                 'dia' || CAST(conversation_ID AS VARCHAR) || 'utt' || CAST(utterance_ID AS VARCHAR) || '.mp4') AS v FROM u)""",
    "check_video_names": f"""WITH {U}
        SELECT conversation_ID, pos, v AS video_name FROM (
          SELECT conversation_ID, pos, coalesce(nullif(video_name, ''),
                 'dia' || CAST(conversation_ID AS VARCHAR) || 'utt' || CAST(utterance_ID AS VARCHAR) || '.mp4') AS v FROM u)
        WHERE NOT regexp_full_match(v, {q(P.VIDEO_NAME_RX)})""",
    "encode_emotion": f"WITH {U} SELECT conversation_ID, pos, emotion, label, {EMO_SQL}[label + 1] AS decoded FROM u",
    "explode_utterances": f"WITH {U} SELECT conversation_ID, pos, utterance_ID, text, speaker, emotion FROM u",
    "emotion_labels": f"""WITH {U}
        SELECT conversation_ID, array_to_string({_pad_sql('list(label ORDER BY pos)', P.MAX_CONV_LEN, 0)}, ',') AS labels
        FROM u GROUP BY conversation_ID""",
    "parse_pairs": f"WITH {PAIRS_SQL} SELECT conversation_ID, pair_idx, utterance, cause, emotion, span FROM pairs",
    "locate_spans": f"WITH {PAIRS_SQL} SELECT * FROM spans",
    "cause_labels": f"WITH {PAIRS_SQL} SELECT * FROM causes",
    "char_to_token": f"""WITH {PAIRS_SQL}
        SELECT conversation_ID, pair_idx, utterance, cause, boc, eoc, start_tok, stop_tok FROM c2t""",
    "span_matrix": f"WITH {PAIRS_SQL} SELECT * FROM smat",
    "span_presence": f"""WITH {PAIRS_SQL}
        SELECT conversation_ID, utterance, cause, m.a AS start, m.b AS stop, m.found AS span_mask FROM (
          SELECT conversation_ID, utterance, cause, max_by({{'a': coalesce(start_tok - 1, 0), 'b': coalesce(stop_tok - 1, 0),
                 'found': CAST(start_tok IS NOT NULL OR stop_tok IS NOT NULL AS INTEGER)}}, pair_idx) AS m
          FROM c2t GROUP BY conversation_ID, utterance, cause)""",
    "pad_masks": f"""WITH {PAIRS_SQL}
        SELECT u.conversation_ID, u.pos, coalesce(t.n, 0) + 2 AS n_tokens,
               repeat('1', least(coalesce(t.n, 0) + 2, {P.MAX_UTTR_LEN})) ||
               repeat('0', {P.MAX_UTTR_LEN} - least(coalesce(t.n, 0) + 2, {P.MAX_UTTR_LEN})) AS mask
        FROM u LEFT JOIN (SELECT conversation_ID, pos, count(*) AS n FROM toks GROUP BY ALL) t
          ON t.conversation_ID = u.conversation_ID AND t.pos = u.pos""",
    "pair_mask": f"""WITH {U}
        SELECT a.conversation_ID, a.pos AS i, b.pos AS j, 1 AS mask
        FROM u a JOIN u b ON a.conversation_ID = b.conversation_ID""",
    "encode_tokens": f"""WITH {PAIRS_SQL},
        vocab AS (SELECT word, CAST(row_number() OVER (ORDER BY n DESC, word ASC) - 1 + {C.FIRST_TERM_ID} AS INTEGER) AS id
                  FROM (SELECT word, count(*) AS n FROM w3 GROUP BY word)),
        ids AS (SELECT t.conversation_ID, t.pos, list(v.id ORDER BY t.token) AS l
                FROM toks t JOIN vocab v USING (word) GROUP BY t.conversation_ID, t.pos)
        SELECT u.conversation_ID, u.pos,
               array_to_string({_pad_sql(f"list_concat([{C.BOS_ID}], coalesce(ids.l, []), [{C.EOS_ID}])", P.MAX_UTTR_LEN, C.PAD_ID)}, ',') AS input_ids,
               least(len(coalesce(ids.l, [])) + 2, {P.MAX_UTTR_LEN}) AS n_attended
        FROM u LEFT JOIN ids ON ids.conversation_ID = u.conversation_ID AND ids.pos = u.pos""",
    "encode_conversations": f"""WITH {PAIRS_SQL}
        SELECT u.conversation_ID,
               repeat('1', least(count(*), {P.MAX_CONV_LEN})) || repeat('0', {P.MAX_CONV_LEN} - least(count(*), {P.MAX_CONV_LEN})) AS conv_mask,
               array_to_string({_pad_sql('list(u.label ORDER BY u.pos)', P.MAX_CONV_LEN, 0)}, ',') AS emotion_labels,
               array_to_string({_pad_sql('list(c.cause_label ORDER BY u.pos)', P.MAX_CONV_LEN, 0)}, ',') AS cause_labels,
               coalesce(max(s.n_spans), 0) AS n_spans
        FROM u JOIN causes c ON c.conversation_ID = u.conversation_ID AND c.pos = u.pos
        LEFT JOIN (SELECT conversation_ID, sum(span_mask) AS n_spans FROM smat GROUP BY conversation_ID) s
          ON s.conversation_ID = u.conversation_ID
        GROUP BY u.conversation_ID""",
    "pair_table": f"""WITH {U},
        f AS (SELECT conversation_ID, pos, [CAST(pos AS BIGINT), CAST(len(string_split(text, ' ')) AS BIGINT),
                                           CAST(length(text) AS BIGINT)] AS feats FROM u)
        SELECT a.conversation_ID, a.pos AS i, b.pos AS j, array_to_string(list_concat(a.feats, b.feats), ',') AS features
        FROM f a JOIN f b ON a.conversation_ID = b.conversation_ID""",
    "span_text": f"""WITH {PAIRS_SQL},
        words AS (SELECT conversation_ID, pos AS cause, list(word ORDER BY token) AS ws FROM toks GROUP BY ALL)
        SELECT m.conversation_ID, m.utterance, m.cause, m.start, m.stop,
               CASE WHEN m.start + m.stop = 0 THEN ''
                    ELSE array_to_string(coalesce(w.ws, [])[greatest(m.start, 1):m.stop], ' ') END AS text
        FROM smat m LEFT JOIN words w ON w.conversation_ID = m.conversation_ID AND w.cause = m.cause""",
    "split_exact": f"WITH {_split_sql('SELECT DISTINCT conv_id AS id FROM conversations')} SELECT id, split FROM splits",
    "shuffle": f"""WITH {_split_sql('SELECT DISTINCT conv_id AS id FROM conversations')}
        SELECT id, row_number() OVER (ORDER BY md5('{P.SEED}|' || CAST(id AS VARCHAR)), id) - 1 AS "order"
        FROM splits WHERE split = 'train'""",
    "assign_batches": f'{_BATCH_SQL} SELECT id, "order", batch_id, in_batch FROM b',
    "collate": f"""{_BATCH_SQL}
        SELECT batch_id, count(*) AS batch_len, array_to_string(list(CAST(id AS VARCHAR) ORDER BY in_batch), ',') AS ids
        FROM b GROUP BY batch_id""",
    "class_counts": """SELECT s.label, coalesce(c.n, 0) AS count
        FROM (SELECT CAST(unnest(range(0, max(label) + 1)) AS INTEGER) AS label FROM embeddings) s
        LEFT JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY label) c ON c.label = s.label""",
    "balanced_weights": """SELECT label, round(tot.n / (10 * count(*)), 6) AS weight
        FROM embeddings, (SELECT count(*) AS n FROM embeddings) tot GROUP BY label, tot.n""",
    "chain": f"""WITH {U},
        wts AS (SELECT label, tot.n / (7.0 * count(*)) AS weight FROM u, (SELECT count(*) AS n FROM u) tot
                GROUP BY label, tot.n)
        SELECT u.conversation_ID, u.pos, u.label, round(w.weight, 6) AS weight FROM u LEFT JOIN wts w USING (label)""",
    "conversation_lengths": "SELECT conv_id, count(*) AS n_turns FROM conversations GROUP BY conv_id",
    "tokens_per_utterance": f"SELECT conv_id, turn, {_TOKCOUNT} AS n_tokens FROM conversations",
    "units_per_utterance": "SELECT conv_id, turn, len(string_split(text, ' ')) AS n_units FROM conversations",
    "histogram": "SELECT len(string_split(text, ' ')) AS value, count(*) AS count FROM conversations GROUP BY 1",
    "category_counts": f"WITH {U} SELECT emotion AS category, count(*) AS count FROM u GROUP BY emotion",
    "concat_text": """SELECT conv_id, CAST(i // 3 AS BIGINT) AS part, string_agg(text, ' ' ORDER BY turn) AS text FROM (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations) GROUP BY conv_id, i // 3""",
    "top_terms": f"""WITH {U},
        t AS (SELECT emotion, lower(unnest(list_filter(regexp_extract_all(text, {_TOKRX}, 0),
                                                    lambda t: regexp_matches(t, {_ALNUM})))) AS term FROM u),
        c AS (SELECT emotion, term, count(*) AS count FROM t GROUP BY emotion, term)
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY emotion ORDER BY count DESC, term ASC) AS rank FROM c)
        WHERE rank <= 200""",
}
