"""Queries over token ids, labels and vocabularies."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepmark.functions import labels as L
from stepmark.functions.text import BAD, GOOD, IMAGE, tokenize_text
from stepmark.operators import messages as M
from stepmark.operators import reports as R
from stepmark.operators import tokens as T
from stepmark.operators.batches import seeded_hash
from stepmark.plans import adapters as A
from stepmark.plans import sql
from stepmark.plans.catalog import query
from stepmark.session import spread


def joined(column: str):
    return F.array_join(F.col(column).cast("array<string>"), ",")


def labelled(spark, sf_dir):
    """(doc_id, block, ids, labels) with only the marks counting; vocabulary; ids of the marks."""
    df, vocab = A.encoded_blocks(spark, sf_dir)
    good, bad = A.mark_ids(vocab)
    return df.withColumn("labels", L.mask_keep(F.col("ids"), [good, bad])), vocab, good, bad


@query(
    "tokenize_text",
    f"WITH {sql.TOKENS} SELECT doc_id, len(t)::INTEGER AS n_tokens, array_to_string(t, ' ') AS tokens FROM toks",
)
def tokenize(spark, sf_dir):
    return A.tokenized(spark, sf_dir).select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens")
    )


@query(
    "build_vocab",
    f"WITH {sql.VOCAB} SELECT token, token_id FROM vocab ORDER BY token_id LIMIT {A.VOCAB_SIZE}",
)
def build_vocab(spark, sf_dir):
    return T.build_vocab(A.tokenized(spark, sf_dir), A.VOCAB_SIZE)


@query(
    "vocab_lookup",
    f"WITH {sql.ENCODED} SELECT doc_id, string_agg(id, ',' ORDER BY pos) AS ids FROM enc GROUP BY doc_id",
)
def vocab_lookup(spark, sf_dir):
    return A.encoded(spark, sf_dir)[0].select("doc_id", joined("ids").alias("ids"))


@query("full_vocab", f"WITH {sql.VOCAB} SELECT token, token_id FROM vocab")
def full_vocab(spark, sf_dir):
    return T.full_vocab(A.tokenized(spark, sf_dir))


@query(
    "vocab_lookup_by_join",
    f"WITH {sql.ENCODED} SELECT doc_id, string_agg(id, ',' ORDER BY pos) AS ids FROM enc GROUP BY doc_id",
)
def vocab_lookup_by_join(spark, sf_dir):
    """The way for vocabularies beyond the broadcast bounds."""
    tokens = T.in_blocks(A.tokenized(spark, sf_dir), "block")
    vocab = A.corpus_vocab(tokens)
    unknown = F.lit(T.UNKNOWN_ID)
    encoded = T.lookup_by_join(tokens, vocab, "doc_id", "tokens", "token", "ids", "token_id", unknown, block="block")
    return encoded.select("doc_id", joined("ids").alias("ids"))


@query(
    "vocab_reverse_lookup",
    f"""WITH {sql.ENCODED}
SELECT doc_id, string_agg(coalesce(known, '<UNKNOWN:-1>'), ',' ORDER BY pos) AS tokens FROM enc GROUP BY doc_id""",
)
def vocab_reverse_lookup(spark, sf_dir):
    df, vocab = A.encoded_blocks(spark, sf_dir)
    decoded = T.vocab_reverse_lookup(df, vocab, "doc_id", block="block")
    return decoded.select("doc_id", F.array_join("tokens", ",").alias("tokens"))


@query(
    "decoded_text",
    f"""WITH {sql.ENCODED}
SELECT doc_id, string_agg(coalesce(known, '<UNKNOWN:-1>'), ' ' ORDER BY pos) AS decoded_text
FROM enc GROUP BY doc_id""",
)
def decoded_text(spark, sf_dir):
    df, vocab = A.encoded_blocks(spark, sf_dir)
    return R.decoded_text(df, vocab, "doc_id", block="block").select("doc_id", "decoded_text")


@query(
    "mask_keep",
    f"WITH {sql.ENCODED} SELECT doc_id, string_agg(label, ',' ORDER BY pos) AS labels FROM lab GROUP BY doc_id",
)
def mask_keep(spark, sf_dir):
    return labelled(spark, sf_dir)[0].select("doc_id", joined("labels").alias("labels"))


@query(
    "mask_drop",
    f"""WITH {sql.ENCODED}
SELECT doc_id, string_agg(CASE WHEN known IN ('<image>', ',') THEN -100 ELSE id END, ',' ORDER BY pos) AS labels
FROM enc GROUP BY doc_id""",
)
def mask_drop(spark, sf_dir):
    df, vocab = A.encoded(spark, sf_dir)
    drop = list(T.token_ids(vocab, [IMAGE, ","]).values())
    return df.withColumn("labels", L.mask_drop(F.col("ids"), drop)).select("doc_id", joined("labels").alias("labels"))


@query(
    "supervised_count",
    f"WITH {sql.ENCODED} SELECT doc_id, count(*) FILTER (label <> -100) AS n_supervised FROM lab GROUP BY doc_id",
)
def supervised_count(spark, sf_dir):
    return R.with_supervised_count(labelled(spark, sf_dir)[0]).select("doc_id", "n_supervised")


@query(
    "good_bad_count",
    f"""WITH {sql.ENCODED}
SELECT doc_id, count(*) FILTER (known = '<+>') AS n_good, count(*) FILTER (known = '<->') AS n_bad
FROM lab GROUP BY doc_id""",
)
def good_bad_count(spark, sf_dir):
    df, _, good, bad = labelled(spark, sf_dir)
    return R.good_bad_count(df, good, bad).select("doc_id", "n_good", "n_bad")


_TURN_MARK = "CASE WHEN substr(md5(concat(conv_id, '-', turn)), 1, 1) < '8' THEN '<+>' ELSE '<->' END"


@query(
    "good_bad_count_by_conversation",
    f"""WITH turns AS (
  SELECT conv_id, role, CASE WHEN (conv_id + turn) % 11 = 0 THEN NULL
                       WHEN role = 'assistant' THEN {_TURN_MARK} ELSE text END AS text
  FROM conversations
),
tok AS (
  SELECT conv_id, unnest(regexp_extract_all(
    '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '{sql.TOKEN_PATTERN}', 1)) AS token
  FROM turns WHERE text IS NOT NULL
)
SELECT c.conv_id, count(token) FILTER (token = '<+>') AS n_good, count(token) FILTER (token = '<->') AS n_bad
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN tok USING (conv_id) GROUP BY c.conv_id""",
)
def good_bad_count_by_conversation(spark, sf_dir):
    messages = M.drop_empty_messages(M.clean_items_media_first(F.col("messages")))
    tokens = tokenize_text(M.render_chat(messages))

    def marks(mark: str):
        return F.sum(F.size(F.filter(tokens, lambda t: t == mark)).cast("bigint"))

    turns = A.turn_examples(spark, sf_dir)
    return turns.groupBy("conv_id").agg(marks(GOOD).alias("n_good"), marks(BAD).alias("n_bad"))


@query(
    "pad_conflict_count",
    f"WITH {sql.ENCODED} SELECT doc_id, count(*) FILTER (known = ',') AS n_conflicts FROM enc GROUP BY doc_id",
)
def pad_conflict_count(spark, sf_dir):
    df, vocab = A.encoded(spark, sf_dir)
    ids = T.token_ids(vocab, [IMAGE, ","])
    dropped = df.withColumn("labels", L.mask_drop(F.col("ids"), [ids[IMAGE]]))
    return R.with_pad_conflicts(dropped, ids[","]).select("doc_id", "n_conflicts")


@query(
    "no_supervision_examples",
    f"""WITH {sql.ENCODED},
first AS (SELECT doc_id, CASE WHEN known = '<image>' THEN id ELSE -100 END AS label FROM enc)
SELECT doc_id FROM first GROUP BY doc_id HAVING count(*) FILTER (label <> -100) = 0""",
)
def no_supervision_examples(spark, sf_dir):
    """With the image mark as the only one that counts: examples without an image have none."""
    df, vocab = A.encoded(spark, sf_dir)
    keep = list(T.token_ids(vocab, [IMAGE]).values())
    return R.no_supervision_examples(df.withColumn("labels", L.mask_keep(F.col("ids"), keep))).select("doc_id")


@query(
    "supervised_text",
    f"""WITH {sql.ENCODED}
SELECT doc_id, coalesce(string_agg(id, ',' ORDER BY pos) FILTER (label <> -100), '') AS supervised_ids,
       coalesce(string_agg(known, ' ' ORDER BY pos) FILTER (label <> -100), '') AS supervised_text
FROM lab GROUP BY doc_id""",
)
def supervised_text(spark, sf_dir):
    df, vocab, _, _ = labelled(spark, sf_dir)
    return R.supervised_text(df, vocab, "doc_id", block="block").select(
        "doc_id", joined("supervised_ids").alias("supervised_ids"), "supervised_text"
    )


@query(
    "token_status",
    f"""WITH {sql.ENCODED}
SELECT doc_id, pos::INTEGER AS pos, id AS token_id, label, coalesce(known, '<UNKNOWN:-1>') AS token,
       CASE WHEN label = -100 THEN 'MASKED' WHEN known = '<+>' THEN 'GOOD_TOKEN'
            WHEN known = '<->' THEN 'BAD_TOKEN' ELSE 'UNMASKED' END AS status
FROM (SELECT doc_id, pos, id, known, CASE WHEN known IN ('<image>', ',') THEN -100 ELSE id END AS label FROM enc)""",
)
def token_status(spark, sf_dir):
    df, vocab = A.encoded_blocks(spark, sf_dir)
    good, bad = A.mark_ids(vocab)
    drop = list(T.token_ids(vocab, [IMAGE, ","]).values())
    dropped = df.withColumn("labels", L.mask_drop(F.col("ids"), drop))
    return R.token_status(dropped, vocab, "doc_id", good, bad, block="block")


@query(
    "truncate_right",
    f"""WITH {sql.ENCODED}
SELECT doc_id, string_agg(id, ',' ORDER BY pos) AS ids FROM enc WHERE pos < 512 GROUP BY doc_id""",
)
def truncate_right(spark, sf_dir):
    df, _ = A.encoded(spark, sf_dir)
    return df.withColumn("ids", L.truncate_right(F.col("ids"), 512)).select("doc_id", joined("ids").alias("ids"))


@query(
    "token_accuracy",
    f"""WITH {sql.ENCODED},
preds AS (
  SELECT label, CASE WHEN substr(md5(concat(doc_id, '-', pos)), 1, 1) < '3' THEN -1 ELSE label END AS predicted
  FROM lab WHERE label <> -100
)
SELECT count(*) FILTER (predicted = label) AS hits, count(*) AS supervised,
       round(count(*) FILTER (predicted = label) / count(*), 6) AS token_accuracy
FROM preds""",
)
def token_accuracy(spark, sf_dir):
    df, _, _, _ = labelled(spark, sf_dir)
    wrong = lambda i: F.substring(seeded_hash(F.col("doc_id"), i), 1, 1) < "3"
    predicted = F.transform("labels", lambda l, i: F.when((l != L.IGNORED) & wrong(i), F.lit(-1)).otherwise(l))
    result = R.token_accuracy(df.withColumn("predicted", predicted))
    return result.withColumn("token_accuracy", F.round("token_accuracy", 6))


_NEW_TOKENS = """
special AS (
  SELECT source AS token, min(doc_id) AS position FROM documents GROUP BY source
  UNION ALL SELECT '<+>', -2 UNION ALL SELECT '<->', -1
)"""


def _new_tokens(spark, sf_dir):
    """The marks, and every source name of the documents by first appearance."""
    marks = spark.createDataFrame([(GOOD, -2), (BAD, -1)], "token string, position bigint")
    sources = A.table(spark, sf_dir, "documents").groupBy(F.col("source").alias("token"))
    return marks.unionByName(sources.agg(F.min("doc_id").alias("position")))


@query(
    "special_token_union",
    f"""WITH {sql.VOCAB}, {_NEW_TOKENS}
SELECT token, min(later)::INTEGER AS is_new, min(position) FILTER (later = least_later) AS position
FROM (SELECT *, min(later) OVER (PARTITION BY token) AS least_later FROM (
  SELECT token, token_id::BIGINT AS position, 0 AS later FROM vocab
  UNION ALL SELECT token, position, 1 FROM special))
GROUP BY token""",
)
def special_token_union(spark, sf_dir):
    vocab = A.corpus_vocab(A.tokenized(spark, sf_dir))
    existing = vocab.select("token", F.col("token_id").cast("bigint").alias("position"))
    return T.special_token_union(existing, _new_tokens(spark, sf_dir))


@query(
    "extend_vocab",
    f"""WITH {sql.VOCAB}, {_NEW_TOKENS}
SELECT token, token_id FROM vocab
UNION ALL
SELECT token, ((SELECT max(token_id) FROM vocab)
               + row_number() OVER (ORDER BY position, token))::INTEGER AS token_id
FROM special WHERE token NOT IN (SELECT token FROM vocab)""",
)
def extend_vocab(spark, sf_dir):
    return T.extend_vocab(A.corpus_vocab(A.tokenized(spark, sf_dir)), _new_tokens(spark, sf_dir))


@query(
    "check_token_ids",
    f"""WITH {sql.VOCAB},
wanted(token, expected_id) AS (
  VALUES ('<+>', 151666), ('<->', 151665), ('<nowhere>', 0)
  UNION ALL SELECT token, token_id FROM vocab WHERE token = '<image>')
SELECT token, expected_id, token_id,
       CASE WHEN token_id IS NULL THEN 'unknown token' WHEN token_id <> expected_id THEN 'unexpected id'
            ELSE 'same id as padding' END AS problem
FROM wanted LEFT JOIN vocab USING (token)""",
)
def check_token_ids(spark, sf_dir):
    """Against the ids of a model vocabulary, and an image mark that padding shares: all are violations."""
    vocab = A.corpus_vocab(A.tokenized(spark, sf_dir))
    image = T.token_ids(vocab, [IMAGE])[IMAGE]
    expected = {GOOD: 151666, BAD: 151665, "<nowhere>": 0, IMAGE: image}
    return T.check_token_ids(vocab, expected, pad_id=image)


def utf8_bytes():
    """A tokenizer factory: the ids of a text are its bytes."""
    return lambda texts: [list(text.encode()) for text in texts]


@query(
    "tokenizer_plugin",
    "SELECT doc_id, strlen(text)::INTEGER AS n_ids, md5(upper(hex(encode(text)))) AS ids FROM documents",
)
def tokenizer_plugin(spark, sf_dir):
    encode = T.tokenizer_plugin(utf8_bytes)
    docs = spread(A.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    ids = docs.select("doc_id", encode("text").alias("ids"))
    as_hex = F.array_join(F.transform("ids", lambda i: F.lpad(F.hex(i), 2, "0")), "")
    return ids.select("doc_id", F.size("ids").alias("n_ids"), F.md5(as_hex).alias("ids"))
