"""The operators over the given tables, as registered queries, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepmark.llm import (
    alignment,
    collocations,
    decontaminate,
    embedding_dedup,
    language,
    mixing,
    ngram_join,
    quality,
    secrets,
    sharding,
    suffix_dedup,
    token_files,
    wrappers,
)
from stepmark.llm.common import held_out

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(secrets.as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.as_text(F.col("found")).alias("spans"),
    )


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 3, 1)
    model = quality.train(docs, _table(spark, sf_dir, "labels").where(~out), label="quality")
    scored = quality.score(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = wrappers.extract(_table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(_table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    tokenizer = tokenizer or token_files.default_tokenizer()
    manifest = token_files.write_token_files(_table(spark, sf_dir, "documents"), token_files.token_folder(spark), tokenizer)
    return token_files.read_token_files(manifest)


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: Levels of the water: with the k sources of smallest cap per weight full, the rest share by weight.
#: The level rises with k as long as the next source is full too, so the one in force is the highest.
MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint AS size,
         ('0x' || substr(md5(concat('17-', coalesce(doc_id::varchar, ''))), 1, 15))::bigint AS unit
  FROM documents),
sources AS (
  SELECT source, source_size, 2 * source_size AS cap,
         ([3, 1, 2])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::int] AS weight
  FROM (SELECT source, sum(size)::bigint AS source_size FROM sizes GROUP BY source)),
filled AS (
  SELECT *, coalesce(sum(cap) OVER below, 0) AS taken, sum(weight) OVER rest AS free, sum(source_size) OVER () AS total
  FROM sources
  WINDOW below AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
  SELECT coalesce(max((1.5::double * total - taken) / free), 0) AS level
  FROM filled),
targets AS (
  SELECT source, source_size, least(cap::double, level * weight) AS target,
         CASE WHEN source_size > 0 THEN floor(least(cap::double, level * weight) / source_size)::bigint ELSE 0 END AS whole
  FROM sources, level),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.whole,
         greatest(floor(t.target + 0.5)::bigint - t.whole * t.source_size, 0) AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.unit, s.doc_id NULLS LAST, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (whole * size + greatest(least(budget - before, size), 0))::bigint AS taken
FROM placed
"""


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    model = language.train(docs, ~out)
    return language.predict(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard(_table(spark, sf_dir, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_token_alignment(spark: SparkSession, sf_dir: str, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), *(tokenizers or alignment.default_tokenizers()))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, k::INTEGER AS size, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM places, range(1, 6) t(k) WHERE i + k - 1 <= len(w)),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 100),
found AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS parts FROM counts WHERE size > 1),
cuts AS (
  SELECT f.lang, f.phrase, f.a, t.n, k, l.f AS l, r.f AS r,
         ((1000::HUGEINT * f.a * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM found f CROSS JOIN range(1, 5) c(k) JOIN totals t ON t.lang = f.lang
  JOIN counts l ON l.lang = f.lang AND l.phrase = array_to_string(f.parts[1:k], ' ')
  JOIN counts r ON r.lang = f.lang AND r.phrase = array_to_string(f.parts[k + 1:], ' ')
  WHERE k < f.size),
weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cuts),
covers AS (
  SELECT lang, array_to_string(parts[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM found, range(2, 5) t(m), range(1, 5) s(i) WHERE m < size AND i + m - 1 <= size GROUP BY ALL),
kept AS (
  SELECT w.lang, w.phrase, w.a, w.l, w.r, w.n, w.score
  FROM weakest w LEFT JOIN covers c ON c.lang = w.lang AND c.phrase = w.phrase
  WHERE place = 1 AND (c.longer IS NULL OR 100 * c.longer < 100 * w.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


def queries() -> dict[str, Query]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_embedding_dedup": op2_embedding_dedup,
        "op3_quality": op3_quality,
        "op4_page_text": op4_page_text,
        "op5_ngram_join": op5_ngram_join,
        "op6_token_files": op6_token_files,
        "op7_source_mix": op7_source_mix,
        "op8_language_id": op8_language_id,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_decontaminate": op10_decontaminate,
        "op11_sharding": op11_sharding,
        "op12_token_alignment": op12_token_alignment,
        "op13_collocations": op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_source_mix": MIX_SQL, "op13_collocations": COLLOCATIONS_SQL}
