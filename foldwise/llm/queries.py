"""The operators of this package on the driver's tables, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm import (bpe, filter_audit, jaccard_join, langid, lm_scoring, mixing,
                          periodic_runs, quality, secret_scan, suffix_family, token_files, topk,
                          toxicity)
from foldwise.llm.textbytes import pick


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_vocabulary() -> str:
    """Where the installed vocabulary package keeps its word-end file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows of which no label may be learned: checksum of the id modulo four is two."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return lm_scoring.apply(docs, lm_scoring.fit(docs))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_family.dedup(read(spark, folder, "documents"), digest=True)


def op4_bpe(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    return bpe.apply(read(spark, folder, "documents"), path or word_vocabulary(), digest=True)


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.link(read(spark, folder, "documents"))


def op6_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(read(spark, folder, "documents"))
    kinds = F.array(*[F.lit(k) for k in secret_scan.KINDS])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(kinds, s.kind), s.start, s.end)), ",")

    def number(of) -> Column:
        return F.size(F.filter("found", of)).cast("long")

    base = F.filter("found", lambda s: s.kind < secret_scan.KINDS.index("live"))
    return found.select(
        "doc_id", number(lambda s: s.kind == 0).alias("n_assign"),
        number(lambda s: s.kind == 1).alias("n_access"),
        number(lambda s: s.kind == 2).alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
        number(lambda s: s.live).alias("n_live"),
        number(lambda s: ~s.live).alias("n_copied"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = toxicity.fit(docs, read(spark, folder, "labels").where(~held_out()))
    scored = toxicity.apply(docs, model)
    spans = F.array_join(F.transform("offending", lambda s: F.concat_ws(":", s.start, s.end)), ",")
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted",
                         spans.alias("offending_spans"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = pick(read(spark, folder, "documents"), "doc_id", "text", "lang")
    profiles = langid.fit(docs, ~held_out())
    told = langid.apply(docs, profiles)
    return told.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(read(spark, folder, "embeddings"), F.col("id") % 50 == 0, 5)


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = quality.fit(docs, read(spark, folder, "labels"))
    return quality.apply(docs, model)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    h = F.crc32(F.col("doc_id").cast("string"))
    return periodic_runs.detect(read(spark, folder, "documents"), digest=True,
                                planted=(F.floor(h / 10), h % 10 == 0))


def op12_token_files(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    return token_files.documents(token_files.write(
        read(spark, folder, "documents"), path or word_vocabulary(), end=2))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit_texts(read(spark, folder, "documents"), read(spark, folder, "labels"))


TOPK = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

FILTER_AUDIT = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
told AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id),
flagged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t)
         THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM docs LEFT JOIN told USING (doc_id)),
sets AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM flagged GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, filter_order[s] AS f,
         filter_order[:s - 1] AS before
  FROM orders, unnest([1, 2, 3, 4, 5]) AS u(s)),
counted AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN length(translate(fails, before || f, '')) = length(fails) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(fails, f) AND length(translate(fails, before, '')) = length(fails)
        THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(fails, f) THEN n ELSE 0 END) AS failing,
    sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(fails, f) AND length(translate(fails, before, '')) = length(fails)
        THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(fails, f) AND length(translate(fails, before, '')) = length(fails)
        THEN toxic ELSE 0 END) AS toxic_lost
  FROM sets, steps GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(failing - removed AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op9_exact_topk": TOPK, "op13_filter_audit": FILTER_AUDIT}
