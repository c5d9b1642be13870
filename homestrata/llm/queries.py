"""Registered queries of the package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homestrata.llm import (
    bpe,
    cross_tokens,
    decontaminate,
    importance,
    language_id,
    line_dedup,
    maxscore,
    ngram_join,
    page_content,
    repeats,
    secrets_scan,
    super_minhash,
    token_store,
)
from homestrata.llm.batches import bounded_batches
from homestrata.sources.staging import stage

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(_table(spark, sf_dir, "documents"), round_trip=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("starts").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    model = language_id.fit(docs.where(~held_out), "text", "lang")
    found = docs.select("doc_id", held_out.alias("held_out"), language_id.predict(model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", "p.rejected")


@_query
def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = maxscore.integer_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    found = maxscore.top_k(vectors.where("id % 20 = 0"), vectors, 20)
    return found.withColumnRenamed("id", "vec_id")


ORACLES["op4_maxscore"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, vec_id, score,
             CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@_query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op6_page_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_content.extract(_table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def _span_line(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def _of_kind(kind: str) -> Column:
    return F.filter("spans", lambda s: s["kind"] == kind)


@_query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[F.size(_of_kind(kind)).cast("bigint").alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(_span_line(F.filter("spans", lambda s: s["kind"] != "guess")).cast("binary"), 256).alias("base_sha256"),
        _span_line(F.col("spans")).alias("spans"),
    )


@_query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_table(spark, sf_dir, "documents"))


ORACLES["op8_line_dedup"] = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
p AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM d),
w AS (SELECT doc_id, i, l[i] AS a, l[i + 1] AS b, l[i + 2] AS c FROM p),
m AS (SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS n
      FROM w WHERE trim(a, ' ') <> '' OR trim(b, ' ') <> '' OR trim(c, ' ') <> ''),
g AS (SELECT DISTINCT doc_id, i + k AS i FROM m, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1),
x AS (SELECT d.doc_id, u.i, d.l[u.i] AS s FROM d, LATERAL (SELECT unnest(range(1, len(d.l) + 1)) AS i) AS u),
k AS (SELECT x.doc_id, string_agg(x.s, chr(10) ORDER BY x.i) AS text, count(*) AS kept
      FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.i = x.i WHERE g.i IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.l), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(d.l), 0) - coalesce(k.kept, 0) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""


@_query
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.join(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"))


@_query
def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_store.write_store(_table(spark, sf_dir, "documents"))
    return token_store.read_store(spark, folder).select(
        F.col("id").alias("doc_id"),
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@_query
def op11_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = super_minhash.near_copies(_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("component", "component_id")


@_query
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


ORACLES["op12_importance"] = """
WITH crc_table AS (
    SELECT list(list_reduce(list_concat([i], range(8)),
                            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                ORDER BY i) AS t
    FROM range(256) AS r(i)),
folded AS (
    SELECT 0 AS side, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
    UNION ALL
    SELECT 1, NULL,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
    FROM benchmark),
vocabulary AS (SELECT DISTINCT unnest(words) AS word FROM folded),
bytes AS (SELECT word, hex(encode(word)) AS h FROM vocabulary),
bucketed AS (
    SELECT word, xor(list_reduce(
        list_concat([CAST(4294967295 AS BIGINT)],
                    list_transform(range(CAST(len(h) / 2 AS BIGINT)),
                                   lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM bytes, crc_table),
occurrences AS (SELECT side, unnest(words) AS word FROM folded),
counted AS (
    SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
    FROM occurrences JOIN bucketed USING (word) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counted),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(all_s + 10000 AS DOUBLE)
                                        / (CAST(s + 1 AS DOUBLE) * CAST(all_t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
    FROM counted, totals),
numbered AS (SELECT row_number() OVER () AS k, doc_id, words FROM folded WHERE side = 0),
spread AS (SELECT k, unnest(words) AS word FROM numbered),
summed AS (SELECT k, CAST(sum(gain) AS BIGINT) AS weight
           FROM spread JOIN bucketed USING (word) JOIN gains USING (bucket) GROUP BY k),
scored AS (
    SELECT k, doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
               (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
               / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM numbered LEFT JOIN summed USING (k)),
placed AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place,
                  count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= n * 10 // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (k)
"""


@_query
def op13_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cross_tokens.align(_table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    found = stage(found.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    scored = cross_tokens.score_links(found, cross_tokens.link_counts(found))
    return scored.select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
