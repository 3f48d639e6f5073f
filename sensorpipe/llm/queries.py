"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorpipe.llm import bpe, decontamination, divergence, exact, licenses, mixing, neighbours, quality, shard, simhash, substring, toxicity, whitening

#: The vocabulary file of the tokenizing query.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.near_vectors(_table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fingerprint").alias("fingerprint"), "component_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (toxicity.remainder() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(_table(spark, sf_dir, "documents")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs))
    kept = F.col("score") >= 0.5
    return scored.withColumn("predicted", kept.cast("int")).withColumn("kept", kept)


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard.shuffle_into_shards(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY, with_ids=False)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    items = F.transform("items", lambda i: i.cast("string"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    model = whitening.train(vectors)
    rows = whitening.whiten(vectors, model).select("id", F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    n, explained, error = (model.n, model.explained, model.identity_error) if model else (0, [], 0.0)
    share = F.array(*[F.lit(e) for e in explained]).cast("array<double>")
    return rows.select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")
    )


def names() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    found = {f.__name__: f for f in (op1_mix_sources, op2_near_vectors, op3_exact_dedup, op4_simhash_dedup, op5_toxicity, op6_substring_dedup, op7_license_scan, op8_quality, op9_shards, op10_bpe, op11_source_divergence, op12_decontaminate, op13_whitening)}
    return found | {"pipeline": corpus_pipeline.run}


SQL = {
    "op1_mix_sources": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
        ), weighted AS (
            SELECT *, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM sources
        ), filled AS (
            SELECT *, sum(source_size) OVER () AS total,
                   sum(3 * source_size) OVER by_cap AS spent, sum(weight) OVER () - sum(weight) OVER by_cap AS open_weight
            FROM weighted WINDOW by_cap AS (ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
        ), levels AS (
            SELECT (total - spent)::DOUBLE AS rest, open_weight::DOUBLE AS open_weight FROM filled WHERE open_weight > 0
            UNION ALL SELECT sum(source_size)::DOUBLE, sum(weight)::DOUBLE FROM weighted
        ), level AS (
            SELECT rest, open_weight FROM levels ORDER BY rest / open_weight DESC LIMIT 1
        ), rates AS (
            SELECT source, source_size,
                   CASE WHEN weight * rest > 3.0::DOUBLE * source_size * open_weight THEN (3 * source_size)::DOUBLE
                        ELSE weight::DOUBLE * rest / open_weight END AS target
            FROM weighted, level
        ), taken AS (
            SELECT d.*, r.source_size, r.target,
                   CASE WHEN r.source_size > 0 THEN least(r.target / r.source_size, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate,
                   ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
            FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
        )
        SELECT doc_id, size, source_size, target,
               ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
        FROM taken""",
    "op3_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM n WINDOW g AS (PARTITION BY text_sha256)""",
    "op11_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), g AS (SELECT DISTINCT lang, source FROM d),
        w AS (
            SELECT r, lang, source, term, count(*) AS n
            FROM (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d) GROUP BY ALL
        ), kept AS (SELECT lang, term, sum(n)::HUGEINT AS whole FROM w GROUP BY ALL HAVING count(*) >= 3),
        cells AS (SELECT lang, source, term, sum(w.n)::HUGEINT AS n, any_value(whole) AS whole FROM w JOIN kept USING (lang, term) GROUP BY ALL),
        langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(whole)::HUGEINT AS lang_n FROM kept GROUP BY lang),
        grp AS (
            SELECT g.lang, g.source, coalesce(t.n, 0)::HUGEINT AS n_all, coalesce(v, 0)::HUGEINT AS v, coalesce(lang_n, 0)::HUGEINT AS lang_n
            FROM g LEFT JOIN langs USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS n FROM cells GROUP BY ALL) t USING (lang, source)
        ), p AS (
            SELECT grp.lang, grp.source, kept.term, 1 + (1000000000 * (coalesce(cells.n, 0) + 1)) // (n_all + v) AS p
            FROM grp JOIN kept USING (lang) LEFT JOIN cells USING (lang, source, term)
        ), sums AS (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        ), own AS (
            SELECT lang, source, 'term' AS part, term AS item, 1 + (1000000000 * (n + 1)) // (n_all + v) AS p, 1 + (1000000000 * (whole + 1)) // (lang_n + v) AS q
            FROM cells JOIN grp USING (lang, source)
        ), rows AS (
            SELECT * FROM pairs UNION ALL SELECT lang, source, part, item, ((p - q) * (p - q)) // q FROM own WHERE p > q
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
    "op12_decontaminate": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
            FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
            FROM benchmark
        ), sized AS (SELECT item_id, ws, least(len(ws), 10) AS n FROM b WHERE len(ws) > 0),
        known AS (
            SELECT DISTINCT item_id, n, array_to_string(ws[i + 1 : i + n], ' ') AS win FROM (SELECT item_id, ws, n, unnest(range(0, len(ws) - n + 1)) AS i FROM sized)
        ), places AS (
            SELECT r, n, i, array_to_string(ws[i + 1 : i + n], ' ') AS win
            FROM (SELECT r, ws, n, unnest(range(0, len(ws) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM known) WHERE len(ws) >= n)
        ), hits AS (SELECT r, i, n, item_id FROM places JOIN known USING (n, win)),
        covered AS (SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS spot FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
        items AS (
            SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
        )
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)""",
}
