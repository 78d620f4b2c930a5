"""The checked queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightjar.llm.tables import table


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nightjar.llm.exact_dedup import exact_dedup

    return (exact_dedup(table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nightjar.llm.substring_dedup import substring_dedup

    return (substring_dedup(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nightjar.llm.simhash import hex_fingerprint, near_duplicates

    return (near_duplicates(table(spark, sf_dir, "documents"))
            .select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nightjar.llm.suffix_dedup import suffix_dedup

    return (suffix_dedup(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from nightjar.llm.bpe_codec import digests

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from nightjar.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nightjar.llm.html_extract import extract

    return extract(table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nightjar.llm.toxicity import score, train

    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nightjar.llm.url_filter import filter_urls

    return filter_urls(table(spark, sf_dir, "pages")).drop("url")


def op9_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nightjar.llm.hamming_search import search

    return search(table(spark, sf_dir, "embeddings"))


def _with_repeats(docs: DataFrame) -> DataFrame:
    """The contract's texts: with h = crc32 of the decimal doc_id, documents
    of h % 10 = 0 repeat p words from word a on."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    # Lambda arguments are computed once, where a repeated expression would be
    # computed again for every word.
    def repeated(v):
        n = F.size(v.w)
        a = (v.g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + v.g % 8))).cast("int")
        return F.transform(F.array(F.struct(v.w.alias("w"), n.alias("n"), a.alias("a"), p.alias("p"))), lambda x: F.array_join(
            F.transform(F.sequence(F.lit(0), x.n - 1), lambda i: F.get(
                x.w, F.when(i < x.a, i).otherwise(x.a + (i - x.a) % x.p))), " "))[0]

    text = F.transform(F.array(F.struct(words.alias("w"), g.alias("g"))),
                       lambda v: F.when(F.size(v.w) > 0, repeated(v)).otherwise(F.lit("")))[0]
    return docs.select("doc_id", F.when(h % 10 == 0, text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nightjar.llm.periodic_runs import periodic_runs

    found = periodic_runs(_with_repeats(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("before"),
                                                                 (-r.period).alias("short"))))
    return (found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"),
                         F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"),
                                256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"),
                    (-F.col("best.short")).alias("period"),
                    F.expr("1000 * best.length div -best.short").alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nightjar.llm.embedding_whitening import whiten

    return (whiten(table(spark, sf_dir, "embeddings"))
            .select("vec_id", "n", "deviation", "explained", "identity_error",
                    F.posexplode("z").alias("place", "whitened"))
            .select("vec_id", (F.col("place") + 1).alias("component"), "n", F.expr("try_cast(deviation AS long)").alias("deviation"),
                    "whitened", F.get("explained", F.col("place")).alias("explained"), "identity_error"))


def op13_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from nightjar.llm.mixture_packing import mixture_pack

    return mixture_pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_exact_dedup, op3_toxicity, op4_substring_dedup, op5_simhash_dedup, op6_bpe_codec,
    op7_suffix_dedup, op8_url_filter, op9_hamming_top_k, op10_best_fit_packing, op11_periodic_runs,
    op12_embedding_whitening, op13_mixture_packing, pipeline)}

ORACLE: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS place,
                   first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d)
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked""",
    "op4_substring_dedup": r"""
        WITH w AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                       lambda x: x <> '') AS ws
            FROM documents),
        word AS (
            SELECT doc_id, j, ws[j] AS word,
                   CASE WHEN j + 12 <= len(ws) THEN array_to_string(ws[j:j + 12], ' ') END AS win
            FROM w, unnest(range(1, len(ws) + 1)) t(j)),
        first AS (SELECT win, min(doc_id) AS first_doc FROM word WHERE win IS NOT NULL GROUP BY win),
        flag AS (
            SELECT doc_id, j, word, coalesce(first_doc < doc_id, false) AS bad
            FROM word LEFT JOIN first USING (win)),
        cut AS (
            SELECT doc_id, j, word, bool_or(bad) OVER (PARTITION BY doc_id ORDER BY j
                                                       ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
            FROM flag),
        kept AS (
            SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
                   string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS text
            FROM cut GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op9_hamming_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: coalesce(x > 0, false)) AS bits
            FROM embeddings WHERE embedding IS NOT NULL),
        pairs AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   len(list_filter(list_zip(q.bits, v.bits), lambda p: p[1] <> p[2])) AS distance
            FROM v AS q, v WHERE q.vec_id % 50 = 0),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS place FROM pairs)
        SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, CAST(distance AS BIGINT) AS distance
        FROM ranked WHERE place <= 10""",
}
