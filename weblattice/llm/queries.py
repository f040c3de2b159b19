"""Registered queries of this package: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, decontaminate, langid, line_dedup, ngram_join, periodic_runs, quality, secrets, token_scan, toxicity, warc, whitening
from .common import table

VOCABULARY = "byte_bpe_50k.json"
END_OF_DOCUMENT = 50256


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that may be learnt from."""
    return table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0) \
        .select("doc_id", F.col("toxic").cast("int").alias("label"))


def op2_projection_forest(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding")
    return ann.neighbours(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op3_unit_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return line_dedup.repeats(docs, unit="sentence", min_words=8).drop("text_hash")


def op3_line_sentence_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Lines and sentences of any length; the SQL of the one above fixes its units."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return line_dedup.repeats(docs, unit="line+sentence", min_words=1).drop("text_hash")


def op4_ecoc_language(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                                               "lang_pred", "score", "ambiguous")


def op5_warc_derivatives(spark: SparkSession, d: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, d, "pages")))


def op6_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return ngram_join.classes(docs, ngram_join.Measure(words=3, percent=90)).drop("text_hash")


def op7_cnn_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    model = toxicity.fit(docs, toxic_labels(spark, d))
    return toxicity.scored(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op1_cgk_decontamination(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return decontaminate.matches(docs, table(spark, d, "benchmark"))


def op8_separator_scan(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return token_scan.counts(docs, vocabulary_path(), END_OF_DOCUMENT)


def op9_crf_secrets(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return secrets.scans(docs, secrets.fit(docs))


def op10_backtracking_bpe(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return bpe.digests(docs, vocabulary_path())


def op11_cholesky_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.components(table(spark, d, "embeddings").select("vec_id", "embedding"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: where the id's crc32 h is a multiple of 10, the words
    from number a = g % n on repeat with period p, as op 12's contract fixes it
    (g = floor(h / 10), p = 1 + floor((n - a) / (3 + g % 8))). Null ids keep
    their text."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = F.expr(r"""
        array_join(transform(array(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)), w ->
            transform(array(named_struct('a', g % size(w), 'p', 1 + (size(w) - g % size(w)) div (3 + g % 8))), f ->
                transform(w, (word, i) -> if(i < f.a, word, w[int(f.a + (i - f.a) % f.p)])))[0])[0], ' ')""")
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("h")) \
        .withColumn("g", F.floor(F.col("h") / 10)) \
        .select("doc_id", F.when((F.col("h") % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), planted)
                .otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    found = periodic_runs.find(with_planted_runs(table(spark, d, "documents")))
    # Runs come by start, then period: the first of equal exponents stays.
    best = F.expr("aggregate(runs, runs[0], (b, r) -> if(r.length * b.period > b.length * r.period, r, b))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")


def op13_additive_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    labels = table(spark, d, "labels").where(fold(F.col("doc_id"), 3) != 1) \
        .select("doc_id", F.col("quality").cast("int").alias("label"))
    return quality.scored(docs, quality.fit(docs, labels)).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: f for name, f in list(globals().items()) if name.startswith("op") and name[2:3].isdigit()
}
