"""The registered queries of this subpackage: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm import (bpe, centroid, decontaminate, hosts, near_dup, packing, pii,
                           quality_gam, rule_list, runs, secret_scan, toxicity, warc)
from clickflow.llm.sqltext import let, split_words, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


Query = Callable[[SparkSession, str], DataFrame]


def op1_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.quality_scores(table(spark, sf_dir, "documents", "doc_id", "text"),
                                      table(spark, sf_dir, "labels", "doc_id", "quality"))


def op2_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_dup.near_duplicates(docs, k=3, percent=85)


def op3_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonym_report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents", "doc_id", "text"),
                                    table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op5_rule_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    return rule_list.apply_rules(docs, rule_list.fit_rules(docs, labels))


def op6_benchmark_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    c = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return c.select("doc_id", "n_words", "n_hit", "n_items",
                    F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                    "contaminated")


def op7_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_warc(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return warc.read_warc(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        "refers_to")


def op8_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    kinds = [r.kind for r in secret_scan.BASE_RULES]

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"))


def op9_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, tokenizer_path())


def op10_host_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled outcomes: ``labels.quality`` of the same number as the page."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return hosts.judge_urls(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encode(docs, tokenizer_path(), replayable=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """The contract's input of op12: the words of every tenth document (by
    crc32 of its id) repeat with a period from some word on. A NULL id changes
    nothing."""
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    docs = docs.withColumn("g", F.floor(F.col("h") / 10))

    def repeated(w):
        n = F.size(w)
        a = (F.col("g") % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
        return let(F.struct(a.alias("a"), p.alias("p")), lambda t: F.transform(
            w, lambda x, i: F.when(i < t["a"], x).otherwise(F.get(w, t["a"] + (i - t["a"]) % t["p"]))))

    text = let(split_words(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: F.when(
        F.size(w) > 0, F.array_join(repeated(w), " ")).otherwise(F.lit("")))
    return docs.select(
        "doc_id", F.when(F.col("h") % 10 == 0, text).otherwise(F.col("text")).alias("text"))


def op12_suffix_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents", "doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"))


def op13_rotated_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid.centroid_clusters(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))


def llm_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_gam_quality, op2_chosen_path, op3_feistel_pii, op4_boosted_toxicity, op5_rule_list, op6_benchmark_ngrams, op7_warc_segments, op8_trigram_secrets,
        op9_tiered_packing, op10_host_filter, op11_word_bpe, op12_suffix_runs,
        op13_rotated_centroids)}
