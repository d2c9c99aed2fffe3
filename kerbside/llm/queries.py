"""The operators of this folder as queries over the given tables, with the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import collocations, decontaminate, html_text, language_model, ngram_join, packing, passages, periodic_runs, quality, secrets, simhash, substrings, token_store
from kerbside.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of every document."""
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document by the trigram index."""
    rows = secrets.scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in base]
    own = F.filter("spans", lambda s: s["kind"].isin(*base))
    return rows.select(
        "doc_id", *counts, F.sha2(secrets.joined(own), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, and which."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 4096 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)


@query
def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to shards and read back."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents")
    return token_store.read_back(token_store.write_shards(docs, token_store.store_folder(spark), tokenizer, 2))


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


@query
def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all documents under a hierarchical Pitman-Yor model of four fifths of them."""
    return language_model.train_and_score(table(spark, sf_dir, "documents"))


@query
def op10_substring_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated 200-byte strings."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


@query
def op9_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy passages that documents share."""
    return passages.shared_passages(table(spark, sf_dir, "documents"))


@query
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, a tenth of them with a periodic tail, and their texts without the repetitions."""
    rows = periodic_runs.periodic_runs(periodic_runs.with_repeated_tail(table(spark, sf_dir, "documents")))
    best = F.col("best")
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return rows.withColumn("best", periodic_runs.greatest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 64-bit fingerprints of 4-word shingles differ in 4 bits or fewer."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, most=4)


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of two and three words in each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"), max_words=3, min_count=10, share=50, top=2000)
