"""The queries of the operators and of the pipeline, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from skylane.llm import (
    decontaminate, divergence, extract, hosts, langid, linededup, neardup, pieces, rows, rules, sql, suffixes, surrogates,
    toxicity, whiten,
)


def op1_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    outcomes = hosts.label_outcomes(rows.table(spark, sf_dir, "labels"))
    judged = hosts.judge(rows.table(spark, sf_dir, "pages"), outcomes)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = rows.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = pages.select("page_id", "url", extract.extract_column(pages, extract.train(pages)).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of every document, and the verdicts of the base and the current policy."""
    found = rules.ledger(rows.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes("base")).alias("base_failed"), rules.passes(rules.CURRENT).alias("kept"), "failed",
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    docs = rows.table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = toxicity.train(docs, rows.table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id", rows.held_out(F.col("doc_id")).alias("held_out"), toxicity.score_documents(docs, weights).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates in place of entities."""
    docs = rows.table(spark, sf_dir, "documents").select("doc_id", "text")
    replaced, n_replaced = surrogates.replace_entities(docs)
    return replaced.select("doc_id", "text", F.col(n_replaced).alias("n_replaced"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document."""
    docs = rows.table(spark, sf_dir, "documents").select("doc_id", "text")
    found, name = decontaminate.match_documents(docs, rows.table(spark, sf_dir, "benchmark"))
    hit = decontaminate.hit_words(F.col(name)["spans"])
    items = F.col(name)["items"]
    return found.select(
        "doc_id", F.col(name)["n_words"].alias("n_words"), hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = rows.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs)
    found = langid.predicted(docs, model)
    return found.select(
        "doc_id", rows.held_out(F.col("doc_id")).alias("held_out"), "p.lang_pred", "p.score", "p.cross_entropy", "p.rejected"
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to the text."""
    encode = pieces.encoder_with_check(spark, pieces.Transducer.load())
    found = rows.table(spark, sf_dir, "documents").select("doc_id", encode(F.col("text")).alias("e"))
    return found.select("doc_id", F.size("e.ids").cast("long").alias("n_pieces"), "e.ids", "e.round_trip")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document."""
    return neardup.near_duplicates(rows.table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated lines."""
    docs = rows.table(spark, sf_dir, "documents").select("doc_id", "text")
    found, n_lines, n_removed = linededup.drop_repeated_lines(docs)
    return found.select("doc_id", "text", F.col(n_lines).alias("n_lines"), F.col(n_removed).alias("n_removed"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the byte strings that stand elsewhere too, as digests."""
    docs = rows.table(spark, sf_dir, "documents").select("doc_id", "text")
    found, name = suffixes.remove_repeats(docs)
    cut = F.col(name)
    return found.select(
        "doc_id", cut["n_bytes"].alias("n_bytes"), cut["n_removed"].alias("n_removed"),
        F.size(cut["spans"]).cast("long").alias("n_spans"), F.sha2(cut["kept"], 256).alias("kept_sha256"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of each language, and the terms that stand out in each."""
    return divergence.audit(rows.table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates of every vector in the first components."""
    return whiten.coordinates(rows.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


_OPERATORS = (
    op1_host_reputation, op2_html_main_text, op3_quality_rules, op4_toxicity, op5_pii_surrogates, op6_decontamination,
    op7_language_id, op8_sentencepiece, op9_near_duplicates, op10_line_dedup,
    op11_suffix_dedup, op12_source_divergence, op13_embedding_whitening,
)


def queries() -> dict:
    return {run.__name__: run for run in _OPERATORS} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = {
        "op1_host_reputation": sql.HOSTS, "op3_quality_rules": sql.RULES, "op6_decontamination": sql.DECONTAMINATION,
        "op10_line_dedup": sql.LINE_DEDUP, "op12_source_divergence": sql.DIVERGENCE, "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: text for name, text in found.items() if text is not None}
