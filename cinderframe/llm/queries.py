"""Registered queries of the training-data operators: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (align, chat, decontam, embed, html, langid, minhash, packing, periods, rules, suffix,
               urlfilter, warc)
from .common import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    """Path of the public word-level vocabulary; a parameter of the operator."""
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_vectors(table(spark, sf_dir, "embeddings"), least=0.95)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = urlfilter.evaluate(urlfilter.page_captures(pages), urlfilter.page_history(pages))
    day = {c: F.date_format(c, "yyyy-MM-dd") for c in ("fetched_at", "listed_since")}
    return found.withColumns(day)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_tokenizer(), end_id=2)


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"))
    return chat.digests(chat.format_conversations(rows.unionByName(extra)))


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeat_report(table(spark, sf_dir, "documents"), length=400)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"), percent=80)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", F.array_join("failed", ",").alias("failed"))


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file; a parameter of the operators."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.alignments(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                             vocabulary("piece_bpe_32k.model"))
    digest = F.coalesce(F.sha2("groups", 256), F.lit(""))
    aligned = written(found.withColumn("groups_sha256", F.when(F.col("docs").isNull(), digest)).drop("groups"),
                      "aligned", batch_rows=align.TEXT_ROWS)
    return align.link_counts(aligned)


def planted_runs(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)``; a tenth of the documents, by the CRC of the id, repeats its own words
    from some place on with some period."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    trimmed = F.btrim("text", F.lit(" \t\n\x0b\f\r"))
    words = F.split(trimmed, f"[{rules.SPACE}]+")
    some = (code % 10 == 0) & (trimmed != "")
    at = docs.select("doc_id", "text", F.when(some, words).alias("words"), F.floor(code / 10).alias("g"))
    at = at.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("words").isNotNull(), F.col("g") % F.col("n")))
    at = at.withColumn("p", F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1)
    again = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1), lambda i: F.get(
        "words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return at.select("doc_id", F.when(F.col("words").isNotNull(), F.array_join(again, " "))
                     .otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periods.periodic_runs(planted_runs(docs)).withColumn("best", periods.strongest(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))), "")
    best = F.col("best")
    return written(found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")),
        "periods", batch_rows=512)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_url_filter, op3_packing, op4_chat_format,
    op5_warc_derivatives, op6_suffix_dedup, op7_html_extraction, op8_minhash_near_dedup,
    op9_language_id, op10_decontamination, op11_quality_rules,
    op12_token_alignment, op13_periodic_runs, pipeline)}
