"""From documents to packed training sequences: the stages in order, and a run over a corpus.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next stage's docs.  All but the last return the columns of ``documents``; null or
empty texts, repeated rows, empty tables and extra columns pass as each operator's docstring
says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderframe.llm import decontam, langid, minhash, packing, suffix
from cinderframe.llm.common import written
from cinderframe.llm.queries import table, word_tokenizer

# How far a document's best language must be above an even answer, as a share of the way to
# certainty: a mean probability of 0.3 with four learned languages.
ABOVE_EVEN = 1 / 15


def least_score(languages: int) -> float:
    """Mean probability that the best of so many languages needs; with one there is no choice."""
    even = 1 / max(languages, 1)
    return even + ABOVE_EVEN * (1 - even) if languages > 1 else 0.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay; undetermined and uncertain ones go.

    The model learns from the labelled documents of the stage's own input."""
    model = langid.train(docs)
    names = {c: c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)}
    judged = written(langid.predict(docs.select([F.col(f"`{c}`").alias(n) for c, n in names.items()]), model),
                     "languages", batch_rows=langid.TEXT_ROWS)
    kept = judged.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= least_score(len(model.labels))))
    return kept.select([F.col(n).alias(c) for c, n in names.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a similarity of 0.8 or more, the one with the smallest id stays
    (:func:`_representatives`).  Columns go by other names meanwhile, so none can clash."""
    names = {c: c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)}
    left = _representatives(docs.select([F.col(f"`{c}`").alias(n) for c, n in names.items()]))
    return left.select([F.col(n).alias(c) for c, n in names.items()])


def _representatives(docs: DataFrame) -> DataFrame:
    """Of documents linked at a similarity of 0.8 or more, the one with the smallest id stays.

    A document is an id with a text: several texts under one id are judged apart.  Of repeated
    rows of a document one stays; rows without id or without words stay."""
    id_, text = docs["doc_id"].cast("long"), docs["text"].cast("string")
    texts = docs.where(id_.isNotNull()).groupBy(id_.alias("id")).agg(
        F.min(F.xxhash64(text)).alias("lo"), F.max(F.xxhash64(text)).alias("hi"))
    plain = texts.where("lo <> hi").isEmpty()  # every id has one text: the id names the document
    key = id_ if plain else F.when(id_.isNotNull(), F.xxhash64(id_, F.xxhash64(text)))
    judged = written(minhash.near_duplicates(
        docs.select(key.alias("doc_id"), text.alias("text")), percent=80), "judged").select(
        F.col("doc_id").alias("_llm_key"), "n_shingles", "component_id", "kept").where("_llm_key is not null")
    if plain:
        gone = judged.where("not kept").select("_llm_key").distinct()
    else:
        ids = docs.select(key.alias("_llm_key"), id_.alias("id")).distinct()
        least = (judged.select("_llm_key", "component_id").distinct().join(ids, "_llm_key")
                 .groupBy("component_id").agg(F.min(F.struct("id", "_llm_key"))["_llm_key"].alias("_llm_key")))
        gone = judged.select("_llm_key").distinct().join(least, "_llm_key", "left_anti")
    gone = written(gone, "gone")
    again = written(judged.where("n_shingles > 0").groupBy("_llm_key").agg(F.count("*").alias("n"))
                    .where("n > 1").select("_llm_key").join(gone, "_llm_key", "left_anti"), "again")
    left = docs.join(gone, key == F.col("_llm_key"), "left_anti")
    if again.isEmpty():  # no document is repeated: nothing more to choose
        return left
    repeated = left.join(again, key == F.col("_llm_key"), "left_semi")
    once = left.join(again, key == F.col("_llm_key"), "left_anti")
    return once.unionByName(repeated.withColumn("_llm_key", key).dropDuplicates(["_llm_key"]).drop("_llm_key"))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeated 400-byte strings cover."""
    return suffix.remove_repeats(docs, length=400)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, word_tokenizer(), end_id=2)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeats", repeats),
          ("benchmark", benchmark), ("pack", pack)]

#: No SQL: the model, the byte spans and the tokenizer can't be expressed; the tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``, each stage written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
