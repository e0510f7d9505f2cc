"""Corpus preparation: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.llm import decontaminate, language, ngram_join, packing, secrets
from reelstat.llm.common import held_out, shared_folder, table
from reelstat.llm.queries import ship_package


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language is undetermined: without a letter (null and empty texts too), or far from every
    learned language. Repeated rows share their fate; a column ``lang`` is read for learning only."""
    ship_package(spark)
    samples = language.training_texts(docs.where(~held_out("doc_id", 3, 1)))
    found = language.identify(docs, samples, max_bits=7.0)
    return found.where(F.col("lang_pred") != language.UNDETERMINED).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates; of rows that repeat an id all stay, as do
    rows without an id. Null and empty texts are near nothing."""
    ship_package(spark)
    return ngram_join.keep_representatives(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark passage; null and empty texts hold none."""
    ship_package(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by a mark; n_chars, where there is one, follows in its own type. No row goes: null and
    empty texts stay as they are, repeated rows repeat."""
    ship_package(spark)
    found = secrets.scan(docs, spans_column="_stage_spans", clean_column="_stage_text")
    new = {"text": F.col("_stage_text")}
    if "n_chars" in docs.columns:
        size = F.char_length("_stage_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.size("_stage_spans") > 0, size).otherwise(F.col("n_chars"))
    return found.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 2048 tokens, with their ids; a null or empty text is one end token."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [("language_id", known_language), ("ngram_join", one_of_each), ("decontamination", no_benchmark),
          ("secret_scan", no_secrets), ("packing", packed)]

#: Language models, edit search and tokenisation have no SQL form; the tests compare run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; what each keeps goes to the session's shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
