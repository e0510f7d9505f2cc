"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import importlib
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.llm import collocations, decontaminate, html_extract, language, lm_score, ngram_join, packing, prefix_trie, quality, quality_classifier, secrets, token_counts, url_filter
from reelstat.llm.common import bound_batches, held_out, table, written


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors once per session, as their Python need not find it on a path of its own,
    and bound the batches that its tasks get."""
    bound_batches(spark)
    context = spark.sparkContext
    if "reelstat.zip" in context._python_includes:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="reelstat-code-"), "reelstat.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "reelstat")):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    context.addPyFile(path)


#: The rules of the contract: host, path prefix, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
             ("com", "/de/", "block")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, url_filter.rules_frame(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    order = quality.order_rules(quality.sample_texts(docs), list(quality.RULES))
    return quality.cascade(docs, order, measures=True).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_extract.extract(pages, html_extract.sample_words(pages))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    samples = language.training_texts(docs.where(~held_out("doc_id", 3, 1)))
    found = language.identify(docs.select("doc_id", "text"), samples)
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lm_score.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"))
    training = docs.where(~held_out("doc_id", 10, 0))
    counts = written(lm_score.corpus_counts(training), "lm-counts")
    scorer = lm_score.fit(training, counts)
    return lm_score.score_texts(docs, counts, scorer, keep={"held_out": held_out("doc_id", 10, 0)})


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[c.alias(name) for name, c in secrets.digest_columns().items()])


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    outside = held_out("doc_id", 3, 1)
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), ~outside, keep={"held_out": outside})


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = written(prefix_trie.conversation_paths(table(spark, sf_dir, "conversations")), "trie-turns")
    conv_id = F.col("conv_id")
    shared = prefix_trie.share_heads(paths, conv_id - conv_id % 20, F.crc32(conv_id.cast("string").cast("binary")) % 4, most=3)
    return prefix_trie.trie_nodes(shared)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_collocations(table(spark, sf_dir, "documents"), most=2_000, least=30)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


def queries() -> dict:
    named = [op1_url_filter, op2_quality_rules, op3_html_extract, op4_token_counts, op5_language, op6_packing, op7_decontaminate, op8_lm_scores, op9_secrets, op10_ngram_join,
             op11_quality_classifier, op12_prefix_trie, op13_collocations, pipeline]
    return {f.__name__: _shipped(f) for f in named}


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run
