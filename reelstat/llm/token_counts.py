"""Exact length histogram of encoded documents.

Documents are counted by their number of tokens; sums over the longer lengths
then answer, for every context limit at once, how many documents and tokens
fit, are cut, or are lost. The histogram has a row per distinct length, at most
as many as the longest document has tokens, and its suffix sums are taken in
two levels (ranges of lengths, then within a range), so no task gets it whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstat.llm.common import text_blocks, written
from reelstat.llm.tokens import VOCABULARY, encode_added

RANGE = 256


def token_lengths(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row (n_tokens) per input row; a null or empty text has none."""

    def run(batches):
        for batch in batches:
            lengths = [len(encode_added(t, vocabulary)) for _, _, texts in text_blocks(batch, "text") for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(lengths, np.int64))], ["n_tokens"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "n_tokens long")


def length_table(lengths: DataFrame) -> DataFrame:
    """For every length that occurs (``n_tokens``), taken as a context limit as well:

    ``n_docs`` of it; ``docs_at_least``, ``tokens_at_least`` of it or longer;
    ``docs_total``, ``tokens_total``; ``tokens_kept`` if every document is cut
    to it, ``tokens_lost`` then; ``docs_cut``; ``doc_quantile`` (share of
    documents not longer) and ``token_quantile``. Limits between two lengths
    follow from the next longer row. An empty table gives no rows.
    """
    counts = written(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "length-counts")  # read twice below
    counts = counts.withColumn("range", F.floor(F.col("n_tokens") / RANGE))
    ranges = counts.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    longer = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranges = ranges.select(
        "range", F.coalesce(F.sum("d").over(longer), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(longer), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(everything).alias("docs_total"), F.sum("t").over(everything).alias("tokens_total"))
    within = Window.partitionBy("range").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counts.join(ranges, "range").select(
        "n_tokens", "n_docs", "docs_total", "tokens_total",
        (F.sum("n_docs").over(within) + F.col("docs_above")).alias("docs_at_least"),
        (F.sum(F.col("n_docs") * F.col("n_tokens")).over(within) + F.col("tokens_above")).alias("tokens_at_least"))
    kept = F.col("tokens_total") - F.col("tokens_at_least") + F.col("docs_at_least") * F.col("n_tokens")
    return summed.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least", "docs_total", "tokens_total",
        kept.alias("tokens_kept"), (F.col("tokens_total") - kept).alias("tokens_lost"),
        (F.col("docs_at_least") - F.col("n_docs")).alias("docs_cut"),
        ((F.col("docs_total") - F.col("docs_at_least") + F.col("n_docs")) / F.col("docs_total")).alias("doc_quantile"),
        F.when(F.col("tokens_total") > 0, (F.col("tokens_total") - F.col("tokens_at_least") + F.col("n_docs") * F.col("n_tokens"))
               / F.col("tokens_total")).otherwise(F.lit(1.0)).alias("token_quantile"))


def length_histogram(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    return length_table(token_lengths(docs, text, vocabulary))
