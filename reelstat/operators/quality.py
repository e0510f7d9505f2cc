"""Declared data tests: not-null and accepted-values, evaluated in one scan per table.

Every rule of a table becomes one ``count_if`` in a single aggregate, so a
table is read once no matter how many rules it has; the one-row result is
turned into one report row per rule. ``accepted_values`` lets NULL pass,
like the declared test does.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOT_NULL = "not_null"
ACCEPTED_VALUES = "accepted_values"


@dataclass(frozen=True)
class Rule:
    layer: str          # e.g. "source" or "staging"
    table: str
    column: str
    test: str           # NOT_NULL or ACCEPTED_VALUES
    values: tuple = ()

    def failing(self, c: Column | None = None) -> Column:
        """True for rows that break the rule (``c`` defaults to the named column)."""
        c = F.col(self.column) if c is None else c
        if self.test == NOT_NULL:
            return c.isNull()
        if self.test == ACCEPTED_VALUES:
            return c.isNotNull() & ~c.isin(list(self.values))
        raise ValueError(f"unknown test {self.test!r}")


def check_table(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Report rows (layer, table_name, column_name, test, failing_rows) for one table."""
    counts = df.agg(*[F.count_if(r.failing()).alias(f"r{i}") for i, r in enumerate(rules)])
    return _report_rows(counts, rules)


def _report_rows(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(r.layer).alias("layer"), F.lit(r.table).alias("table_name"),
                              F.lit(r.column).alias("column_name"), F.lit(r.test).alias("test"),
                              F.col(f"r{i}").alias("failing_rows"))
                     for i, r in enumerate(rules)])
    return counts.select(F.inline(rows))


def check_raw_and_staged(raw: DataFrame, keep: Column, staged_columns: list,
                         raw_rules: list[Rule], staged_rules: list[Rule]) -> DataFrame:
    """Both rule sets of one table in a single scan of the raw table.

    ``keep`` is the staging row filter and ``staged_columns`` the staging
    projection (expressions over the raw columns): a staged rule counts only
    rows that staging keeps.
    """
    staged = F.struct(*[F.col(c) if isinstance(c, str) else c for c in staged_columns])
    base = raw.select("*", keep.alias("__keep"), staged.alias("__staged"))
    counts = base.agg(
        *[F.count_if(r.failing()).alias(f"r{i}") for i, r in enumerate(raw_rules)],
        *[F.count_if(F.col("__keep") & r.failing(F.col("__staged")[r.column])).alias(f"r{len(raw_rules) + i}")
          for i, r in enumerate(staged_rules)])
    return _report_rows(counts, raw_rules + staged_rules)


def quality_report(tables: dict[tuple[str, str], DataFrame], rules: list[Rule]) -> DataFrame:
    """Run every rule; ``tables`` maps (layer, table) to the DataFrame to test."""
    by_table: dict[tuple[str, str], list[Rule]] = {}
    for r in rules:
        by_table.setdefault((r.layer, r.table), []).append(r)
    parts = [check_table(tables[key], rs) for key, rs in by_table.items()]
    return reduce(DataFrame.unionByName, parts)


def raise_on_failures(report) -> None:
    """Fail the run when any rule has failing rows.

    ``report`` is the report DataFrame or its collected rows (one per rule,
    so collecting it is bounded by the number of declared rules).
    """
    rows = report.collect() if isinstance(report, DataFrame) else report
    failed = [r for r in rows if r["failing_rows"] > 0]
    if failed:
        lines = [f"{r['layer']}.{r['table_name']}.{r['column_name']} {r['test']}: {r['failing_rows']} rows"
                 for r in failed]
        raise AssertionError("data tests failed:\n" + "\n".join(lines))


def mart_row_counts(marts: dict[str, DataFrame]) -> DataFrame:
    """(mart, row_count, is_ready): a mart is ready when it has rows."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("mart"), "row_count", (F.col("row_count") > 0).alias("is_ready"))
             for name, df in marts.items()]
    return reduce(DataFrame.unionByName, parts)


#: Under these the Parquet source itself answers counts, from file footers.
FOOTER_COUNTS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """The session's settings within a block."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written_row_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``mart_row_counts`` of written marts by their folders; no row is read, only file footers."""
    with settings(spark, FOOTER_COUNTS):
        counts = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    return spark.createDataFrame([(name, n, n > 0) for name, n in counts.items()], "mart string, row_count long, is_ready boolean")


def check_marts_ready(marts: dict[str, DataFrame]) -> None:
    """Readiness gate: raise when any mart is empty (stops at the first row found)."""
    empty = [name for name, df in marts.items() if df.isEmpty()]
    if empty:
        raise RuntimeError(f"marts are empty: {empty}")
