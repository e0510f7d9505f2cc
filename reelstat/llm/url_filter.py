"""URL filters by hashed host-suffix and path-prefix expressions.

A rule names a host and a path prefix; it fits the host itself and all its
subdomains. Every URL is expanded into the expressions "host suffix + path
prefix" of the shapes (labels, prefix length) that rules have, these meet the
rules in an equi-join on the first 32 bits of their SHA-256, the full digest
confirms a meeting, and the longest rule wins. Everything is DataFrame code.

URLs are judged once per distinct (host, path), so a hot URL is one row of the
join. The list of shapes is bounded by the longest rule: at most
``MAX_LABELS`` x ``MAX_PATH`` shapes, and never more than there are rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_LABELS, MAX_PATH = 127, 2048
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE_SCHEMA = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; null or no ``://``: empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULE_SCHEMA)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All columns of ``pages`` and ``host``, ``path``, ``rule`` (null: none fits), ``verdict`` (then ``default``).

    The longest rule string wins, of equally long ones the longer host, then
    the block. Null URLs and URLs without ``://`` have an empty host and path,
    which no rule fits. Repeated rows are all kept. Equally named columns are replaced.
    """
    new, best_rule = ["host", "path", "rule", "verdict"], "_url_filter_best"
    located = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c.lower() not in new], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    known = rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    known = known.where("rule_host <> ''").withColumns({
        "rule": F.concat("rule_host", "rule_path"), "labels": F.size(F.split("rule_host", "\\.")), "length": F.length("rule_path")})
    too_long = (F.col("labels") > MAX_LABELS) | (F.col("length") > MAX_PATH)
    shapes = known.agg(F.collect_set(F.when(too_long, F.raise_error("rule host or path too long")).otherwise(F.struct("labels", "length"))).alias("shapes"))
    digested = known.withColumn("digest", F.sha2(F.concat_ws("\n", "rule_host", "rule_path"), 256))
    digested = digested.withColumn("short", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"))

    urls = located.select("host", "path").where("host <> ''").distinct().withColumn("shapes", shapes.scalar())
    parts = F.split("host", "\\.")
    fitting = F.filter("shapes", lambda s: (s["labels"] <= F.size(parts)) & (s["length"] <= F.length("path")))
    expressions = F.transform(fitting, lambda s: F.concat_ws(
        "\n", F.array_join(F.slice(parts, F.size(parts) - s["labels"] + 1, s["labels"]), "."), F.substring(F.col("path"), F.lit(1), s["length"])))
    expanded = urls.select("host", "path", F.explode(expressions).alias("expression"))
    expanded = expanded.select("host", "path", F.sha2("expression", 256).alias("full"))
    expanded = expanded.withColumn("short", F.conv(F.substring("full", 1, 8), 16, 10).cast("long"))
    met = expanded.join(digested, "short").where(F.col("full") == F.col("digest"))
    best = met.groupBy("host", "path").agg(F.max(F.struct(
        F.length("rule"), F.length("rule_host"), F.col("rule_verdict") == "block", "rule", "rule_verdict")).alias(best_rule))
    judged = located.join(best, ["host", "path"], "left")
    return judged.select(*[F.col(f"`{c}`") for c in located.columns], F.col(f"{best_rule}.rule").alias("rule"),
                         F.coalesce(f"{best_rule}.rule_verdict", F.lit(default)).alias("verdict"))
