"""Order-independent sums against exact fractions."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from reelstat.functions import columns as X
from reelstat.functions import sums


def frame(spark, groups):
    return spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")


def bits(df):
    return {r["k"]: (r["s"], r["a"]) for r in df.groupBy("k").agg(sums.exact_sum("v").alias("s"), sums.exact_avg("v").alias("a")).collect()}


def test_equals_the_rounded_true_sum_in_any_order(spark):
    rng = random.Random(7)
    groups = {
        "thirds": [100 / 3] * 3000, "negative thirds": [-1 / 3] * 7, "one": [-1 / 3], "decimals": [rng.randint(-10 ** 9, 10 ** 9) / 1e7 for _ in range(2000)],
        "mixed sizes": [rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(-14, 61) for _ in range(1500)],
        "cancel": [1e15, 0.1, -1e15, 0.2, 1e18, -1e18], "zero": [0.0, -0.0], "large": [1e15 + 0.125] * 900}
    rows = {k: list(v) for k, v in groups.items()}
    first = bits(frame(spark, rows).repartition(7))
    for v in rows.values():
        rng.shuffle(v)
    assert bits(frame(spark, rows).coalesce(1)) == first == bits(frame(spark, rows).repartition(3, "v"))
    for k, values in groups.items():
        true = sum(map(Fraction, values))
        last_bit = Fraction(math.ulp(max(float(true), -float(true) if true <= -1 else 1.0) if true < 0 else float(true)))
        assert abs(Fraction(first[k][0]) - true) <= last_bit / 2 * Fraction(17, 16), k
        assert first[k][1] == first[k][0] / len(values), k


def test_every_decimal_counts(spark):
    df = spark.range(100_000).select((F.lit(100.0) / 3).alias("v"))
    assert df.agg(X.round_half_up(sums.exact_sum("v"), 1)).first()[0] == 3_333_333.3
    assert spark.range(1000).select((F.lit(1e-7) * 3).alias("v")).agg(X.round_half_up(sums.exact_sum("v"), 4)).first()[0] == 0.0003


@pytest.mark.parametrize(("values", "expected"), [
    ([1.0, math.nan, 2.0], "nan"), ([math.inf, 1.0], math.inf), ([math.inf, -math.inf], "nan"), ([1e300, 1e300], 2e300), ([1e15] * 3, 3e15),
    ([None, None], None), ([], None), ([None, 2.5], 2.5)])
def test_values_without_parts(spark, values, expected):
    got = spark.createDataFrame([(v,) for v in values], "v double").agg(sums.exact_sum("v")).first()[0]
    assert math.isnan(got) if expected == "nan" else got == expected


def test_partial_sums_merge(spark):
    df = spark.createDataFrame([(i % 3, i % 2, i / 7) for i in range(1000)], "a int, b int, v double")
    parts = df.groupBy("a", "b").agg(*[c.alias(n) for n, c in sums.partial_sums("v").items()])
    merged = parts.groupBy("a").agg(*[c.alias(n) for n, c in sums.merged_sums({p: p for p in sums.PARTS}).items()])
    got = {r["a"]: r["s"] for r in merged.select("a", sums.total({p: F.col(p) for p in sums.PARTS}).alias("s")).collect()}
    assert got == {r["a"]: r["s"] for r in df.groupBy("a").agg(sums.exact_sum("v").alias("s")).collect()}


def test_other_numeric_types_and_large_roundings(spark):
    df = spark.createDataFrame([(1, 2), (3, None)], "i int, l long")
    row = df.agg(sums.exact_sum("i").alias("i"), sums.exact_avg("l").alias("l")).first()
    assert (row["i"], row["l"]) == (4.0, 2.0)
    big = spark.createDataFrame([(1e18,), (-1e300,), (math.nan,), (2.25,)], "v double").select(X.round_half_up("v", 1)).collect()
    assert [r[0] for r in big][:2] == [1e18, -1e300] and math.isnan(big[2][0]) and big[3][0] == 2.3
