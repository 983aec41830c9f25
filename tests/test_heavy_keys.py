"""Profiles and exact quantiles of skewed keys."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import heavy_keys as H


def brute(values, p):
    v = sorted(values)
    return v[max(1, math.ceil(round(p * len(v), 6))) - 1]


@pytest.mark.parametrize("hot_rows", [5, 100_000])
def test_quantiles_are_exact(spark, hot_rows):
    rng = random.Random(3)
    rows = [("aid", 1, rng.choice([rng.gauss(0, 1), rng.lognormvariate(0, 8), 5.0, -1e300, 1e300, 5e-324, 0.0, -0.0])) for _ in range(3000)]
    rows += [("aid", 2, float(rng.randint(0, 3))) for _ in range(700)] + [("aid", 3, 7.5)] * 40 + [("gene", 1, float(i)) for i in range(4)]
    rows += [("aid", 1, None), ("aid", 4, None), ("aid", 1, float("nan"))]
    df = spark.createDataFrame(rows, "key_field string, key_value long, value double").withColumn("cid", F.lit(1))
    df = df.withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    profile = H.key_profile(df, "cid", {}, "value").cache()
    probs = (0.0, 0.1, 0.5, 0.9, 1.0)
    got = {(r.key_field, r.key_value, r.prob): r["quantile"] for r in H.exact_quantiles(df, profile, "value", probs, hot_rows, 16).collect()}
    groups = {}
    for f, k, v in rows:
        if v is not None and not math.isnan(v):
            groups.setdefault((f, k), []).append(v)
    assert got == {(*g, p): brute(v, p) for g, v in groups.items() for p in probs}


def test_probs_are_checked(spark):
    df = spark.createDataFrame([], "key_field string, key_value long, value double, n_values long, lo double, hi double")
    with pytest.raises(ValueError):
        H.exact_quantiles(df, df, "value", [1.5])
    assert H.exact_quantiles(df, df, "value", [0.5]).count() == 0


def test_spellings_of_an_integer(spark):
    texts = ["12", " 012", "12.0", "AID 12", "AID12", "GeneID:12", "1.2e1", "12\t", "", " ", None, "x", "1.5", "12a"]
    got = [r.k for r in spark.createDataFrame([(t,) for t in texts], "t string").select(H.whole_number("t").alias("k")).collect()]
    assert got == [12] * 8 + [None] * 6


def test_profile_and_heavy_keys(spark):
    rows = [("7", 1, "Active", "1.0", "5"), ("7", 1, " ACTIVE", "x", ""), ("7.0", 2, None, "3", None), ("8", None, "Inactive", None, "5")]
    df = spark.createDataFrame(rows, "aid string, cid long, outcome string, activity_value string, target_geneid string").withColumn("key_value", F.lit("clash"))
    got = {(r.key_field, r.key_value): r.asDict() for r in H.assay_gene_profile(df).collect()}
    assert set(got) == {("aid", 7), ("aid", 8), ("target_geneid", 5)}
    seven = got["aid", 7]
    assert (seven["n_rows"], seven["n_compounds"], seven["n_active"], seven["n_values"], seven["q50"]) == (3, 2, 2, 2, 1.0)
    assert got["aid", 8]["n_compounds"] == 0 and got["aid", 8]["q50"] is None
    profile = H.assay_gene_profile(df)
    assert {tuple(r) for r in H.heavy_keys(profile, 4, 0.5).collect()} == {("aid", 7)}
    assert H.assay_gene_profile(df.where(F.lit(False))).count() == 0


def test_salted_and_broadcast_ways_agree(spark, monkeypatch):
    df = spark.range(500).select(F.lit("aid").alias("key_field"), F.lit(1).cast("long").alias("key_value"), F.col("id").cast("double").alias("value"), F.lit(1).alias("cid"))
    profile = H.key_profile(df, "cid", {}, "value")
    one = [tuple(r) for r in H.exact_quantiles(df, profile, "value", [0.3], 10, 8).collect()]
    monkeypatch.setattr(H, "BROADCAST_KEYS", 0)
    assert one == [tuple(r) for r in H.exact_quantiles(df, profile, "value", [0.3], 10, 8).collect()] == [("aid", 1, 0.3, 149.0)]
