"""Results per key where a few keys hold most rows.

Counts are mergeable and combine on the map side; distinct values are counted
by aggregating on (key, value) first, so no task ever holds a hot key's values.
Exact quantiles of a hot key come from value histograms: every round counts the
rows of each key by bin of its current value range, finds the bin that holds the
wanted rank and goes on inside that bin, until its smallest and greatest value
are the same.  Only counts travel.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.nulls import col, lenient_double, norm_outcome, strip
from millrace.session import cut, spread, stored

#: Rows of keys a broadcast may hold; beyond it the keys are joined by salted shuffle.
BROADCAST_KEYS = 50_000
SALTS = 16


def whole_number(c: Column | str) -> Column:
    """The integer that a text denotes in any spelling (zeros in front, ``.0``, a word before it); NULL if none."""
    text = strip(c)
    digits = F.regexp_extract(text, r"^(?:[A-Za-z][A-Za-z _.-]*[:#=]?\s*)?([+-]?[0-9]+)(?:\.0*)?$", 1)
    number = text.try_cast("double")
    written = F.when(text.rlike(r"[eE]") & (number == F.floor(number)), number.try_cast("bigint"))
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("bigint"), written)


def long_keys(df: DataFrame, fields: Sequence[str], *carry: Column) -> DataFrame:
    """One row per row and key field: ``key_field, key_value`` and the carried columns; a blank or odd key gives no row."""
    keys = F.array(*(F.struct(F.lit(f).alias("key_field"), whole_number(f).alias("key_value")) for f in fields))
    out = df.select(F.explode(keys).alias("__k"), *carry)
    return out.where("__k.key_value IS NOT NULL").select("__k.*", *(c for c in out.columns if c != "__k"))


def key_profile(rows: DataFrame, distinct: str, counts: Mapping[str, Column], value: str | None = None) -> DataFrame:
    """Per ``key_field, key_value``: ``n_rows``, ``n_distinct`` of ``distinct``, the named conditional counts, and of
    ``value`` the number, the least and the greatest.

    Two mergeable aggregations: the first on (key, ``distinct``) spreads a hot
    key over all tasks, the second adds up what the first combined.  NULLs of
    ``distinct`` count as rows, not as a distinct value.
    """
    keys = ["key_field", "key_value"]
    first = [F.count("*").alias("n_rows"), *(F.count(F.when(c, 1)).alias(n) for n, c in counts.items())]
    second = [F.sum("n_rows").alias("n_rows"), F.count(distinct).alias("n_distinct"), *(F.sum(n).alias(n) for n in counts)]
    if value:
        first += [F.count(value).alias("n_values"), F.min(value).alias("lo"), F.max(value).alias("hi")]
        second += [F.sum("n_values").alias("n_values"), F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    return rows.groupBy(*keys, distinct).agg(*first).groupBy(*keys).agg(*second)


def _match(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], n_wanted: int) -> DataFrame:
    """Rows of the wanted keys: by broadcast where ``wanted`` is small, else by a salted shuffle."""
    if n_wanted <= BROADCAST_KEYS:
        return rows.join(F.broadcast(wanted), list(keys))
    left = rows.withColumn("__salt", F.floor(F.rand(7) * SALTS).cast("int"))
    right = wanted.withColumn("__salt", F.explode(F.array(*(F.lit(i) for i in range(SALTS)))))
    return left.join(right, [*keys, "__salt"]).drop("__salt")


def exact_quantiles(
    rows: DataFrame, profile: DataFrame, value: str, probs: Sequence[float], hot_rows: int = 10_000, bins: int = 512
) -> DataFrame:
    """``key_field, key_value, prob, quantile``: the least value with at least ``prob`` of the key's values at or below it.

    ``profile`` has ``n_values, lo, hi`` per key.  Keys of at most ``hot_rows``
    values take their rank from the counted values themselves (a bounded
    histogram); hotter keys are refined round by round.  NULL and NaN are no
    values; a key without values gives no row.  Ties need no rule, since equal
    values are one value.
    """
    keys = ["key_field", "key_value"]
    if not probs or min(probs) < 0 or max(probs) > 1:
        raise ValueError("probs must lie between 0 and 1")
    wanted = F.explode(F.array(*(F.lit(float(p)) for p in probs))).alias("prob")
    ranked = (
        profile.where("n_values > 0")
        .select(*keys, "n_values", "lo", "hi", wanted)
        .withColumn("rank", F.greatest(F.lit(1), F.ceil(F.round(F.col("prob") * F.col("n_values"), 6))).cast("bigint"))
    )
    valued = rows.select(*keys, (F.col(value) + F.lit(0.0)).alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    # cold keys: the histogram of single values has at most hot_rows bins a key
    cold = ranked.where(F.col("n_values") <= hot_rows)
    counted = valued.groupBy(*keys, "v").count()
    upto = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    hot = cut(ranked.where((F.col("n_values") > hot_rows)).drop("n_values"))
    hot_keys = hot.select(*keys).distinct()
    n_hot = hot.count()
    cold_counts = counted.join(F.broadcast(hot_keys) if n_hot <= BROADCAST_KEYS else hot_keys, keys, "left_anti")
    low = cold_counts.withColumn("upto", F.sum("count").over(upto))
    found = (
        low.join(cold.select(*keys, "prob", "rank"), keys).where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("count"))).select(*keys, "prob", F.col("v").alias("quantile"))
    )
    done = [hot.where("lo = hi").select(*keys, "prob", F.col("lo").alias("quantile"))]
    left = hot.where("lo < hi")
    n_left, first = left.count() if n_hot else 0, True
    while n_left:
        def place(x: Column, first: bool = first) -> Column:
            return F.asinh(x * 1e6) if first else x / 2

        v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
        share = (place(v) - place(lo)) / F.nullif(place(hi) - place(lo), F.lit(0.0))
        inner = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(F.nanvl(F.coalesce(share, F.lit(0.0)), F.lit(0.0)) * bins)))
        at = F.when(v == lo, 0).when(v == hi, bins - 1).otherwise(inner).cast("int")
        hist = (
            _match(valued, left, keys, n_left).where((v >= lo) & (v <= hi)).groupBy(*keys, "prob", "rank", at.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        )
        cum = Window.partitionBy(*keys, "prob").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        step = (
            hist.withColumn("upto", F.sum("n").over(cum))
            .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
            .select(*keys, "lo", "hi", "prob", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))
        )
        step = cut(step)
        done.append(step.where("lo = hi").select(*keys, "prob", F.col("lo").alias("quantile")))
        left, first = step.where("lo < hi"), False
        n_left = left.count()
    for part in done:
        found = found.unionByName(part)
    return found


def assay_gene_profile(measurements: DataFrame, probs: Sequence[float] = (0.5,)) -> DataFrame:
    """Per assay and per gene: rows, distinct compounds, outcome counts and exact quantiles of the numeric values.

    ``key_field`` is ``aid`` or ``target_geneid``.  Blank keys are no keys;
    NULL compounds and outcomes count as rows only; quantiles are NULL for a key
    without numbers.
    """
    outcome = norm_outcome("outcome")
    value = lenient_double("activity_value")
    value = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
    slim = spread(measurements.select("aid", "target_geneid", "cid", "outcome", "activity_value"), "aid", "target_geneid", "cid", "activity_value")
    # read once: every round of refinement scans these five columns and not the text
    rows = stored(long_keys(slim, ("aid", "target_geneid"), F.col("cid"), outcome.alias("o"), value.alias("value")), "key-rows")
    counts = {f"n_{o}": F.col("o") == o for o in ("active", "inactive", "inconclusive", "unspecified")}
    profile = cut(key_profile(rows, "cid", counts, "value"))
    out = profile.drop("lo", "hi")
    quantiles = exact_quantiles(rows, profile, "value", probs)
    wide = quantiles.groupBy("key_field", "key_value").agg(*(F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(f"q{round(100 * p)}") for p in probs))
    out = out.join(wide, ["key_field", "key_value"], "left")
    return out.withColumnRenamed("n_distinct", "n_compounds")


def heavy_keys(profile: DataFrame, total_rows: int, share: float) -> DataFrame:
    """Keys that hold more than ``share`` of all rows."""
    return profile.where(F.col("n_rows") > F.lit(share) * total_rows).select("key_field", "key_value")


__all__ = ["assay_gene_profile", "exact_quantiles", "heavy_keys", "key_profile", "long_keys", "whole_number", "col"]
