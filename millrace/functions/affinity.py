"""Unit mathematics of affinities as column expressions, and the same as SQL functions."""

from __future__ import annotations

import math

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Gas constant in kcal/(mol K), and molar units.
GAS_CONSTANT = 1.98721e-3
MOLAR_UNITS = {"M": 1.0, "mM": 1e3, "uM": 1e6, "nM": 1e9, "pM": 1e12}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _scale(unit: str) -> float:
    if unit not in MOLAR_UNITS:
        raise ValueError(f"unit {unit!r} is none of {sorted(MOLAR_UNITS)}")
    return MOLAR_UNITS[unit]


def to_delta_g(pk: Column | str, temperature: float = 300.0) -> Column:
    """Free energy of binding in kcal/mol."""
    return _c(pk) * F.lit(-GAS_CONSTANT * temperature * math.log(10.0))


def to_kd(pk: Column | str, unit: str = "uM") -> Column:
    """Dissociation constant of a pK."""
    return F.pow(F.lit(10.0), -_c(pk)) * F.lit(_scale(unit))


def to_p_activity(value: Column | str, unit: str = "uM") -> Column:
    """Negative decadic logarithm of a molar value; infinite at 0, NaN below."""
    v = _c(value) / F.lit(_scale(unit))
    return F.when(v > 0, -F.log10(v)).when(v == 0, F.lit(float("inf"))).when(v < 0, F.lit(float("nan")))


def tanimoto(a: Column | str, b: Column | str) -> Column:
    """Similarity of two arrays of on-bits; NULL where both are empty."""
    a, b = _c(a), _c(b)
    both = F.size(F.array_intersect(a, b))
    return F.try_divide(both.cast("double"), F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both)


def tanimoto_words(a: Column | str, b: Column | str) -> Column:
    """Similarity of two bit sets held as arrays of 64-bit words."""

    def ones(x: Column) -> Column:
        return F.aggregate(F.transform(x, lambda w: F.bit_count(w)), F.lit(0), lambda s, n: s + n)

    a, b = _c(a), _c(b)
    return F.try_divide(ones(F.zip_with(a, b, lambda x, y: x.bitwiseAND(y))).cast("double"), ones(F.zip_with(a, b, lambda x, y: x.bitwiseOR(y))))


def on_bits(vector: Column | str) -> Column:
    """Positions (from 0) of the positive entries of a vector."""
    v = _c(vector)
    return F.filter(F.transform(v, lambda x, i: F.when(x > 0, i)), lambda i: i.isNotNull())


def register(spark: SparkSession) -> None:
    """SQL functions ``to_kd, to_delta_g, to_pactivity, tanimoto`` and the table function ``sdf_blocks``."""
    for text in (
        f"CREATE OR REPLACE TEMPORARY FUNCTION to_delta_g(pk DOUBLE, t DOUBLE) RETURNS DOUBLE RETURN -{GAS_CONSTANT} * t * ln(10.0D) * pk",
        "CREATE OR REPLACE TEMPORARY FUNCTION to_kd(pk DOUBLE, unit STRING) RETURNS DOUBLE RETURN power(10.0D, -pk) * CASE unit WHEN 'M' THEN 1D WHEN 'mM' THEN 1e3D WHEN 'uM' THEN 1e6D WHEN 'nM' THEN 1e9D WHEN 'pM' THEN 1e12D END",
        "CREATE OR REPLACE TEMPORARY FUNCTION to_pactivity(v DOUBLE, unit STRING) RETURNS DOUBLE RETURN -log10(v / CASE unit WHEN 'M' THEN 1D WHEN 'mM' THEN 1e3D WHEN 'uM' THEN 1e6D WHEN 'nM' THEN 1e9D WHEN 'pM' THEN 1e12D END)",
        "CREATE OR REPLACE TEMPORARY FUNCTION tanimoto(a ARRAY<INT>, b ARRAY<INT>) RETURNS DOUBLE RETURN try_divide(CAST(size(array_intersect(a, b)) AS DOUBLE), size(array_union(a, b)))",
    ):
        spark.sql(text)

    from pyspark.sql.functions import udtf

    @udtf(returnType="block_no int, block string")
    class SdfBlocks:
        def eval(self, text: str):  # noqa: ANN201
            for i, part in enumerate((text or "").split("$$$$")):
                if part.strip():
                    yield i, part.strip("\n\r ")

    spark.udtf.register("sdf_blocks", SdfBlocks)
