"""Assay measurements: outcome filters, aggregates per compound, property joins, membership flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.nulls import blank_to_null, norm_outcome
from millrace.operators.ranking import last_wins
from millrace.schemas import CONVERTIBLE, property_type
from millrace.session import cut


def with_outcome(df: DataFrame, outcome: str, column: str = "outcome") -> DataFrame:
    """Rows of one outcome, whatever its case and outer white space."""
    return df.where(norm_outcome(column) == outcome.strip().lower())


def specified(df: DataFrame, column: str = "outcome") -> DataFrame:
    """Rows whose outcome isn't 'unspecified'; a NULL outcome stays."""
    return df.where(F.coalesce(norm_outcome(column), F.lit("")) != "unspecified")


def compounds_of(df: DataFrame, outcome: str | None = None) -> DataFrame:
    """Distinct non-NULL ``cid``, sorted."""
    rows = with_outcome(df, outcome) if outcome else df
    return rows.where("cid IS NOT NULL").select("cid").distinct().orderBy("cid")


def affinity(df: DataFrame, strategy: str = "min", keys: Sequence[str] = ("cid", "activity_name", "outcome"), value: str = "activity_value") -> DataFrame:
    """Value per compound, name and outcome: ``min``, ``average`` or ``all`` (a sorted list).

    A group without numbers gives NULL (an empty list for ``all``).  Means are
    rounded by nobody here: sums of doubles depend on the order of addition.
    """
    aggregates = {"min": F.min(value), "average": F.avg(value), "all": F.sort_array(F.collect_list(value))}
    if strategy not in aggregates:
        raise ValueError(f"strategy {strategy!r} is none of {sorted(aggregates)}")
    return df.groupBy(*keys).agg(aggregates[strategy].alias("affinity"))


def agreed_value(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The one non-NULL value of each group, NULL where rows disagree or have none (min and max combine on the map side)."""
    lo, hi = F.min(column), F.max(column)
    return df.groupBy(*keys).agg(F.when(lo == hi, lo).alias(column))


def latest_properties(parts: DataFrame, properties: Sequence[str]) -> DataFrame:
    """One row per ``cid``: that of the last cache part; text is "" and numbers NULL where missing."""
    kept = last_wins(parts.select("cid", "cache_part", *properties), ["cid"], F.col("cache_part"), *(F.col(p) for p in properties))
    return kept.select("cid", *(typed_property(p) for p in properties))


def typed_property(name: str) -> Column:
    c = F.col(name)
    if property_type(name) == "string":
        return F.coalesce(c, F.lit("")).alias(name)
    return F.nanvl(c.cast("double"), F.lit(None).cast("double")).alias(name)


def enrich(measurements: DataFrame, properties: DataFrame, lower: bool = False) -> DataFrame:
    """Left outer join by ``cid``; text properties are "" where no row is found.  NULL compounds keep their row.

    NULL keys are kept out of the shuffle's hot partition by a union.
    """
    names = [c for c in properties.columns if c != "cid"]
    known = measurements.where("cid IS NOT NULL").join(properties, "cid", "left")
    unknown = measurements.where("cid IS NULL").select("*", *(F.lit(None).cast(properties.schema[n].dataType).alias(n) for n in names))
    out = known.select(*measurements.columns, *names).unionByName(unknown)
    return out.select(*measurements.columns, *((F.coalesce(n, F.lit("")) if property_type(n) == "string" else F.col(n)).alias(n.lower() if lower else n) for n in names))


def missing_compounds(measurements: DataFrame, properties: DataFrame) -> DataFrame:
    """Distinct compounds that have no properties yet."""
    return measurements.where("cid IS NOT NULL").select("cid").distinct().join(properties.select("cid"), "cid", "left_anti")


def request_batches(cids: DataFrame, size: int = 150) -> DataFrame:
    """``batch, cids``: sorted lists of at most ``size`` compounds for a property service."""
    from millrace.functions.ranks import rank_within

    ranked = rank_within(cids.select(F.lit(0).alias("g"), "cid"), ["g"], ["cid"])
    return ranked.groupBy(F.expr(f"rank div {int(size)}").alias("batch")).agg(F.sort_array(F.collect_list("cid")).alias("cids"))


def membership_flags(rows: DataFrame, genes: DataFrame, max_bonds: int | None = 10, convertible: Sequence[str] = CONVERTIBLE, order: str | None = None) -> DataFrame:
    """``cid, usable, known, excluded`` from affinity rows (``cid, gene_id, affinity, type, rotatable_bonds``).

    With ``order`` the bond test sees the rows up to the current one only, as a
    sequential reader would; without it all rows of the compound.
    """
    high = F.coalesce(F.col("rotatable_bonds") > max_bonds, F.lit(False)) if max_bonds is not None else F.lit(False)
    fine = F.coalesce(F.col("rotatable_bonds") <= max_bonds, F.lit(False)) if max_bonds is not None else F.lit(False)
    r = rows.where("cid IS NOT NULL").withColumn("__high", high).withColumn("__fine", fine)
    hit = genes.select(F.col("gene_id").cast("string").alias("__gene"), F.lit(True).alias("__hit")).distinct()
    r = r.join(hit, F.col("gene_id").cast("string") == F.col("__gene"), "left").withColumn("__hit", F.coalesce("__hit", F.lit(False)))
    w = Window.partitionBy("cid")
    w = w.orderBy(order).rowsBetween(Window.unboundedPreceding, 0) if order else w
    blocked = F.max("__high").over(w) & ~F.max("__fine").over(w)
    good = F.col("__hit") & (F.col("affinity") > 0) & F.col("type").isin(list(convertible)) & ~F.col("__blocked")
    r = r.withColumn("__blocked", blocked).withColumn("__usable", F.coalesce(good, F.lit(False)))
    return r.groupBy("cid").agg(F.max("__usable").alias("usable"), F.max("__hit").alias("known"), (F.max("__high") & ~F.max("__fine")).alias("excluded"))


#: Titles of ligands taken from structures: three signs, the structure's four, perhaps a copy number.
STRUCTURE_TITLE = r"^([A-Za-z0-9]{3})_([A-Za-z0-9]{4})(?:_copy_\d+)?$"


def title_candidates(title: Column | str) -> Column:
    """Codes that a title may stand for; an empty array for any other title."""
    t = F.col(title) if isinstance(title, str) else title
    code, entry = F.regexp_extract(t, STRUCTURE_TITLE, 1), F.regexp_extract(t, STRUCTURE_TITLE, 2)
    return F.when(t.rlike(STRUCTURE_TITLE), F.array(code, F.concat_ws("_", code, entry))).otherwise(F.array().cast("array<string>"))


def keep_reasons(blocks: DataFrame, flags: DataFrame, title: str = "title") -> DataFrame:
    """Adds ``reason``: kept_structure, kept_affinity, drop_excluded, drop_known or drop_unknown.

    Titles of structure ligands are looked up by their candidates, others by
    the number before ``_``, in one equi-join each.
    """
    # frozen, since the row numbers of a frame that is computed twice may differ
    b = cut(blocks.withColumn("__row", F.monotonically_increasing_id())).withColumn("__cand", title_candidates(title))
    f = flags.select(F.col("cid").cast("string").alias("__id"), "usable", "known", "excluded")
    looked = b.select("__row", F.explode(F.when(F.size("__cand") > 0, F.col("__cand")).otherwise(F.array(F.substring_index(title, "_", 1)))).alias("__id"))
    found = looked.join(f, "__id").groupBy("__row").agg(*(F.max(c).alias(c) for c in ("usable", "known", "excluded")))
    no = F.lit(False)
    out = b.join(found, "__row", "left").withColumn("__s", F.size("__cand") > 0)
    reason = (
        F.when(F.col("__s") & F.coalesce("excluded", no), "drop_excluded").when(F.col("__s"), "kept_structure").when(F.coalesce("usable", no), "kept_affinity").when(F.coalesce("known", no), "drop_known").otherwise("drop_unknown")
    )
    return out.withColumn("reason", reason).select(*blocks.columns, "reason")


def counters(reasons: DataFrame) -> DataFrame:
    """One row: total, kept and dropped rows, and the kept part of the total (guarded against 0)."""
    kept = F.count(F.when(F.col("reason").startswith("kept"), 1))
    return reasons.agg(F.count("*").alias("total"), kept.alias("kept"), (F.count("*") - kept).alias("dropped"), (kept / F.greatest(F.count("*"), F.lit(1))).alias("kept_share"))


def valued(df: DataFrame, value: str = "activity_value") -> DataFrame:
    """Rows whose value text isn't blank."""
    return df.where(blank_to_null(value).isNotNull())


def first_seen(df: DataFrame, key: str, order: str) -> DataFrame:
    """``key, seen``: each value once, with the least ``order`` it came with; sort by ``seen`` for the order of first sight."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("seen"))


#: Reasons that ``keep_reasons`` gives.
REASONS = ("kept_affinity", "kept_structure", "drop_excluded", "drop_known", "drop_unknown")


def reason_counters(reasons: DataFrame, *per: str) -> DataFrame:
    """Counts of all rows and of each reason, per file or in all, with the kept share guarded against 0; sums of files are sums of rows."""
    each = [F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in REASONS]
    out = reasons.groupBy(*per).agg(F.count("*").alias("total"), *each)
    kept = F.col("kept_affinity") + F.col("kept_structure")
    return out.withColumn("kept", kept).withColumn("dropped", F.col("total") - kept).withColumn("kept_share", kept / F.greatest(F.col("total"), F.lit(1)))
