"""Queries of the general data problems (p1, p3, p4, p6) over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.nulls import norm_id
from millrace.operators import compaction, heavy_keys, strict_parse, units
from millrace.session import spread, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = table(spark, sf_dir, "measurements").select("measurement_id", "cid", "activity_name", "activity_value", "activity_unit")
    readings = spread(readings, "measurement_id")
    molar = units.to_molar(readings, units.latest_masses(table(spark, sf_dir, "compounds")))
    return molar.select("measurement_id", F.round(F.col("p") * 100).cast("int").alias("p_centi"))


#: Columns of a pose that say where it lies, not what it is.
PLACE = ("pose_id", "source_file", "block_start", "block_end", "docked_at")


def _compacted(spark: SparkSession, sf_dir: str) -> compaction.Compacted:
    poses = table(spark, sf_dir, "poses")
    record = {c: norm_id(c) if c in ("protein_id", "ligand_id") else F.col(c) for c in poses.columns if c not in PLACE}
    return compaction.compact(poses, "source_file", "pose_id", record)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compacted(spark, sf_dir).repeats


def p3_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files that were written: one row per bin."""
    return _compacted(spark, sf_dir).bins


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    measurements = table(spark, sf_dir, "measurements")
    return heavy_keys.heavy_keys(heavy_keys.assay_gene_profile(measurements), measurements.count(), 0.04)


def p4_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, compounds, outcomes and exact quartiles per assay and gene."""
    return heavy_keys.assay_gene_profile(table(spark, sf_dir, "measurements"), (0.25, 0.5, 0.75))


def _lines(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(table(spark, sf_dir, name).select("line_id", "line"), "line_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    atoms = strict_parse.parse_atoms(_lines(spark, sf_dir, "pqr_lines"))
    readings = strict_parse.parse_readings(_lines(spark, sf_dir, "assay_lines"))
    return strict_parse.failures(atoms).unionByName(strict_parse.failures(readings))


def p6_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strict_parse.valid_rows(strict_parse.parse_atoms(_lines(spark, sf_dir, "pqr_lines")))


def p6_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strict_parse.valid_rows(strict_parse.parse_readings(_lines(spark, sf_dir, "assay_lines")))


QUERIES = {
    "p1_found": p1_found,
    "p3_found": p3_found,
    "p3_bins": p3_bins,
    "p4_found": p4_found,
    "p4_profile": p4_profile,
    "p6_found": p6_found,
    "p6_atoms": p6_atoms,
    "p6_readings": p6_readings,
}

_INT_KEY = "try_cast(nullif(regexp_extract(trim({c}), '^(?:[A-Za-z][A-Za-z _.-]*[:#=]?\\s*)?([+-]?[0-9]+)(?:\\.0*)?$', 1), '') AS bigint)"

_TEXT = "nullif(regexp_replace(activity_value, '^\\s+|\\s+$', '', 'g'), '')"

ORACLE = {
    "p3_found": """
        SELECT pose_id FROM (SELECT pose_id, min(pose_id) OVER (PARTITION BY nullif(upper(trim(protein_id)), ''), nullif(upper(trim(ligand_id)), ''), UniqueID, conformer_idx, pose_rank, SMILES, n_atoms,
          Vina_affinity, CNNscore, CNNaffinity, CNN_VS, CNNaffinity_variance, Energy) AS first_id FROM poses) WHERE pose_id > first_id""",
    "p4_found": " UNION ALL ".join(
        f"SELECT '{c}' AS key_field, k AS key_value FROM (SELECT {_INT_KEY.format(c=c)} AS k, count(*) AS n FROM measurements GROUP BY 1) WHERE k IS NOT NULL AND n > 0.04 * (SELECT count(*) FROM measurements)"
        for c in ("aid", "target_geneid")
    ),
    "p4_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS key_field, k AS key_value, count(*) AS n_rows, count(DISTINCT cid) AS n_compounds,
        {", ".join(f"count(*) FILTER (o = '{o}') AS n_{o}" for o in ("active", "inactive", "inconclusive", "unspecified"))}, count(v) AS n_values,
        {", ".join(f"quantile_disc(v, {q / 100}) AS q{q}" for q in (25, 50, 75))}
        FROM (SELECT {_INT_KEY.format(c=c)} AS k, cid, lower(trim(outcome)) AS o, CASE WHEN isfinite(try_cast({_TEXT} AS DOUBLE)) THEN try_cast({_TEXT} AS DOUBLE) END AS v FROM measurements) WHERE k IS NOT NULL GROUP BY k"""
        for c in ("aid", "target_geneid")
    ),
}
