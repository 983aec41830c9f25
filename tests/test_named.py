"""Files with names of their own, and small row helpers."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.nulls import all_digits, has_letter, ordered_distinct
from millrace.operators import assays, clusters, poses
from millrace.sources import named


def texts(folder):
    return {p.name: p.read_text() for p in folder.iterdir() if not p.name.startswith((".", "_"))}


def test_filtered_records_per_file(spark, tmp_path):
    rows = [("/d/a_docked.sdf.gz", i, f"t{i}\nx") for i in (30, 4, 100)] + [("/d/b_docked.sdf", 0, "none")]
    df = spark.createDataFrame(rows, "source_file string, block_start long, block string")
    assert named.write_filtered_sdf(df, str(tmp_path / "o"), F.col("block") != "none") == 1
    assert texts(tmp_path / "o") == {"a_docked_filtered.sdf": "t4\nx\n$$$$\nt30\nx\n$$$$\nt100\nx\n$$$$\n"}


def test_line_chunks_and_values(spark, tmp_path):
    df = spark.range(7).select(F.lit("/x/lig.smi").alias("source_file"), F.col("id").alias("line_no"), F.concat(F.lit("C"), F.col("id").cast("string")).alias("line"))
    assert named.write_chunks(df, str(tmp_path / "c"), 3) == 3
    assert texts(tmp_path / "c") == {"lig_part1.smi": "C0\nC1\nC2\n", "lig_part2.smi": "C3\nC4\nC5\n", "lig_part3.smi": "C6\n"}
    with pytest.raises(FileExistsError):
        named.write_chunks(df, str(tmp_path / "c"), 3)
    values = spark.createDataFrame([("p 1.txt", 2, 0.5), ("p 1.txt", 1, 1.25)], "file string, pose int, rmsd double")
    assert named.write_values(values, str(tmp_path / "v"), "file", ["pose"], F.format_string("%d %.3f", "pose", "rmsd")) == 1
    assert texts(tmp_path / "v") == {"p 1.txt": "1 1.250\n2 0.500\n"}
    with pytest.raises(ValueError):
        named.write_values(values.withColumn("file", F.lit(None).cast("string")), str(tmp_path / "w"), "file", ["pose"], F.lit(""))


def test_batch_files(spark, tmp_path):
    df = spark.createDataFrame([(f"P{i % 5}", i, "clash") for i in range(20)], "protein_id string, pose_id long, batch string")
    assert named.write_batch_files(df, str(tmp_path / "b"), 2) == 3
    assert sorted(texts_names(tmp_path / "b")) == ["bt_0_P0_P1.parquet", "bt_1_P2_P3.parquet", "bt_2_P4_P4.parquet"]
    assert spark.read.parquet(str(tmp_path / "b")).exceptAll(df).count() == 0
    assert named.write_named(df.withColumn("n", F.lit("bt_2_P4_P4.parquet")), str(tmp_path / "b"), "n", kind="parquet", mode="skip") == 0


def texts_names(folder):
    return [p.name for p in folder.iterdir() if not p.name.startswith((".", "_"))]


def test_row_helpers(spark):
    df = spark.createDataFrame([(3, "a1"), (1, "12"), (2, None), (5, ""), (4, "\u00e9")], "id long, s string")
    assert [r.id for r in poses.take(df, ["id"], [0, 3, 9]).orderBy("id").collect()] == [1, 4]
    assert {r.id for r in df.where(has_letter("s")).collect()} == {3, 4} and {r.id for r in df.where(all_digits("s")).collect()} == {1}
    seen = spark.createDataFrame([(7, 3), (9, 1), (7, 2), (None, 0)], "cid long, at long")
    assert [r.cid for r in assays.first_seen(seen, "cid", "at").orderBy("seen").collect()] == [9, 7]
    assert ordered_distinct(["b", "a", "b"]) == ["b", "a"]
    modes = spark.createDataFrame([("l", 2, 9), ("l", 1, 9), ("k", 1, 7)], "ligand_id string, UniqueID int, num_modes int")
    assert {(r.num_modes, r.n_groups, tuple(r.example)) for r in poses.mode_summary(modes).collect()} == {(9, 2, ("l", 1)), (7, 1, ("k", 1))}
    rows = spark.createDataFrame([("p", 1, "x"), ("q", 1, "y"), ("q", 1, None), ("r", None, "z")], "item string, cluster int, ligand string")
    assert {(r.item, tuple(r.ligands)) for r in clusters.ligands_of_cluster(rows, "item", ["cluster"], "ligand").collect()} == {("p", ("x", "y")), ("q", ("x", "y"))}
    reasons = spark.createDataFrame([("f", "kept_affinity"), ("f", "drop_known"), ("g", "kept_structure")], "file string, reason string")
    got = {r.file: (r.total, r.kept, r.dropped, r.drop_known) for r in assays.reason_counters(reasons, "file").collect()}
    assert got == {"f": (2, 1, 1, 1), "g": (1, 1, 0, 0)} and assays.reason_counters(reasons.limit(0)).first().kept_share == 0
