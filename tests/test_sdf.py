"""Multi-record text: synthetic files with known counts."""

import gzip

import pytest
from pyspark.sql import functions as F

from millrace.operators import poses as P
from millrace.operators import ranking
from millrace.sources import sdf


def block(title, uid, i, smiles="CCO"):
    atoms = "\n".join(f"{0.1 * k:10.4f}{0.2 * k:10.4f}{i:10.4f} C   0  0" for k in range(3))
    fields = {"UniqueID": uid, "SMILES": smiles, "Energy": f"{-100 + i:.4f}", "minimizedAffinity": f"{-8 + 0.1 * i:.4f}", "CNNscore": f"{0.5 + 0.01 * i:.4f}", "CNNaffinity": f"{5 + 0.1 * i:.4f}", "CNN_VS": f"{0.3 + 0.02 * i:.4f}", "CNNaffinity_variance": f"{0.01 + 0.001 * i:.4f}"}
    props = "".join(f"> <{k}>\n{v}\n\n" for k, v in fields.items())
    return f"{title}\n\n\n  3  2  0  0  0 V2000\n{atoms}\nM  END\n{props}"


def library(ligands, uids, conformers, modes):
    out, i = [], 0
    for lig in ligands:
        for uid in range(1, uids + 1):
            for _ in range(conformers * modes):
                out.append(block(lig, uid, i))
                i += 1
    return "$$$$\n".join(out) + "$$$$\n"


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    (root / "P1" / "gypsum_out_1").mkdir(parents=True)
    (root / "P2" / "gypsum_out_1").mkdir(parents=True)
    (root / "P1" / "gypsum_out_1" / "a_docked.sdf").write_text(library(["L1A", "L1B", "L1C"], 3, 3, 3))
    with gzip.open(root / "P2" / "gypsum_out_1" / "b_docked.sdf.gz", "wt") as f:
        f.write(library(["L2A"], 1, 3, 3))
    return str(root)


@pytest.fixture(scope="module")
def poses(spark, tree):
    return sdf.poses_of(sdf.split_blocks(sdf.read_texts(spark, sdf.docking_tree(tree))), 3).cache()


def test_counts_and_proteins(poses):
    assert poses.count() == 90
    assert {tuple(r) for r in poses.groupBy("protein_id").count().collect()} == {("P1", 81), ("P2", 9)}
    assert P.counts(poses.where("protein_id = 'P1'")).first()[:] == (81, 3, 9, 27)
    assert {tuple(r) for r in poses.groupBy("conformer_idx", "pose_rank").count().collect()} == {(c, m, 10) for c in range(3) for m in range(3)}


def test_filters_with_known_counts(poses):
    p1 = poses.where("protein_id = 'P1'")
    assert P.keyword_filter(p1, CNNscore_min=0.6).count() == 71
    assert P.keyword_filter(p1, CNNscore_min=0.55, CNNscore_max=0.65).count() == 11
    assert P.keyword_filter(p1, CNNscore_min=0.6, ligand_id="L1A").count() == 17
    assert P.keyword_filter(p1).count() == 81
    with pytest.raises(ValueError):
        P.keyword_filter(p1, nothing=1)


def test_best_and_top(poses):
    best = {r.ligand_id: round(r.CNNscore, 2) for r in P.best_rows(poses.where("protein_id = 'P1'"), ["ligand_id"]).collect()}
    assert best == {"L1A": 0.76, "L1B": 1.03, "L1C": 1.30}
    assert ranking.top_n(poses, ["protein_id", "ligand_id"], "CNNscore", 2, ties=["block_start"], rank_col="pair_rank").count() == 8
    assert ranking.top_n(poses, ["protein_id", "ligand_id", "UniqueID"], "CNNscore", 2, ties=["block_start"]).count() == 20
    with pytest.raises(ValueError):
        ranking.top_n(poses.withColumn("r", F.lit(1)), ["ligand_id"], "CNNscore", rank_col="r")
    with pytest.raises(ValueError):
        ranking.best_direction("other")
    with pytest.raises(ValueError):
        P.top_poses(poses, per="other")


def test_summary(poses):
    text = P.summary_text(poses, "ligand", "x.sdf")
    assert "n_ligands: 4" in text and "ligand_id=L1A" in text


def test_offsets_and_round_trip(spark, tree, tmp_path):
    texts = sdf.read_texts(spark, f"{tree}/P1/gypsum_out_1/a_docked.sdf")
    blocks = sdf.split_blocks(texts)
    again = sdf.block_at(texts, blocks.select("source_file", "block_start", "block_end", F.col("block").alias("want")))
    assert again.where("block <> want").count() == 0
    sdf.write_sdf(blocks.limit(5), str(tmp_path / "out"))
    back = sdf.split_blocks(sdf.read_texts(spark, str(tmp_path / "out")))
    assert back.count() == 5 and back.join(blocks, "block", "left_semi").count() == 5
    rendered = sdf.split_blocks(sdf.render_file(blocks))
    assert rendered.count() == 81 and rendered.where("NOT terminated").count() == 0


def test_odd_files(spark):
    texts = spark.createDataFrame([("empty", ""), ("null", None), ("cut", "A\n\n\n  x\n$$$$\nB\n> <UniqueID>\n7.9\n> <UniqueID>\nbad"), ("blank", "$$$$\n \n$$$$"), ("end", "C\n$$$$\n\n")], "source_file string, text string")
    rows = {(r.source_file, r.ligand_id): r for r in sdf.poses_of(sdf.split_blocks(texts), 9, "P").collect()}
    assert set(rows) == {("cut", "A"), ("cut", "B"), ("end", "C")}
    b = rows["cut", "B"]
    assert b.UniqueID == 0 and b.n_atoms == 0 and b.SMILES == "" and b.CNNscore != b.CNNscore
    assert {r[0] for r in sdf.truncated_files(texts).collect()} == {"empty", "null", "cut"}
    with pytest.raises(sdf.TruncatedFile):
        sdf.require_complete(texts)


def test_modes(spark):
    counts = spark.createDataFrame([("E1", 5), ("E2", 3), ("E3", 18)], "k string, n long")
    assert {r.k: r.num_modes for r in sdf.resolve_modes(counts, ["k"], [3]).collect()} == {"E1": 3, "E2": 3, "E3": 3}
    assert {r.k: r.num_modes for r in sdf.resolve_modes(counts, ["k"]).collect()} == {"E1": 5, "E2": 3, "E3": 18}
    assert {r.k: r.num_modes for r in sdf.resolve_modes(counts, ["k"], [9, 7]).collect()} == {"E1": 9, "E2": 9, "E3": 9}
    with pytest.raises(ValueError):
        sdf.resolve_modes(counts, ["k"], [])


def test_coordinates_and_empty_molecules(poses, spark):
    xyz = poses.where("ligand_id = 'L2A'").orderBy("block_start").select(sdf.coordinates().alias("c")).first().c
    assert len(xyz) == 3 and xyz[2].x == pytest.approx(0.2) and xyz[2].element == "C"
    df = spark.createDataFrame([("a\n\n\n  0  0  0 V2000\n",), ("a\n\n\n  3  2  0 V2000\n",)], "block string")
    assert sdf.without_empty(df).count() == 1


def test_batches(poses, tmp_path, spark):
    names = {r.protein_id: (r.batch, r.file_name) for r in P.protein_batches(poses, 1).collect()}
    assert names == {"P1": (0, "bt_0_P1_P1.parquet"), "P2": (1, "bt_1_P2_P2.parquet")}
    P.write_batches(poses.drop("block"), str(tmp_path / "b"), 1)
    assert spark.read.parquet(str(tmp_path / "b")).where("batch = 0").count() == 81
    P.write_by_protein(poses.select("protein_id", "ligand_id"), str(tmp_path / "p"))
    P.write_by_protein(poses.select("protein_id", "ligand_id").where("protein_id = 'P2'"), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 90
    assert P.new_proteins(poses, spark.read.parquet(str(tmp_path / "p"))).count() == 0
    assert [r.block_start for r in P.row_slice(poses.where("protein_id='P2'").select("block_start"), ["block_start"], -3, 2).collect()][0] == 0


def test_composite(spark):
    df = spark.createDataFrame([(1, "a", 1.0, -9.0), (2, "a", 0.0, -5.0), (3, "a", float("nan"), -7.0), (4, "b", 0.5, None)], "id int, ligand_id string, CNNscore double, Vina_affinity double")
    got = {r.id: r.composite for r in ranking.composite_score(df, {"CNNscore": 1, "Vina_affinity": 1}).collect()}
    assert got[1] == 1.0 and got[2] == 0.0 and got[3] is None and got[4] is None
    same = df.withColumn("CNNscore", F.lit(2.0)).withColumn("Vina_affinity", F.lit(-1.0))
    assert {r.composite for r in ranking.composite_score(same, {"CNNscore": 1, "Vina_affinity": 1}).collect()} == {0.5}
