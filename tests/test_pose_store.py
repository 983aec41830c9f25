"""Pose store, command line, downloads, protocols."""

import pytest
from pyspark.sql import functions as F

from millrace.__main__ import main, parser
from millrace.config.protocols import ButinaClusters, Preparation, numbered_outputs, preparation_of, sequence_cluster_command
from millrace.operators import structures
from millrace.operators.pose_store import PoseStore
from millrace.sources import remote


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("docked")
    for p, n in (("P1", 4), ("P2", 2)):
        d = root / p / "gypsum_out_1"
        d.mkdir(parents=True)
        (d / "a_docked.sdf").write_text("".join(f"L{i % 2}\n\n\n  1\n> <UniqueID>\n1\n\n> <CNNscore>\n0.{i}\n\n$$$$\n" for i in range(n)))
    return str(root)


def test_store(spark, tree, tmp_path):
    s = PoseStore(spark, str(tmp_path / "store"))
    assert s.table().count() == 0 and "PoseStore" in repr(s)
    assert {tuple(r) for r in s.build(tree, 2, keep_blocks=True).collect()} == {("P1", 4), ("P2", 2)}
    s.build(tree, 2, keep_blocks=True)
    assert s.table().count() == 6
    assert s.read_protein("P1").count() == 4 and s.read_proteins(["P2", "none"]).count() == 2 and s.read_all(ligand_id="L0").count() == 3
    with pytest.raises(KeyError):
        s.read_protein("none")
    assert s.read_block("P1", 1).startswith("L1")
    with pytest.raises(IndexError):
        s.read_block("P1", 9)
    assert s.top_per_pair(n=1).count() == 4
    assert sum(len(b) for b in s.iter_batches(size=4)) == 6
    assert [len(b) for b in s.iter_batches("P1", 3)] == [3, 1]
    assert s.to_batches(str(tmp_path / "batches"), 1).count() == 2
    plan = s.read_proteins(["P2"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [protein" in plan or "PartitionFilters: [isnotnull(protein" in plan


def test_command_line(spark, tree, tmp_path):
    assert main(["build-poses", tree, str(tmp_path / "s"), "--modes", "2"]) == 0
    assert main(["top-poses", str(tmp_path / "s"), str(tmp_path / "t"), "-n", "1"]) == 0
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    m = spark.createDataFrame([(1, "Active"), (2, "Inactive"), (None, "Active")], "cid long, outcome string")
    p = spark.createDataFrame([(1, "part-1", "C", 5.0)], "cid long, cache_part string, SMILES string, MolecularWeight double")
    m.write.parquet(str(tmp_path / "m"))
    p.write.parquet(str(tmp_path / "p"))
    assert main(["enrich", str(tmp_path / "m"), str(tmp_path / "p"), str(tmp_path / "e")]) == 0
    assert spark.read.parquet(str(tmp_path / "e")).first().SMILES == "C"
    assert main(["enrich", str(tmp_path / "m"), str(tmp_path / "p"), str(tmp_path / "f"), "--outcome", "none"]) == 1
    with pytest.raises(SystemExit):
        parser().parse_args(["odd"])


def test_downloads(tmp_path):
    target, calls = tmp_path / "x" / "f.gz", []
    head = lambda: {"ETag": 'W/"abc"'}

    def get():
        calls.append(1)
        return [b"he", b"llo"]

    assert remote.fetch(target, head, get) and not remote.fetch(target, head, get) and len(calls) == 1
    assert remote.fetch(target, lambda: {"Last-Modified": "now", "Content-Length": "5"}, get) and target.read_bytes() == b"hello"
    with pytest.raises(ValueError):
        remote.store(tmp_path / "bad", [b"x"], None, "0" * 32)
    assert not (tmp_path / "bad").exists() and not (tmp_path / "bad.part").exists()
    assert remote.checksum_of("abc  dir/f.gz\n", "f.gz") == "abc" and remote.checksum_of("", "f.gz") is None
    assert remote.mapping_address("http://h/", 22, 1) == remote.mapping_address("http://h", 1, 22)
    first = remote.backup(target)
    assert first != remote.backup(target) and first.exists() and remote.backup(tmp_path / "no") is None


def test_protocols(spark):
    assert preparation_of(True, True) is Preparation.CONFIGURED and preparation_of(True, False) is Preparation.CAPPED and preparation_of(False, False) is Preparation.DEFAULT
    assert "--cov-mode" in sequence_cluster_command("a", "b", "c")
    with pytest.raises(ValueError):
        sequence_cluster_command("a", "b", "c", coverage_mode=7)
    assert numbered_outputs(["a.sdf.gz", "b.mol2"]) == ["a_docked.sdf.gz", "b_docked.sdf.gz"]
    items = spark.createDataFrame([(0, [1, 2]), (1, [1, 2]), (2, [9])], "item long, bits array<int>")
    assert ButinaClusters(0.9).cluster(items).select("cluster_id").distinct().count() == 2
    with pytest.raises(ValueError):
        ButinaClusters(1.5)


def test_chains_are_put_back(spark):
    line = "ATOM      1  N   PHE U 537      -8.834   3.827 -18.279  1.00  0.00           N"
    rows = [("f", 1, line), ("f", 2, line), ("f", 3, line.replace("537", "538")), ("f", 4, "TER")]
    lines = spark.createDataFrame(rows, "source_file string, line_no int, line string")
    assigned = spark.createDataFrame([("f", 0, "A"), ("f", 1, "B")], "source_file string, run int, chain string")
    got = {r.line_no: r.c for r in structures.restored_chains(lines, assigned).select("line_no", F.substring("line", 22, 1).alias("c")).collect()}
    assert got == {1: "A", 2: "A", 3: "B", 4: ""}
