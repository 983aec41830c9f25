"""Incremental ingest: every file once, resumable."""

from millrace.streaming import ingest


def test_files_land_once(spark, tmp_path):
    src, out, ck = tmp_path / "P1" / "gypsum_out_1", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir(parents=True)
    text = "A\n\n\n  0\n> <UniqueID>\n1\n\n$$$$\n"
    (src / "a_docked.sdf").write_text(text * 2)
    glob = str(tmp_path / "*/gypsum_out_*/")
    ingest.ingest_poses(spark, glob, out, ck).awaitTermination()
    (src / "b_docked.sdf").write_text(text)
    ingest.ingest_poses(spark, glob, out, ck).awaitTermination()
    ingest.ingest_poses(spark, glob, out, ck).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 3 and got.select("protein_id").distinct().first()[0] == "P1"


def test_manifests(spark):
    a = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "file string, signature string")
    m = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", None)], "file string, signature string")
    assert [r.file for r in ingest.changed(a, m).collect()] == ["b"]
    assert ingest.unseen(a, m.limit(1), "file").count() == 2
