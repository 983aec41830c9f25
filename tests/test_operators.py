"""Assays, clusters, similarity, structures, JSON, tables, settings."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.config.commands import dock_command, dock_commands
from millrace.config.rules import DOCKING, LIGAND_PREPARATION, vocabulary_problems
from millrace.config.tree import ConfigTree
from millrace.functions import affinity as aff
from millrace.functions import nulls
from millrace.operators import assays, clusters, similarity, structures
from millrace.operators.strict_parse import ATOMS, parse_lines
from millrace.sources import json_docs, tables
from millrace.sources.parquet_store import ParquetStore, flatten


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


# ------------------------------------------------------------------- assays
DUMP = [("999999", "100", "Active", "IC50", "2.5", "=", "uM", "P12345", "7157", "24188023"), ("999999", "100", "Inactive", "IC50", "40.0", "=", "uM", "P12345", "7157", "24188023"), ("999999", "200", "Active", "Ki", "1.1", ">", "nM", "", "", ""), ("999999", "", "Active", "IC50", "5.0", "=", "uM", "P12345", "7157", ""), ("999999", "300", "Unspecified", "IC50", "9.9", "=", "uM", "P12345", "7157", "")]


def test_dump_and_accessors(spark, tmp_path):
    from millrace.schemas import DUMP_COLUMNS

    path = tmp_path / "dump.tsv"
    path.write_text("\n".join("\t".join(r) for r in [tuple(DUMP_COLUMNS), *DUMP]) + "\n")
    dump = tables.read_dump(spark, str(path), 2)
    assert dump.where("CID IS NULL").count() == 1
    r = tables.typed_readings(dump).cache()
    assert [x.cid for x in assays.compounds_of(r).collect()] == [100, 200, 300]
    assert [x.cid for x in assays.compounds_of(r, " ACTIVE ").collect()] == [100, 200]
    assert [x.cid for x in assays.compounds_of(r, "inactive").collect()] == [100]
    assert assays.specified(r).count() == 4
    got = {(x.affinity, x.activity_name, x.outcome) for x in assays.affinity(r.where("cid = 100")).collect()}
    assert got == {(2.5, "IC50", "Active"), (40.0, "IC50", "Inactive")}
    assert assays.agreed_value(r, ["aid"], "pubmed_id").first().pubmed_id == 24188023
    assert assays.agreed_value(r.withColumn("pubmed_id", F.coalesce("pubmed_id", F.lit(1))), ["aid"], "pubmed_id").first().pubmed_id is None
    assert tables.load_assay(dump, 999999).count() == 5 and tables.load_assay(dump, 1).count() == 0
    with pytest.raises(ValueError):
        assays.affinity(r, "most")


def test_last_part_wins_and_enrichment(spark):
    parts = rows(spark, [(1, "part-1", "C", 1.0), (1, "part-2", None, float("nan")), (2, "part-1", "N", 2.0)], "cid long, cache_part string, SMILES string, XLogP double")
    props = assays.latest_properties(parts, ["SMILES", "XLogP"])
    assert {tuple(r) for r in props.collect()} == {(1, "", None), (2, "N", 2.0)}
    m = rows(spark, [(1, 2), (2, None), (3, 9)], "id long, cid long")
    assert {tuple(r) for r in assays.enrich(m, props, lower=True).collect()} == {(1, 2, "N", 2.0), (2, None, "", None), (3, 9, "", None)}
    assert [r.cid for r in assays.missing_compounds(m, props).collect()] == [9]


@pytest.mark.parametrize("seed", range(3))
def test_membership_matches_a_sequential_reader(spark, seed):
    rng = random.Random(seed)
    data = [(i, rng.choice([None, 1, 2, 3]), rng.choice(["g1", "g2", None]), rng.choice([None, -1.0, 5.0]), rng.choice(["IC50", "odd"]), rng.choice([None, 3, 10, 11])) for i in range(40)]
    usable, known, high, fine = set(), set(), set(), set()
    for _, cid, gene, a, kind, bonds in data:
        if cid is None:
            continue
        if bonds is not None:
            (high if bonds > 10 else fine).add(cid)
        if gene != "g1":
            continue
        known.add(cid)
        if a is not None and a > 0 and kind == "IC50" and not (cid in high and cid not in fine):
            usable.add(cid)
    df = rows(spark, data, "n int, cid long, gene_id string, affinity double, type string, rotatable_bonds int")
    got = assays.membership_flags(df, rows(spark, [("g1",)], "gene_id string"), order="n").collect()
    assert {r.cid for r in got if r.usable} == usable and {r.cid for r in got if r.known} == known and {r.cid for r in got if r.excluded} == high - fine
    assert assays.membership_flags(df, rows(spark, [("g1",)], "gene_id string"), max_bonds=None).count() == len({r[1] for r in data if r[1]})


def test_reasons_and_counters(spark):
    flags = rows(spark, [("1", True, True, False), ("2", False, True, False), ("ABC_1XYZ", False, False, True)], "cid string, usable boolean, known boolean, excluded boolean")
    blocks = rows(spark, [("1_5",), ("2_5",), ("3_5",), ("ABC_1XYZ_copy_2",), ("DEF_1XYZ",), (None,)], "title string")
    got = {r.title: r.reason for r in assays.keep_reasons(blocks, flags).collect()}
    assert got == {"1_5": "kept_affinity", "2_5": "drop_known", "3_5": "drop_unknown", "ABC_1XYZ_copy_2": "drop_excluded", "DEF_1XYZ": "kept_structure", None: "drop_unknown"}
    assert assays.counters(assays.keep_reasons(blocks, flags)).first()[:3] == (6, 2, 4)


# --------------------------------------------------------- clusters, bits
def test_two_hop_and_lists(spark):
    genes = rows(spark, [("g",), ("h",)], "gene_id string")
    a = rows(spark, [("g", 2), ("g", 1)], "gene_id string, aid long")
    c = rows(spark, [(1, 5), (2, 5), (2, 6)], "aid long, cid long")
    assert {r.gene_id: r.compounds for r in clusters.two_hop(genes, a, c).collect()} == {"g": [5, 5, 6], "h": []}
    cl = rows(spark, [(0, ["r"], ["m", "n"])], "cluster_no long, representatives array<string>, members array<string>")
    assert clusters.representatives_by_members(cl).count() == 2
    v = rows(spark, [(0, ["m"], "r"), (1, ["z"], "y")], "cluster_no long, members array<string>, representative string")
    valid = rows(spark, [("m", ["1", "2"]), ("r", ["2"])], "id string, entries array<string>")
    assert [tuple(r) for r in clusters.valid_hits(v, valid).collect()] == [(0, ["1", "2"])]
    assert clusters.once_per_id(rows(spark, [("a", 2), ("a", 1), ("b", 3)], "k string, c long"), "k", "c").count() == 2


@pytest.mark.parametrize("seed", range(4))
def test_edges_and_butina_match_the_plain_way(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([1, 12, 25])
    sets = [{b for b in range(16) if rng.random() < 0.5} for _ in range(n)]
    items = rows(spark, [(i, sorted(s)) for i, s in enumerate(sets)], "item long, bits array<int>")
    sims = {(i, j): len(a & sets[j]) / len(a | sets[j]) for i, a in enumerate(sets) for j in range(i) if a | sets[j]}
    edges = similarity.tanimoto_edges(items, 0.5)
    assert {(r.i, r.j): r.sim for r in edges.collect()} == {k: v for k, v in sims.items() if 1 - v <= 0.5}
    want = similarity.butina_in_memory(sims, n, 0.5)
    got = {}
    for r in similarity.butina(items, edges).collect():
        got.setdefault(r.cluster_id, [r.representative]).append(r.item)
    assert [(sorted(m), m[0]) for m in want] == [(sorted(set(v)), v[0]) for _, v in sorted(got.items())]
    per = similarity.cluster_groups(items.withColumn("g", F.lit("x")), "g", "item", "bits", 0.5).collect()
    live = {i for i, s in enumerate(sets) if s}
    assert {r.item for r in per} == live


@pytest.mark.parametrize("largest", [0, 9, 20])
def test_large_groups_are_clustered_as_small_ones(spark, largest):
    rng = random.Random(5)
    names = [(g, f"{g}{i:02d}") for g, n in (("a", 24), ("b", 9), ("c", 15), ("d", 1)) for i in range(n)]
    data = [(g, i, sorted({b for b in range(16) if rng.random() < 0.5} | {16})) for g, i in names]
    data += [("a", None, [1]), ("a", "zz", []), ("a", "a00", data[0][2])]
    sets = rows(spark, data, "label string, name string, bits array<int>")
    want = {tuple(r) for r in similarity.cluster_groups(sets, "label", "name", "bits", 0.5).collect()}
    got = similarity.cluster_groups(sets, "label", "name", "bits", 0.5, largest=largest)
    assert got.columns == ["label", "name", "cluster_id"] and sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert len(want) == len(names)


def test_floor_and_orphans(spark):
    items = rows(spark, [], "item long, bits array<int>")
    with pytest.raises(ValueError):
        similarity.tanimoto_edges(items, 0.0)
    assert similarity.tanimoto_edges(items, 0.5).count() == 0
    assert similarity.butina(items, similarity.tanimoto_edges(items, 0.5)).count() == 0
    labels = rows(spark, [(0, "a", "a"), (1, "b", "zz")], "cluster_id long, item string, representative string")
    assert [r.item for r in similarity.orphan_representatives(labels).collect()] == ["zz"]
    assert [len(b) for b in similarity.iter_batches(spark.range(5), 2)] == [2, 2, 1]


def test_bit_functions_and_sql(spark):
    df = rows(spark, [([1, 2, 3], [2, 3, 4], [7], [3], [0.5, -1.0, 0.0])], "a array<int>, b array<int>, w array<long>, v array<long>, x array<float>")
    r = df.select(aff.tanimoto("a", "b").alias("s"), aff.tanimoto_words("w", "v").alias("t"), aff.on_bits("x").alias("o")).first()
    assert r.s == 0.5 and r.t == pytest.approx(2 / 3) and r.o == [0]
    aff.register(spark)
    got = spark.sql("SELECT to_kd(6, 'uM') AS k, to_delta_g(6, 300) AS g, to_pactivity(1, 'uM') AS p, tanimoto(array(1, 2), array(2)) AS t").first()
    assert got.k == pytest.approx(1.0) and got.g < 0 and got.p == pytest.approx(6.0) and got.t == 0.5
    assert spark.sql("SELECT b.* FROM (SELECT 'A$$$$B' AS t), LATERAL sdf_blocks(t) b").count() == 2


def test_unit_functions(spark):
    df = rows(spark, [(35.584, 35584.0), (0.0, 0.0), (-1.0, -1.0)], "u double, n double")
    got = df.select(aff.to_p_activity("u", "uM").alias("u"), aff.to_p_activity("n", "nM").alias("n")).collect()
    assert got[0].u == pytest.approx(4.4488, abs=1e-4) == got[0].n and math.isinf(got[1].u) and math.isnan(got[2].u)
    with pytest.raises(ValueError):
        aff.to_kd("u", "pounds")


def test_null_rules(spark):
    df = rows(spark, [(" 1.5 ",), ("377.9",), ("\t",), (None,), ("x",), ("377.0",), (" 7 ",)], "t string")
    got = [tuple(r) for r in df.select(nulls.lenient_double("t"), nulls.int_or_zero("t"), nulls.strict_long("t"), nulls.blank_to_null("t").isNull()).collect()]
    assert got == [(1.5, 1, None, False), (377.9, 377, None, False), (None, 0, None, True), (None, 0, None, True), (None, 0, None, False), (377.0, 377, None, False), (7.0, 7, 7, False)]


# --------------------------------------------------------------- structures
LINE = "ATOM      1  N   PHE A 537      -8.834   3.827 -18.279  1.00  0.00           N"


def test_fixed_columns_and_runs(spark):
    lines = rows(spark, [("f", 1, LINE), ("f", 2, "TER"), ("f", 3, LINE.replace("A 537", "A1086"))], "source_file string, line_no int, line string")
    a = structures.fixed_columns(lines).orderBy("resseq").collect()
    assert (a[0].resseq, a[0].x, a[0].element, a[1].resseq) == (537, -8.834, "N", 1086)
    assert structures.fused_numbers(lines).first().fused
    assert lines.select(structures.blank_chain("line").alias("l")).where(F.substring("l", 22, 1) == "A").count() == 0
    data = [("f", i, c, n, "", r) for i, (c, n, r) in enumerate([("A", 1, "GLY"), ("A", 1, "GLY"), ("B", 1, "ALA"), ("A", 1, "GLY")])]
    atoms = rows(spark, data, "source_file string, serial int, chain string, resseq int, icode string, resname string")
    runs = structures.residue_runs(atoms).orderBy("run").collect()
    assert [(r.run, r.chain) for r in runs] == [(0, "A"), (1, "B"), (2, "A")]
    out = structures.residue_runs(atoms.withColumn("chain", F.lit("U")))
    assert [r.n_names for r in structures.odd_numbers(atoms.withColumn("chain", F.lit("A"))).collect()] == [2]
    aligned = structures.align_chains(structures.residue_runs(atoms), structures.residue_runs(atoms.where("serial > 1"))).collect()
    assert [r.chain for r in sorted(aligned, key=lambda r: r.run)] == ["A", "B"] and out.count() == 3
    with pytest.raises(Exception, match="no place"):
        structures.align_chains(structures.residue_runs(atoms), structures.residue_runs(atoms.withColumn("resseq", F.lit(99)))).collect()


def test_render_round_trip(spark):
    lines = rows(spark, [(1, "ATOM      1  N   PHE A 537      -8.834   3.827 -18.279 -0.7800 1.5000")], "line_id long, line string")
    atoms = parse_lines(lines, ATOMS).select("line_id", "row.*")
    again = structures.render_atoms(atoms).select("line_id", "line")
    assert parse_lines(again, ATOMS).first().row == parse_lines(lines, ATOMS).first().row
    wide = rows(spark, [(-1234.5678, 12345.678, 1.0)], "a double, b double, c double")
    got = wide.select(structures.fixed_number("a", 8, 3), structures.fixed_number("b", 8, 3, False), structures.fixed_number("c", 8, 3)).first()
    assert tuple(got) == (" -1234.6", "12345.68", "   1.000")


def test_selections(spark):
    s = "source_file string, record string, serial int, resname string, chain string, resseq int, x double, y double, z double, element string, name string"
    data = [("f", "ATOM", 1, "GLY", "A", 1, 0.0, 0.0, 0.0, "N", "N"), ("f", "HETATM", 2, "LIG", "B", 1, 5.0, 0.0, 0.0, "O", "O1"), ("f", "HETATM", 3, "HOH", "A", 9, 2.5, 0.0, 0.0, "O", "O"), ("f", "HETATM", 4, "HOH", "A", 10, 7.0, 0.0, 0.0, "O", "O"), ("f", "HETATM", 5, "NA", "A", 11, 9.0, 9.0, 9.0, "NA", "NA"), ("g", "ATOM", 6, "ALA", "C", 1, 0.0, 0.0, None, "C", "CA")]
    a = rows(spark, data, s)
    assert structures.hetero(a).count() == 4 and structures.hetero(a, False).count() == 2
    assert {r.serial for r in structures.chains(a, ["B"]).collect()} == {2, 6}
    assert structures.residues(a, ["HOH"]).count() == 2 and structures.residues(a, ["HOH"], [1], False).count() == 1
    assert {r.serial for r in structures.waters_near(a, "LIG").collect()} == {3, 4}
    assert {r.serial for r in structures.waters_near(a, "LIG", "interfacial").collect()} == {3}
    assert [r.resname for r in structures.ligand_names(a).collect()] == ["LIG"] and structures.ligand_names(a, ["LIG"]).count() == 0
    protein, ligand = structures.separate(a, remove_water=False)
    assert {r.serial for r in protein.collect()} == {1, 3, 4, 6} and [r.serial for r in ligand.collect()] == [2]
    names = rows(spark, [(["GLY", "ALA", "LIG"],), (["LIG"],), ([],), (None,)], "n array<string>")
    assert [r[0] for r in names.select(structures.is_protein("n")).collect()] == [True, False, False, False]
    assert structures.common_names(a, a.where("serial < 3")).count() == 2
    assert structures.merge(a, a.limit(0), a).count() == 12


@pytest.mark.parametrize("seed", range(2))
def test_distances_match_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    p = rng.uniform(-3, 3, (60, 3))
    df = rows(spark, [(i, *map(float, q)) for i, q in enumerate(p)], "id int, x double, y double, z double")
    want = {(i, j) for i in range(60) for j in range(60) if np.linalg.norm(p[i] - p[j]) <= 1.0}
    assert {(r.a_id, r.b_id) for r in structures.within(df, df, 1.0).collect()} == want


def test_rmsd(spark):
    rng = np.random.default_rng(0)
    p = rng.normal(size=(8, 3))
    turn, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    turn *= np.sign(np.linalg.det(turn))
    q = p @ turn + 4
    assert structures.kabsch(p, q) == pytest.approx(0, abs=1e-6) and structures.kabsch(p, -p) > 0.1
    pairs = rows(spark, [(1, i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip(p, q))], "g int, atom int, ax double, ay double, az double, bx double, by double, bz double")
    assert structures.rmsd_superposed(pairs, ["g"]).first().rmsd == pytest.approx(0, abs=1e-6)
    a = pairs.select("g", "atom", F.col("ax").alias("x"), F.col("ay").alias("y"), F.col("az").alias("z"))
    assert structures.rmsd_in_place(a, a.withColumn("x", F.col("x") + 2), ["g"]).first().rmsd == pytest.approx(2.0)
    assert structures.rmsd_in_place(a, a.where("atom > 0"), ["g"]).first().rmsd is None


def test_cleanup_modes_and_mol2(spark):
    lines = rows(spark, [("ATOM      1  N   PHE A   1",), ("HETATM    2  O   HOH A   2",), ("HETATM    3  C   M3A A   3",)], "line string")
    assert [structures.stripped(lines, m).count() for m in ("waters", "nonstdres", "waters_nonstdres", "")] == [2, 2, 1, 3]
    mol = rows(spark, [("f", i, t) for i, t in enumerate(["@<TRIPOS>ATOM", "1 CA 0 0 0 1 1 X", "2 O1 0 0 0 O.3 1 X", "@<TRIPOS>BOND", "1 1 2 3 4 5 6"])], "source_file string, line_no int, line string")
    got = [r.line for r in structures.repaired_mol2(mol).orderBy("line_no").collect()]
    assert got[1] == "1 CA 0 0 0 C.3 1 X" and got[2].split()[5] == "O.3" and got[4] == "1 1 2 3 4 5 6"


# --------------------------------------------------------------------- JSON
def test_json_documents(spark):
    docs = rows(spark, [('{"Table":{"Columns":{"Column":["AID","CID","PubMed ID"]},"Row":[{"Cell":["1","2","3"]},{"Cell":["4"]}]}}',), ('{"Fault":{"Message":"gone"}}',), ("not json",), (None,)], "doc string")
    got = json_docs.concise_records(docs).select(json_docs.cell("cells", "CID").alias("c"), json_docs.cell("cells", "PMID").alias("p")).collect()
    assert {tuple(r) for r in got} == {("2", "3"), (None, None)}
    assert [r.message for r in json_docs.faults(docs).collect()] == ["gone"]
    props = rows(spark, [('{"PropertyTable":{"Properties":[{"CID":1,"XLogP":2.5},{"CID":2,"SMILES":"C"}]}}',)], "doc string")
    assert {tuple(r) for r in json_docs.property_rows(props, ["SMILES", "XLogP"]).collect()} == {(1, None, 2.5), (2, "C", None)}
    entry = '{"exptl":[{"method":"X-RAY DIFFRACTION"}],"rcsb_entry_info":{"resolution_combined":[2.0],"inter_mol_covalent_bond_count":0,"nonpolymer_entity_count":1}}'
    e = rows(spark, [(entry, [0]), (entry, [1]), (entry.replace("2.0", "3.5"), []), ("{}", None)], "doc string, m array<int>")
    assert [r.valid for r in json_docs.entry_checks(e, mutations="m").collect()] == [True, False, False, False]
    n = rows(spark, [(["HOH"],), (["HOH", "LIG"],), ([],), (None,)], "n array<string>")
    assert [r[0] for r in n.select(json_docs.valid_ligands("n", ["HOH"])).collect()] == [False, True, False, False]
    c = rows(spark, [('{"rcsb_chem_comp_descriptor":{"SMILES":"A"}}',), ('{"pdbx_chem_comp_descriptor":[{"type":"SMILES_CANONICAL","descriptor":"B"}]}',), ("{}",)], "doc string")
    assert [r[0] for r in c.select(json_docs.component_smiles("doc")).collect()] == ["A", "B", ""]
    m = '{"results":[{"from":"7157","to":{"primaryAccession":"P1","entryType":"reviewed","proteinDescription":{"submissionNames":[{"fullName":{"value":"N"}}]},"uniProtKBCrossReferences":[{"database":"PDB","id":"1ABC"},{"database":"X","id":"q"}]}}]}'
    r = json_docs.mapped_ids(rows(spark, [(m,)], "doc string")).first()
    assert (r.gene_id, r.protein_name, r.gene_name, r.pdb_ids, r.alphafold_ids) == ("7157", "N", "", ["1ABC"], [])


# ------------------------------------------------------------ tables, store
def test_text_tables(spark, tmp_path):
    lines = rows(spark, [(">a|b c\n",), ("ACGT",), (">>d",)], "value string")
    assert [r.header for r in tables.fasta_headers(lines).collect()] == ["a|b c", "d"]
    assert [r.header for r in tables.fasta_headers(lines, "|").collect()] == ["a", "d"]
    seq = rows(spark, [("g", "AA", 2), ("g", "CC", 1), ("h", " ", 1)], "gene string, s string, o int")
    assert [r.value for r in tables.fasta_text(seq, "gene", "s", "o").collect()] == [">g\nCC"]
    (tmp_path / "c.tsv").write_text("x\tb\nx\ta\ny\tc\n")
    assert {r.cluster: r.members for r in tables.cluster_members(spark, str(tmp_path / "c.tsv")).collect()} == {"x": ["a", "b"], "y": ["c"]}
    assert rows(spark, [("['a', 'b']",)], "t string").select(tables.list_column("t")).first()[0] == ["a", "b"]
    smi = rows(spark, [("C", 1, 5.0), ("", 2, 5.0), ("N", 3, None), ("O", 4, float("nan"))], "smiles string, actives long, pubmed double")
    assert [r.value for r in tables.smiles_lines(smi).collect()] == ["C 1_5.0"]
    n = rows(spark, [("f", i) for i in range(7)], "f string, o int")
    assert sorted(r.chunk for r in tables.line_chunks(n, "f", "o", 3).collect()) == [1, 1, 1, 2, 2, 2, 3]
    import gzip

    (tmp_path / "x.sdfgz").write_bytes(gzip.compress(b"hello"))
    got = tables.gunzipped(spark, str(tmp_path / "x.sdfgz")).first()
    assert got.text == "hello" and got.source_file.endswith("x.sdf")
    assert len(tables.with_md5(spark, str(tmp_path / "x.sdfgz")).first().md5) == 32


def test_store(spark, tmp_path):
    nested = rows(spark, [(2, ("x", (3,)), [1])], "id long, a struct<s:string,b:struct<z:long>>, l array<int>")
    store = ParquetStore(spark, str(tmp_path / "t"), codec="zstd")
    store.write(nested)
    store.append(nested)
    assert store.read(["id"], [("id", ">", 1)]).count() == 2 and store.read(filters=[[("id", "==", 9)], [("id", "in", [2])]]).count() == 2
    assert store.where("id", lambda c: c < 2).count() == 0
    assert flatten(store.scan()).columns == ["id", "a.s", "a.b.z", "l"]
    store.to_csv(str(tmp_path / "csv"))
    assert sum(r.n_rows for r in store.metadata().collect()) == 2 and store.metadata().first().n_columns == 4
    with pytest.raises(ValueError, match="lacks"):
        store.read_required(["id", "nothing"])
    with pytest.raises(ValueError):
        ParquetStore(spark, "x", codec="odd")
    with pytest.raises(ValueError):
        ParquetStore(spark, str(tmp_path / "b"), codec="brotli").write(nested)
    empty = ParquetStore(spark, str(tmp_path / "e"), nested.schema)
    empty.create()
    assert empty.scan().count() == 0 and empty.schema == nested.schema
    with pytest.raises(ValueError):
        store.read(filters=[("id", "~", 1)])


# ----------------------------------------------------------------- settings
def test_settings_tree(tmp_path):
    t = ConfigTree({"ff": "PARSE", "keep-chain": True, "a": {"pH": 7.0, "skip": False, "none": None}, "names": [1, 2]})
    assert t.words() == ["--ff PARSE", "--keep-chain", "--pH 7.0", "--names", "1", "2"]
    t.update({"a": {"pH": 6.0}})
    assert t.data["a"] == {"pH": 6.0, "skip": False, "none": None} and t.delete("skip") and not t.delete("skip")
    t.save(str(tmp_path / "c.yaml"))
    assert ConfigTree.load(str(tmp_path / "c.yaml")).data == t.data and ConfigTree.load(str(tmp_path / "no"), {"x": 1}).data == {"x": 1}


def test_rules():
    assert DOCKING.problems({"scoring": "vina", "num_modes": 3}) == []
    assert len(DOCKING.problems({"scoring": "x", "num_modes": 0, "odd": 1, "center_x": 1.0, "no_gpu": "yes"})) == 5
    assert DOCKING.problems({"autobox_ligand": "a", "size_x": 2.0})
    assert LIGAND_PREPARATION.problems({"min_ph": 9.0, "max_ph": 4.0}) == ["min_ph must not exceed max_ph"]
    with pytest.raises(ValueError):
        DOCKING.tree({"cpu": -1})
    assert len(vocabulary_problems(["A", "A", "B"], ["B"])) == 2


def test_commands(spark):
    words = dock_command("r.pdb", "x/l.sdf.gz", {"seed": 1})
    assert words[0] == "gnina" and "x/l_docked.sdf.gz" in words and "--seed" in words
    with pytest.raises(ValueError):
        dock_command("r.pqr", "l.sdf")
    pairs = rows(spark, [("r.pdb", "a.sdf"), ("r.pdb", "b.sdf"), ("r.pqr", "a.sdf")], "receptor string, ligand string")
    got = [r.command for r in dock_commands(pairs, {"seed": 1}).collect()]
    assert "--out a_docked.sdf.gz" in got[0] and "--out b_docked.sdf.gz" in got[1] and got[2] is None


def test_rendered_atoms_lose_no_digit(spark):
    from millrace.operators import structures

    rows = [
        ("ATOM", 123456, "N", "PHE", "A", 12345, None, -8.834, 3.827, -18.279, -0.78, 1.5),
        ("HETATM", 7, "1HB2", "NA", None, 7, "B", 1.0, -100.168, 2.0, 0.0, 0.0),
        ("ATOM", 8, "2H", "LIGX", "B", 1, None, 1.0, 2.0, 3.0, 0.1, 1.0),
    ]
    df = spark.createDataFrame(rows, "record string, serial long, name string, resname string, chain string, resseq long, icode string, x double, y double, z double, charge double, radius double")
    got = [r.line for r in structures.render_atoms(df).orderBy("record", "serial").collect()]
    assert got[0] == "ATOM      8 2H   LIGX B   1       1.000   2.000   3.000  0.1000 1.0000"
    assert got[1] == "ATOM  123456  N   PHE A12345      -8.834   3.827 -18.279 -0.7800 1.5000"
    assert got[2].startswith("HETATM    7 1HB2  NA     7B      1.000 -100.17   2.000")


def test_slices_are_clamped(spark):
    from millrace.operators import poses

    df = spark.range(20).selectExpr("19 - id AS id")
    assert [r.id for r in poses.row_slice(df, ["id"], -3, 4).collect()] == [0, 1, 2, 3]
    assert [r.id for r in poses.row_slice(df, ["id"], 18, 99).collect()] == [18, 19]
    assert poses.row_slice(df, ["id"], 5, 2).count() == 0 and sorted(r.id for r in poses.row_slice(df, ["id"], 17).collect()) == [17, 18, 19]
