"""Schemas and vocabularies of the data model."""

from __future__ import annotations

from pyspark.sql import types as T



#: One docked pose (NaN marks a score that could not be read, "" a text).
POSE = (
    "block_start bigint, block_end bigint, protein_id string, ligand_id string, UniqueID int, conformer_idx int, pose_rank int, SMILES string, n_atoms int, "
    "Vina_affinity double, CNNscore double, CNNaffinity double, CNN_VS double, CNNaffinity_variance double, Energy double, source_file string"
)
#: One reading of an assay.
READING = (
    "cid bigint, outcome string, activity string, assay_type string, activity_name string, target_accession string, target_geneid bigint, pubmed_id bigint, "
    "activity_qualifier string, activity_unit string, activity_value double"
)
PROPERTIES = "SMILES string, XLogP double, ExactMass double, MolecularWeight double, Charge double, Complexity double, TPSA double, InChIKey string"
PROTEIN_CLUSTER = "`Cluster number` bigint, Represenatives string, members string, member_compound array<string>"
LIGAND_CLUSTER = "`Protein Cluster number` bigint, `PDB/Gene ID` string, `Compound ID` string, Smiles string, `Ligand Cluster number` bigint"
LIGAND_SOURCE = "aid int, gene_id int, pubmed int, actives int, type string, affinity double, smiles string"
ASSAY = "aid bigint, gene_id string, sequence string"
ASSAY_COMPOUND = "aid bigint, cid bigint, smiles string, exact_mass double"

#: Column names of the dump and of a reading.
DUMP_COLUMNS = {
    "AID": "aid",
    "CID": "cid",
    "Activity Outcome": "outcome",
    "Activity Name": "activity_name",
    "Activity Value": "activity_value",
    "Activity Qualifier": "activity_qualifier",
    "Activity Unit": "activity_unit",
    "Protein Accession": "target_accession",
    "Gene ID": "target_geneid",
    "PMID": "pubmed_id",
}
#: Properties that are text; all others are numbers.
TEXT_PROPERTIES = ("SMILES", "ConnectivitySMILES", "InChI", "InChIKey", "IUPACName", "MolecularFormula", "Title")
#: Residue names that count as protein.
STANDARD_RESIDUES = (
    "ALA ARG ASN ASP CYS GLN GLU GLY HIS ILE LEU LYS MET PHE PRO SER THR TRP TYR VAL HIE HID HIP CYX ASH GLH"
).split()
#: Residue names of water.
WATERS = "HOH WAT TIP TIP3 SOL".split()
#: Element symbols that hold hydrogen bonds.
ELECTRONEGATIVE = "O N F CL BR I S".split()
#: Affinity types that convert to a free energy.
CONVERTIBLE = "Kd Ki Kb Kieq Kic IC50 EC50 fIC50 fEC50".split()


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def property_type(name: str) -> str:
    return "string" if name in TEXT_PROPERTIES else "double"
