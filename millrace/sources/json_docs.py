"""Nested JSON documents: concise assays, property tables, structure entries, id mappings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schemas import property_type

CONCISE = "struct<Table:struct<Columns:struct<Column:array<string>>,Row:array<struct<Cell:array<string>>>>,Fault:struct<Message:string>>"
ENTRY = (
    "struct<exptl:array<struct<method:string>>,rcsb_entry_info:struct<resolution_combined:array<double>,inter_mol_covalent_bond_count:int,nonpolymer_entity_count:int>,"
    "rcsb_entry_container_identifiers:struct<polymer_entity_ids:array<string>,non_polymer_entity_ids:array<string>>>"
)
COMPONENT = "struct<rcsb_chem_comp_descriptor:struct<SMILES:string,SMILES_stereo:string>,pdbx_chem_comp_descriptor:array<struct<type:string,descriptor:string>>>"
MAPPING = (
    "struct<results:array<struct<`from`:string,`to`:struct<primaryAccession:string,entryType:string,organism:struct<scientificName:string>,"
    "proteinDescription:struct<recommendedName:struct<fullName:struct<value:string>>,submissionNames:array<struct<fullName:struct<value:string>>>>,"
    "genes:array<struct<geneName:struct<value:string>>>,sequence:struct<value:string>,uniProtKBCrossReferences:array<struct<database:string,id:string>>>>>>"
)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concise_records(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """One row per ``Row`` of a concise assay: its cells by column name; short rows lack the last ones."""
    d = F.from_json(_c(doc), CONCISE)
    rows = docs.select(*(c for c in docs.columns if c != doc), d["Table"]["Columns"]["Column"].alias("__cols"), F.explode(d["Table"]["Row"]).alias("__row"))
    cells = F.col("__row.Cell")
    n = F.least(F.size("__cols"), F.size(cells))
    names = F.transform(F.slice("__cols", F.lit(1), n), lambda c: F.when(c == "PubMed ID", "PMID").otherwise(c))
    return rows.withColumn("cells", F.map_from_arrays(names, F.slice(cells, F.lit(1), n))).drop("__cols", "__row")


def cell(cells: Column | str, name: str) -> Column:
    return F.try_element_at(_c(cells), F.lit(name))


def faults(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Documents that are an error message."""
    return docs.withColumn("message", F.from_json(_c(doc), CONCISE)["Fault"]["Message"]).where("message IS NOT NULL")


def property_rows(docs: DataFrame, properties: Sequence[str], doc: str = "doc") -> DataFrame:
    """``cid`` and the typed properties of a property table; a missing property is NULL."""
    fields = ",".join(f"{p}:{property_type(p)}" for p in properties)
    d = F.from_json(_c(doc), f"struct<PropertyTable:struct<Properties:array<struct<CID:bigint,{fields}>>>>")
    return docs.select(F.explode(d["PropertyTable"]["Properties"]).alias("p")).select(F.col("p.CID").alias("cid"), *(F.col(f"p.{p}") for p in properties))


def entry_checks(docs: DataFrame, doc: str = "doc", worst_resolution: float = 3.0, mutations: str | None = None) -> DataFrame:
    """Adds ``has_ligand, covalent, xray, resolution, mutated, valid`` of a structure entry."""
    d = F.from_json(_c(doc), ENTRY)
    info = d["rcsb_entry_info"]
    mutated = F.exists(F.coalesce(F.col(mutations), F.array()), lambda n: n > 0) if mutations else F.lit(False)
    out = docs.withColumns(
        {
            "has_ligand": F.coalesce(info["nonpolymer_entity_count"] > 0, F.lit(False)),
            "covalent": F.coalesce(info["inter_mol_covalent_bond_count"] > 0, F.lit(False)),
            "xray": F.coalesce(F.exists(d["exptl"]["method"], lambda m: F.upper(m).contains("X-RAY")), F.lit(False)),
            "resolution": F.get(info["resolution_combined"], F.lit(0)),
            "mutated": mutated,
        }
    )
    fine = F.coalesce(F.col("resolution") <= worst_resolution, F.lit(False))
    return out.withColumn("valid", F.col("has_ligand") & ~F.col("covalent") & ~F.col("mutated") & F.col("xray") & fine)


def valid_ligands(names: Column | str, impurities: Sequence[str]) -> Column:
    """At least one ligand that is no impurity."""
    c = _c(names)
    bad = F.array(*(F.lit(i) for i in impurities)).cast("array<string>")
    return F.coalesce((F.size(c) > 0) & ~F.forall(c, lambda x: F.array_contains(bad, x)), F.lit(False))


def component_smiles(doc: Column | str) -> Column:
    """First SMILES in the order stated, stereo, canonical descriptor; "" where none."""
    d = F.from_json(_c(doc), COMPONENT)
    first = d["rcsb_chem_comp_descriptor"]
    canonical = F.get(F.filter(d["pdbx_chem_comp_descriptor"], lambda x: x["type"] == "SMILES_CANONICAL"), F.lit(0))["descriptor"]
    return F.coalesce(first["SMILES_stereo"], first["SMILES"], canonical, F.lit(""))


def mapped_ids(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """One row per mapping result, with fallbacks for names and the structure references as arrays."""
    d = F.from_json(_c(doc), MAPPING)
    r = docs.select(F.explode(d["results"]).alias("r"))
    t = F.col("r.to")
    name = F.coalesce(t["proteinDescription"]["recommendedName"]["fullName"]["value"], F.get(t["proteinDescription"]["submissionNames"], F.lit(0))["fullName"]["value"], F.lit(""))

    def refs(db: str) -> Column:
        return F.transform(F.filter(F.coalesce(t["uniProtKBCrossReferences"], F.array()), lambda x: x["database"] == db), lambda x: x["id"])

    return r.select(
        F.col("r.`from`").alias("gene_id"),
        t["primaryAccession"].alias("accession"),
        t["entryType"].contains("reviewed").alias("listed"),
        name.alias("protein_name"),
        F.coalesce(F.get(t["genes"], F.lit(0))["geneName"]["value"], F.lit("")).alias("gene_name"),
        t["organism"]["scientificName"].alias("organism"),
        t["sequence"]["value"].alias("sequence"),
        refs("PDB").alias("pdb_ids"),
        refs("AlphaFoldDB").alias("alphafold_ids"),
    )
