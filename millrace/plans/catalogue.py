"""Queries of the relational and dataflow operators over the test tables, whole tables each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import affinity as aff
from millrace.functions.nulls import blank_to_null, lenient_double, norm_outcome, strict_long
from millrace.operators import assays, clusters, heavy_keys, poses, ranking, similarity, structures
from millrace.schemas import WATERS
from millrace.session import fresh_path
from millrace.session import table as t
from millrace.sources import json_docs, parquet_store, sdf, tables
from millrace.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
Q = Callable[[SparkSession, str], DataFrame]


def query(sql: str | None = None) -> Callable[[Q], Q]:
    def keep(f: Q) -> Q:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


#: NaN as NULL; by text, since DuckDB folds isnan() from file statistics that leave NaN out.
_S = "CASE WHEN CAST({0} AS VARCHAR) = 'nan' THEN NULL ELSE {0} END"
_SCORES = tuple(ranking.SCORE_DIRECTIONS)


# ----------------------------------------------------------------- ranking
@query(
    f"""SELECT pose_id, CAST(rn - 1 AS INTEGER) AS pair_rank FROM (SELECT pose_id, row_number() OVER (PARTITION BY protein_id, ligand_id
    ORDER BY {_S.format("CNNscore")} DESC NULLS LAST, pose_rank ASC NULLS LAST, pose_id) AS rn FROM poses) WHERE rn <= 5"""
)
def pair_topn(s: SparkSession, d: str) -> DataFrame:
    """The five best poses per protein and ligand."""
    rows = t(s, d, "poses").select("pose_id", "protein_id", "ligand_id", "CNNscore", "pose_rank")
    return ranking.top_n(rows, ["protein_id", "ligand_id"], "CNNscore", 5, ties=["pose_rank", "pose_id"], rank_col="pair_rank").select("pose_id", "pair_rank")


@query(
    " UNION ALL ".join(
        f"""SELECT '{per}' AS level, pose_id FROM (SELECT pose_id, row_number() OVER (PARTITION BY protein_id, {", ".join(keys)}
        ORDER BY {_S.format("Vina_affinity")} ASC NULLS LAST, pose_id) AS rn FROM poses) WHERE rn <= 2"""
        for per, keys in poses.LEVELS.items()
    )
)
def top_per_level(s: SparkSession, d: str) -> DataFrame:
    """The two best poses by affinity of each ligand, protomer and conformer."""
    rows = t(s, d, "poses").select("pose_id", "protein_id", "ligand_id", "UniqueID", "conformer_idx", "Vina_affinity")
    parts = [poses.top_poses(rows, "Vina_affinity", 2, per, ["protein_id"], ties=["pose_id"]).select(F.lit(per).alias("level"), "pose_id") for per in poses.LEVELS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_C, _V = _S.format("CNNscore"), _S.format("Vina_affinity")


@query(
    f"""WITH e AS (SELECT min({_C}) AS clo, max({_C}) AS chi, min({_V}) AS vlo, max({_V}) AS vhi FROM poses),
    c AS (SELECT pose_id, protein_id, ligand_id, 0.0::DOUBLE + 0.7::DOUBLE * (({_C} - clo) / (chi - clo)) + 0.3::DOUBLE * (1.0::DOUBLE - ({_V} - vlo) / (vhi - vlo)) AS composite FROM poses, e)
    SELECT pose_id, composite FROM (SELECT *, row_number() OVER (PARTITION BY protein_id, ligand_id ORDER BY composite DESC NULLS LAST, pose_id) AS rn FROM c) WHERE rn <= 3"""
)
def composite_topn(s: SparkSession, d: str) -> DataFrame:
    """The three best poses per pair by a weighted composite of scaled scores."""
    rows = t(s, d, "poses").select("pose_id", "protein_id", "ligand_id", "CNNscore", "Vina_affinity")
    scored = ranking.composite_score(rows, {"CNNscore": 0.7, "Vina_affinity": 0.3})
    return ranking.top_n(scored, ["protein_id", "ligand_id"], "composite", 3, False, ["pose_id"]).select("pose_id", "composite")


@query(
    f"""SELECT protein_id, ligand_id, pose_id, CNNscore FROM (SELECT *, row_number() OVER (PARTITION BY protein_id, ligand_id ORDER BY CNNscore DESC, pose_id) AS rn
    FROM poses WHERE {_C} IS NOT NULL) WHERE rn = 1"""
)
def best_per_group(s: SparkSession, d: str) -> DataFrame:
    return poses.best_rows(t(s, d, "poses"), ["protein_id", "ligand_id"], tie="pose_id", take=["pose_id", "CNNscore"])


@query("SELECT o_orderkey, CAST(rn - 1 AS INTEGER) AS price_rank FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 5")
def orders_topn(s: SparkSession, d: str) -> DataFrame:
    rows = t(s, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ranking.top_n(rows, ["o_custkey"], "o_totalprice", 5, False, ["o_orderkey"], "price_rank").select("o_orderkey", "price_rank")


# ------------------------------------------------------- numbering and modes
@query(
    """SELECT pose_id, CAST(q // 9 AS INTEGER) AS conformer_idx, CAST(q % 9 AS INTEGER) AS pose_rank FROM
    (SELECT pose_id, row_number() OVER (PARTITION BY source_file, ligand_id, UniqueID ORDER BY pose_id) - 1 AS q FROM poses)"""
)
def conformer_assign(s: SparkSession, d: str) -> DataFrame:
    rows = t(s, d, "poses").select("pose_id", "source_file", "ligand_id", "UniqueID", F.col("pose_id").alias("block_start"))
    return sdf.number_poses(rows, 9).select("pose_id", "conformer_idx", "pose_rank")


@query(
    """WITH c AS (SELECT protein_id, ligand_id, UniqueID, count(*) AS n FROM poses GROUP BY ALL),
    m AS (SELECT *, coalesce(list_filter([9, 5, 4, 2], lambda m: n % m = 0)[1], CASE WHEN n % 9 <= n % 5 AND n % 9 <= n % 4 AND n % 9 <= n % 2 THEN 9
      WHEN n % 5 <= n % 4 AND n % 5 <= n % 2 THEN 5 WHEN n % 4 <= n % 2 THEN 4 ELSE 2 END) AS num_modes FROM c)
    SELECT protein_id, ligand_id, UniqueID, n, CAST(num_modes AS INTEGER) AS num_modes FROM m"""
)
def mode_resolution(s: SparkSession, d: str) -> DataFrame:
    keys = ["protein_id", "ligand_id", "UniqueID"]
    return sdf.resolve_modes(t(s, d, "poses").groupBy(*keys).agg(F.count("*").alias("n")), keys, [2, 4, 5, 9])


# ------------------------------------------------------------------ filters
@query("SELECT pose_id, CNNscore FROM poses WHERE CAST(CNNscore AS VARCHAR) <> 'nan' AND CNNscore >= 0.5 AND CAST(Vina_affinity AS VARCHAR) <> 'nan' AND Vina_affinity <= -7.5 AND pose_rank = 0")
def range_filter(s: SparkSession, d: str) -> DataFrame:
    return poses.keyword_filter(t(s, d, "poses"), CNNscore_min=0.5, Vina_affinity_max=-7.5, pose_rank=0).select("pose_id", "CNNscore")


@query("SELECT DISTINCT cid FROM measurements WHERE lower(trim(outcome)) = 'active' AND cid IS NOT NULL")
def outcome_distinct(s: SparkSession, d: str) -> DataFrame:
    return assays.compounds_of(t(s, d, "measurements"), "Active")


@query("SELECT coalesce(lower(trim(outcome)), '') AS outcome, count(*) AS n FROM measurements WHERE coalesce(lower(trim(outcome)), '') <> 'unspecified' GROUP BY 1")
def outcome_counts(s: SparkSession, d: str) -> DataFrame:
    return assays.specified(t(s, d, "measurements")).groupBy(F.coalesce(norm_outcome("outcome"), F.lit("")).alias("outcome")).agg(F.count("*").alias("n"))


_VALUE = r"try_cast(nullif(regexp_replace(activity_value, '^\s+|\s+$', '', 'g'), '') AS DOUBLE)"


@query(
    rf"""SELECT measurement_id, {_VALUE} AS value, CASE WHEN regexp_matches(trim(target_geneid), '^[+-]?[0-9]+$') THEN try_cast(trim(target_geneid) AS BIGINT) END AS gene,
    coalesce(activity_unit, '') AS unit FROM measurements"""
)
def typed_values(s: SparkSession, d: str) -> DataFrame:
    """Lenient numbers, strict whole numbers, blanks for missing text."""
    return t(s, d, "measurements").select("measurement_id", lenient_double("activity_value").alias("value"), strict_long("target_geneid").alias("gene"), F.coalesce("activity_unit", F.lit("")).alias("unit"))


@query("SELECT measurement_id FROM measurements WHERE nullif(regexp_replace(activity_value, '^\\s+|\\s+$', '', 'g'), '') IS NOT NULL")
def valued_rows(s: SparkSession, d: str) -> DataFrame:
    return assays.valued(t(s, d, "measurements")).select("measurement_id")


@query("SELECT doc_id FROM documents WHERE source = 'notes.bench.example' AND n_chars BETWEEN 200 AND 900 OR lang IN ('de', 'fr') AND n_chars > 2000")
def pushed_predicates(s: SparkSession, d: str) -> DataFrame:
    """Filters as lists of comparisons, which reach the scan."""
    store = parquet_store.ParquetStore(s, f"{d}/documents.parquet")
    return store.read(["doc_id"], [[("source", "==", "notes.bench.example"), ("n_chars", ">=", 200), ("n_chars", "<=", 900)], [("lang", "in", ["de", "fr"]), ("n_chars", ">", 2000)]])


@query("SELECT DISTINCT protein_id FROM poses WHERE regexp_matches(ligand_id, '^[A-Za-z0-9]{3}_[A-Za-z0-9]{4,6}$')")
def structure_ligands(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "poses").where(F.col("ligand_id").rlike("^[A-Za-z0-9]{3}_[A-Za-z0-9]{4,6}$")).select("protein_id").distinct()


@query(
    """SELECT item_id, CASE WHEN regexp_matches(item_id, '^[A-Za-z0-9]{3}_[A-Za-z0-9]{4}(?:_copy_\\d+)?$')
    THEN [regexp_extract(item_id, '^([A-Za-z0-9]{3})_', 1), regexp_extract(item_id, '^([A-Za-z0-9]{3}_[A-Za-z0-9]{4})', 1)] ELSE [] END AS candidates FROM (SELECT DISTINCT item_id FROM cluster_labels)"""
)
def title_codes(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "cluster_labels").select("item_id").distinct().select("item_id", assays.title_candidates("item_id").alias("candidates"))


# --------------------------------------------------------------- aggregates
_READ = f"(SELECT cid, activity_name, outcome, {_VALUE} AS v FROM measurements)"


def _values(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "measurements").select("cid", "activity_name", "outcome", lenient_double("activity_value").alias("activity_value"))


@query(f"SELECT cid, activity_name, outcome, min(v) AS affinity FROM {_READ} GROUP BY ALL")
def affinity_min(s: SparkSession, d: str) -> DataFrame:
    return assays.affinity(_values(s, d), "min")


@query(f"SELECT cid, activity_name, outcome, avg(floor(v)) AS affinity FROM {_READ} GROUP BY ALL")
def affinity_average(s: SparkSession, d: str) -> DataFrame:
    """Means of whole numbers, whose sums do not depend on the order."""
    return assays.affinity(_values(s, d).withColumn("activity_value", F.floor("activity_value").cast("double")), "average")


@query(f"SELECT cid, activity_name, outcome, coalesce(list_sort(list(v) FILTER (v IS NOT NULL)), []) AS affinity FROM {_READ} GROUP BY ALL")
def affinity_all(s: SparkSession, d: str) -> DataFrame:
    return assays.affinity(_values(s, d), "all")


@query("SELECT aid, CASE WHEN count(DISTINCT pubmed_id) = 1 THEN max(pubmed_id) END AS pubmed_id FROM (SELECT aid, nullif(trim(pubmed_id), '') AS pubmed_id FROM measurements) GROUP BY aid")
def agreed_reference(s: SparkSession, d: str) -> DataFrame:
    return assays.agreed_value(t(s, d, "measurements").select("aid", blank_to_null("pubmed_id").alias("pubmed_id")), ["aid"], "pubmed_id")


_KEY = "coalesce({0}, '')"


@query(
    """SELECT count(*) AS n_poses, count(DISTINCT coalesce(ligand_id, '')) AS n_ligands, count(DISTINCT (coalesce(ligand_id, ''), coalesce(UniqueID, -1))) AS n_protomers,
    count(DISTINCT (coalesce(ligand_id, ''), coalesce(UniqueID, -1), coalesce(conformer_idx, -1))) AS n_conformers FROM poses"""
)
def distinct_counts(s: SparkSession, d: str) -> DataFrame:
    return poses.counts(t(s, d, "poses"))


@query("SELECT protein_id, ligand_id, UniqueID, conformer_idx, count(*) AS n_poses FROM poses GROUP BY ALL")
def poses_per_conformer(s: SparkSession, d: str) -> DataFrame:
    return poses.poses_per(t(s, d, "poses"), within=["protein_id"])


@query("SELECT protein_id, ligand_id, UniqueID, SMILES, count(*) AS n_poses, count(DISTINCT conformer_idx) AS n_conformers FROM poses GROUP BY ALL")
def protomer_counts(s: SparkSession, d: str) -> DataFrame:
    return poses.protomer_counts(t(s, d, "poses"), ["protein_id"])


@query(f"SELECT protein_id, {', '.join(f'min({_S.format(c)}) AS {c}_min, max({_S.format(c)}) AS {c}_max' for c in _SCORES)} FROM poses GROUP BY protein_id")
def score_ranges(s: SparkSession, d: str) -> DataFrame:
    return poses.score_ranges(t(s, d, "poses"), ["protein_id"])


@query(
    """SELECT count(DISTINCT aid) AS n_keys, count(DISTINCT CASE WHEN trim(target_geneid) <> '' THEN aid END) AS with_target_geneid,
    count(DISTINCT CASE WHEN trim(target_accession) <> '' THEN aid END) AS with_target_accession, count(DISTINCT CASE WHEN cid IS NOT NULL THEN aid END) AS with_cid FROM measurements"""
)
def coverage_report(s: SparkSession, d: str) -> DataFrame:
    return clusters.coverage(t(s, d, "measurements"), "aid", "target_geneid", "target_accession", "cid")


@query("SELECT protein_kind, list_sort(list(target_geneid)) AS genes FROM targets GROUP BY protein_kind")
def list_aggregate(s: SparkSession, d: str) -> DataFrame:
    return clusters.list_per_key(t(s, d, "targets"), "protein_kind", "target_geneid", "genes")


@query("SELECT count(DISTINCT lang) + max((lang IS NULL)::INT) AS n_langs, count(DISTINCT source) + max((source IS NULL)::INT) AS n_sources FROM documents")
def distinct_with_null(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "documents").agg(clusters.distinct_with_null("lang", "n_langs"), clusters.distinct_with_null("source", "n_sources"))


# -------------------------------------------------------------------- joins
_PROPS = ("SMILES", "XLogP", "ExactMass", "MolecularWeight", "Charge", "Complexity", "TPSA", "InChIKey")
_LAST = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY cache_part DESC NULLS LAST, {", ".join(f"{p} DESC NULLS LAST" for p in _PROPS)}) AS rn FROM compounds) WHERE rn = 1)"""
_NUM = f"{_S} AS {{0}}"


@query(f"SELECT cid, coalesce(SMILES, '') AS SMILES, {', '.join(_NUM.format(p) for p in _PROPS[1:7])}, coalesce(InChIKey, '') AS InChIKey FROM {_LAST}")
def upsert_last_wins(s: SparkSession, d: str) -> DataFrame:
    return assays.latest_properties(t(s, d, "compounds"), _PROPS)


@query(
    f"""SELECT measurement_id, m.cid, coalesce(SMILES, '') AS smiles, {_S.format('MolecularWeight')} AS molecularweight, coalesce(InChIKey, '') AS inchikey
    FROM measurements m LEFT JOIN {_LAST} p ON m.cid = p.cid"""
)
def enrich_left(s: SparkSession, d: str) -> DataFrame:
    """Measurements with their compound's properties, names in lower case."""
    props = assays.latest_properties(t(s, d, "compounds"), _PROPS).select("cid", "SMILES", "MolecularWeight", "InChIKey")
    return assays.enrich(t(s, d, "measurements").select("measurement_id", "cid"), props, lower=True)


@query("SELECT DISTINCT cid FROM measurements WHERE cid IS NOT NULL AND cid NOT IN (SELECT cid FROM compounds WHERE cid IS NOT NULL)")
def enrich_missing(s: SparkSession, d: str) -> DataFrame:
    return assays.missing_compounds(t(s, d, "measurements"), t(s, d, "compounds"))


@query("SELECT batch, list_sort(list(cid)) AS cids FROM (SELECT cid, (row_number() OVER (ORDER BY cid) - 1) // 150 AS batch FROM (SELECT DISTINCT cid FROM compounds WHERE cid IS NOT NULL)) GROUP BY batch")
def request_batches(s: SparkSession, d: str) -> DataFrame:
    return assays.request_batches(t(s, d, "compounds").where("cid IS NOT NULL").select("cid").distinct())


@query("SELECT measurement_id FROM measurements WHERE trim(target_geneid) IN (SELECT target_geneid FROM targets WHERE protein_kind = 'kinase')")
def semi_membership(s: SparkSession, d: str) -> DataFrame:
    kinases = t(s, d, "targets").where("protein_kind = 'kinase'").select(F.col("target_geneid").alias("g"))
    m = t(s, d, "measurements").select("measurement_id", blank_to_null("target_geneid").alias("gene"))
    return m.join(kinases, m["gene"] == kinases["g"], "left_semi").select("measurement_id")


@query(
    """SELECT r_regionkey AS gene_id, coalesce(list(s_suppkey ORDER BY n_nationkey, s_suppkey) FILTER (s_suppkey IS NOT NULL), []) AS compounds
    FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY r_regionkey"""
)
def two_hop_lists(s: SparkSession, d: str) -> DataFrame:
    first = t(s, d, "nation").select(F.col("n_regionkey").alias("gene_id"), F.col("n_nationkey").alias("aid"))
    return clusters.two_hop(t(s, d, "region").select(F.col("r_regionkey").alias("gene_id")), first, t(s, d, "supplier").select(F.col("s_nationkey").alias("aid"), F.col("s_suppkey").alias("cid")))


_LABELS = "(SELECT DISTINCT item_id, cluster_id, representative FROM cluster_labels WHERE cluster_id IS NOT NULL AND cluster_id <> -1)"


@query(f"SELECT a.cluster_id + 1 AS cluster_number, a.representative, b.item_id AS member FROM (SELECT DISTINCT cluster_id, representative FROM {_LABELS}) a JOIN {_LABELS} b ON a.cluster_id = b.cluster_id")
def cluster_cross(s: SparkSession, d: str) -> DataFrame:
    """Representatives with all members of their cluster (clusters hold a handful of ligands)."""
    rows = t(s, d, "cluster_labels").where("cluster_id IS NOT NULL AND cluster_id <> -1").distinct()
    lists = rows.groupBy(F.col("cluster_id").alias("cluster_no")).agg(F.collect_set("representative").alias("representatives"), F.collect_list("item_id").alias("members"))
    return clusters.representatives_by_members(lists)


@query(f"SELECT cluster_id, representative, list_sort(list(item_id)) AS members FROM {_LABELS} GROUP BY ALL")
def cluster_members(s: SparkSession, d: str) -> DataFrame:
    rows = t(s, d, "cluster_labels").where("cluster_id IS NOT NULL AND cluster_id <> -1").distinct()
    return similarity.clusters_with_members(rows.withColumnRenamed("item_id", "item"))


@query("SELECT c_custkey, c_nationkey, c_mktsegment, n - 1 AS n_peers FROM (SELECT *, count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) AS n FROM customer)")
def shared_cluster(s: SparkSession, d: str) -> DataFrame:
    return clusters.sharing_cluster(t(s, d, "customer"), "c_custkey", ["c_nationkey", "c_mktsegment"])


@query("SELECT cid, min(measurement_id) AS measurement_id, arg_min(aid, measurement_id) AS aid FROM measurements WHERE cid IS NOT NULL GROUP BY cid")
def first_match(s: SparkSession, d: str) -> DataFrame:
    rows = t(s, d, "measurements").where("cid IS NOT NULL").select("cid", "measurement_id", "aid")
    return ranking.last_wins(rows, ["cid"], -F.col("measurement_id"))


@query(
    """SELECT 'union' AS op, k FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) UNION ALL
    SELECT 'intersect', k FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL
    SELECT 'except', k FROM (SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier)"""
)
def set_ops(s: SparkSession, d: str) -> DataFrame:
    c, p, n = (t(s, d, x).select(F.col(k).alias("k")) for x, k in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey")))
    parts = {"union": c.unionByName(p), "intersect": c.intersect(p), "except": n.subtract(p)}
    out = [df.select(F.lit(op).alias("op"), "k") for op, df in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT gene AS key_value, count(*) AS n FROM (SELECT try_cast(nullif(regexp_extract(trim(target_geneid), '([0-9]+)(\\.0*)?$', 1), '') AS BIGINT) AS gene FROM measurements) WHERE gene IN (SELECT CAST(target_geneid AS BIGINT) FROM targets) GROUP BY gene")
def gene_counts(s: SparkSession, d: str) -> DataFrame:
    """Rows per listed gene, whatever the spelling of its number."""
    rows = heavy_keys.long_keys(t(s, d, "measurements"), ["target_geneid"])
    genes = t(s, d, "targets").select(F.col("target_geneid").try_cast("bigint").alias("key_value"))
    return rows.groupBy("key_value").agg(F.count("*").alias("n")).join(genes, "key_value", "left_semi")


# ---------------------------------------------------------------- functions
@query(
    """SELECT p_partkey, round(-1.98721e-3::DOUBLE * 300.0::DOUBLE * ln(10.0::DOUBLE) * (p_size / 10.0::DOUBLE), 6) AS delta_g, round(pow(10.0::DOUBLE, -(p_size / 10.0::DOUBLE)) * 1e6::DOUBLE, 6) AS kd_um,
    round(-log10(p_retailprice / 1e9::DOUBLE), 6) AS p_activity FROM part"""
)
def unit_math(s: SparkSession, d: str) -> DataFrame:
    pk = F.col("p_size") / F.lit(10.0)
    return t(s, d, "part").select("p_partkey", F.round(aff.to_delta_g(pk), 6).alias("delta_g"), F.round(aff.to_kd(pk, "uM"), 6).alias("kd_um"), F.round(aff.to_p_activity("p_retailprice", "nM"), 6).alias("p_activity"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_fields(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("SELECT target_geneid AS gene, gene_symbol AS symbol, CAST(seq_length AS VARCHAR) AS length FROM targets")
def json_table(s: SparkSession, d: str) -> DataFrame:
    """Concise JSON documents, one per kind of protein, built and read again."""
    cells = F.array("target_geneid", "gene_symbol", F.col("seq_length").cast("string"))
    docs = t(s, d, "targets").groupBy("protein_kind").agg(F.collect_list(F.struct(cells.alias("Cell"))).alias("rows"))
    columns = F.struct(F.array(F.lit("gene"), F.lit("symbol"), F.lit("length")).alias("Column"))
    doc = F.to_json(F.struct(F.struct(columns.alias("Columns"), F.col("rows").alias("Row")).alias("Table")))
    got = json_docs.concise_records(docs.select(doc.alias("doc")))
    return got.select(*(json_docs.cell("cells", c).alias(c) for c in ("gene", "symbol", "length")))


@query("SELECT cid, XLogP, MolecularWeight, InChIKey FROM compounds")
def json_properties(s: SparkSession, d: str) -> DataFrame:
    """Property tables as JSON, one per row, read into typed rows."""
    p = F.struct(F.col("cid").alias("CID"), "XLogP", "MolecularWeight", "InChIKey")
    docs = t(s, d, "compounds").select(F.to_json(F.struct(F.struct(F.array(p).alias("Properties")).alias("PropertyTable"))).alias("doc"))
    return json_docs.property_rows(docs, ["XLogP", "MolecularWeight", "InChIKey"])


@query("SELECT doc_id, CAST(len(string_split(coalesce(text, ''), ' ')) AS INTEGER) AS n_tokens, CAST(len(list_distinct(string_split(coalesce(text, ''), ' '))) AS INTEGER) AS n_distinct FROM documents")
def token_stats(s: SparkSession, d: str) -> DataFrame:
    words = F.split(F.coalesce("text", F.lit("")), " ", -1)
    return t(s, d, "documents").select("doc_id", F.size(words).alias("n_tokens"), F.size(F.array_distinct(words)).alias("n_distinct"))


@query(
    f"""SELECT cluster_id, CAST(len(m) AS INTEGER) AS n_members, len(list_filter(m, lambda x: starts_with(x, '7'))) > 0 AS any_compound, len(list_filter(m, lambda x: starts_with(x, '7'))) = len(m) AS all_compounds
    FROM (SELECT cluster_id, list(item_id) AS m FROM {_LABELS} GROUP BY cluster_id)"""
)
def array_predicates(s: SparkSession, d: str) -> DataFrame:
    rows = t(s, d, "cluster_labels").where("cluster_id IS NOT NULL AND cluster_id <> -1").distinct().groupBy("cluster_id").agg(F.collect_list("item_id").alias("m"))
    return rows.select("cluster_id", F.size("m").alias("n_members"), F.exists("m", lambda x: x.startswith("7")).alias("any_compound"), F.forall("m", lambda x: x.startswith("7")).alias("all_compounds"))


@query("SELECT c_custkey AS \"customer.key\", c_name AS \"customer.name\", n_name AS \"customer.nation.name\", n_regionkey AS \"customer.nation.region\" FROM customer JOIN nation ON c_nationkey = n_nationkey")
def struct_flatten(s: SparkSession, d: str) -> DataFrame:
    n = t(s, d, "nation")
    rows = t(s, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    nation = F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")).alias("nation")
    return parquet_store.flatten(rows.select(F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), nation).alias("customer")))


# --------------------------------------------------------------------- text
@query("SELECT source_file, CAST(chunk AS INTEGER) AS chunk, count(*) AS n FROM (SELECT source_file, (row_number() OVER (PARTITION BY source_file ORDER BY line_no, line_id) - 1) // 50 + 1 AS chunk FROM pqr_lines) GROUP BY ALL")
def line_chunks(s: SparkSession, d: str) -> DataFrame:
    rows = t(s, d, "pqr_lines").withColumn("o", F.struct("line_no", "line_id"))
    return tables.line_chunks(rows, "source_file", "o", 50).groupBy("source_file", "chunk").agg(F.count("*").alias("n"))


@query("SELECT doc_id, regexp_replace(l, '^>+|\\s+$', '', 'g') AS header FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) WHERE starts_with(l, '>')")
def sequence_headers(s: SparkSession, d: str) -> DataFrame:
    lines = t(s, d, "documents").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("value"))
    return tables.fasta_headers(lines, keep=["doc_id"])


@query("SELECT SMILES || ' ' || cid || '_' || cache_part AS value FROM compounds WHERE SMILES IS NOT NULL AND SMILES <> '' AND cache_part IS NOT NULL")
def smiles_lines(s: SparkSession, d: str) -> DataFrame:
    return tables.smiles_lines(t(s, d, "compounds"), "SMILES", "cid", "cache_part")


_TRIMMED = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


@query(
    f"""SELECT pose_id, {_TRIMMED.format("coalesce(ligand_id, '')")} AS ligand_id, UniqueID, {_TRIMMED.format("coalesce(SMILES, '')")} AS SMILES, coalesce(n_atoms, 0) AS n_atoms,
    coalesce(CNNscore, 'nan'::DOUBLE) AS CNNscore, coalesce(Energy, 'nan'::DOUBLE) AS Energy FROM poses WHERE UniqueID IS NOT NULL"""
)
def block_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """Poses rendered as multi-record text per file, split and parsed again."""
    p = t(s, d, "poses").where("UniqueID IS NOT NULL")

    def prop(name: str, c: str) -> list:
        return [F.lit(f"> <{name}>\n"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("\n\n")]

    # the title carries the pose's key before the ligand, so that no record is blank
    title = F.concat(F.col("pose_id").cast("string"), F.lit("|"), F.coalesce("ligand_id", F.lit("")))
    body = [title, F.lit("\n\n\n"), F.lpad(F.coalesce(F.col("n_atoms"), F.lit(0)).cast("string"), 3, " "), F.lit(" 37  0  V2000\nM  END\n")]
    for name, c in (("UniqueID", "UniqueID"), ("SMILES", "SMILES"), ("CNNscore", "CNNscore"), ("Energy", "Energy")):
        body += prop(name, c)
    blocks = p.select("source_file", F.col("pose_id").alias("block_start"), F.concat(*body).alias("block"))
    got = sdf.poses_of(sdf.split_blocks(sdf.render_file(blocks)))
    key = F.substring_index("ligand_id", "|", 1).cast("bigint")
    ligand = F.regexp_replace("ligand_id", r"^\d+\|\s*", "")
    return got.select(key.alias("pose_id"), ligand.alias("ligand_id"), "UniqueID", "SMILES", "n_atoms", "CNNscore", "Energy")


# ---------------------------------------------------- similarity, geometry
_BITS = "(SELECT vec_id, list_filter(range(0, len(embedding)), lambda i: embedding[i + 1] > 0) AS s FROM embeddings)"


def _bits(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "embeddings").select(F.col("vec_id").alias("item"), aff.on_bits("embedding").alias("bits"), "label")


@query(f"SELECT vec_id AS item, CAST(s AS INTEGER[]) AS bits FROM {_BITS}")
def bits_from_vector(s: SparkSession, d: str) -> DataFrame:
    return _bits(s, d).select("item", "bits")


_EDGES = f"SELECT a.vec_id AS i, b.vec_id AS j, len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))) AS sim FROM {_BITS} a JOIN {_BITS} b ON b.vec_id < a.vec_id"


@query(f"SELECT i, j, sim FROM ({_EDGES}) WHERE 1.0::DOUBLE - sim <= 0.5::DOUBLE")
def tanimoto_edges(s: SparkSession, d: str) -> DataFrame:
    return similarity.tanimoto_edges(_bits(s, d), 0.5)


@query(
    f"""WITH RECURSIVE f AS {_BITS},
    e AS (SELECT a.vec_id AS i, b.vec_id AS j FROM f a JOIN f b ON a.vec_id <> b.vec_id WHERE 1.0::DOUBLE - len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))) <= 0.5::DOUBLE),
    p AS (SELECT f.vec_id AS id, count(e.j) AS d, coalesce(list(e.j) FILTER (WHERE e.j IS NOT NULL), []) AS nb FROM f LEFT JOIN e ON e.i = f.vec_id GROUP BY 1),
    o AS (SELECT *, row_number() OVER (ORDER BY d DESC, id DESC) AS rn FROM p),
    r AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS seen, -1::BIGINT AS cen UNION ALL
      SELECT k + 1, CASE WHEN list_contains(seen, o.id) THEN seen ELSE list_concat(seen, list_append(o.nb, o.id)) END, CASE WHEN list_contains(seen, o.id) THEN -1 ELSE o.id END FROM r JOIN o ON o.rn = r.k + 1),
    c AS (SELECT cen, row_number() OVER (ORDER BY k) - 1 AS cid FROM r WHERE cen >= 0)
    SELECT o.id AS item, min(c.cid) AS cluster_id, arg_min(c.cen, c.cid) AS representative FROM o JOIN c ON c.cen = o.id OR list_contains(o.nb, c.cen) GROUP BY 1"""
)
def butina_clusters(s: SparkSession, d: str) -> DataFrame:
    items = _bits(s, d)
    return similarity.butina(items, similarity.tanimoto_edges(items, 0.5)).select("item", "cluster_id", "representative")


@query(
    f"""WITH RECURSIVE f AS (SELECT vec_id, label, list_filter(range(0, len(embedding)), lambda i: embedding[i + 1] > 0) AS s FROM embeddings),
    e AS (SELECT a.vec_id AS i, b.vec_id AS j FROM f a JOIN f b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE 1.0::DOUBLE - len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))) <= 0.5::DOUBLE),
    p AS (SELECT f.vec_id AS id, f.label, count(e.j) AS d, coalesce(list(e.j) FILTER (WHERE e.j IS NOT NULL), []) AS nb FROM f LEFT JOIN e ON e.i = f.vec_id GROUP BY 1, 2),
    o AS (SELECT *, row_number() OVER (ORDER BY d DESC, id DESC) AS rn FROM p),
    r AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS seen, -1::BIGINT AS cen UNION ALL
      SELECT k + 1, CASE WHEN list_contains(seen, o.id) THEN seen ELSE list_concat(seen, list_append(o.nb, o.id)) END, CASE WHEN list_contains(seen, o.id) THEN -1 ELSE o.id END FROM r JOIN o ON o.rn = r.k + 1),
    c AS (SELECT cen, row_number() OVER (PARTITION BY o.label ORDER BY k) AS cid FROM r JOIN o ON o.id = r.cen WHERE cen >= 0)
    SELECT o.label, o.id AS item, min(c.cid) AS cluster_id FROM o JOIN c ON c.cen = o.id OR list_contains(o.nb, c.cen) GROUP BY 1, 2"""
)
def group_clusters(s: SparkSession, d: str) -> DataFrame:
    """Butina within each label."""
    return similarity.cluster_groups(_bits(s, d), "label", "item", "bits", 0.5)


@query(
    """SELECT a.vec_id AS group_id, round(sqrt(avg(pow(ax - bx, 2) + pow(ay - b_y, 2) + pow(az - bz, 2))), 6) AS rmsd, count(*) AS n_atoms FROM
    (SELECT vec_id, unnest(range(0, 21)) AS k, embedding[3 * k + 1]::DOUBLE AS ax, embedding[3 * k + 2]::DOUBLE AS ay, embedding[3 * k + 3]::DOUBLE AS az FROM embeddings) a JOIN
    (SELECT vec_id, unnest(range(0, 21)) AS k, embedding[3 * k + 1]::DOUBLE AS bx, embedding[3 * k + 2]::DOUBLE AS b_y, embedding[3 * k + 3]::DOUBLE AS bz FROM embeddings) b
    ON b.vec_id = a.vec_id + 1 AND a.k = b.k GROUP BY 1"""
)
def rmsd_in_place(s: SparkSession, d: str) -> DataFrame:
    """Each vector as 21 points against the next one."""
    pts = t(s, d, "embeddings").select("vec_id", F.posexplode(F.sequence(F.lit(0), F.lit(20))).alias("p", "atom"), "embedding").drop("p")
    xyz = [F.element_at("embedding", 3 * F.col("atom") + i).cast("double").alias(c) for i, c in enumerate("xyz", 1)]
    a = pts.select(F.col("vec_id").alias("group_id"), "atom", *xyz)
    b = pts.select((F.col("vec_id") - 1).alias("group_id"), "atom", *xyz)
    both = a.join(b.select("group_id").distinct(), "group_id", "left_semi"), b.join(a.select("group_id").distinct(), "group_id", "left_semi")
    return structures.rmsd_in_place(*both, ["group_id"]).select("group_id", F.round("rmsd", 6).alias("rmsd"), "n_atoms")


_P = "(SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)"


@query(f"SELECT a.vec_id AS a, b.vec_id AS b FROM {_P} a JOIN {_P} b ON a.vec_id < b.vec_id AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) <= 0.0025::DOUBLE + 1e-12::DOUBLE")
def near_pairs(s: SparkSession, d: str) -> DataFrame:
    """Points at most 0.05 apart, by a grid join."""
    p = t(s, d, "embeddings").select("vec_id", *(F.element_at("embedding", i).cast("double").alias(c) for i, c in enumerate("xyz", 1)))
    return structures.within(p, p, 0.05).where("a_vec_id < b_vec_id").select(F.col("a_vec_id").alias("a"), F.col("b_vec_id").alias("b"))


@query(
    """SELECT event_id, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INTEGER) AS run FROM
    (SELECT event_id, user_id, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AND row_number() OVER (PARTITION BY user_id ORDER BY event_id) > 1 THEN 0 ELSE 1 END AS c FROM events)"""
)
def run_blocks(s: SparkSession, d: str) -> DataFrame:
    return structures.runs(t(s, d, "events"), "user_id", "event_id", ["event_type"]).select("event_id", "run")


_ATOM_INT = r"CASE WHEN regexp_matches({0}, '^[+-]?[0-9]+$') THEN try_cast({0} AS BIGINT) END"


def _part(first: int, past: int) -> str:
    return f"trim(substr(line, {first + 1}, {past - first}))"


@query(
    f"""SELECT line_id, {_part(0, 6)} AS record, {_ATOM_INT.format(_part(6, 11))} AS serial, {_part(12, 16)} AS name, {_part(17, 20)} AS resname, substr(line, 22, 1) AS chain,
    {_ATOM_INT.format(_part(22, 26))} AS resseq, {_part(26, 27)} AS icode, try_cast({_part(30, 38)} AS DOUBLE) AS x, try_cast({_part(38, 46)} AS DOUBLE) AS y, try_cast({_part(46, 54)} AS DOUBLE) AS z,
    CASE WHEN {_part(76, 78)} <> '' THEN upper({_part(76, 78)}) ELSE substr(regexp_replace({_part(12, 16)}, '[^A-Za-z]', '', 'g'), 1, 1) END AS element
    FROM pqr_lines WHERE (starts_with(line, 'ATOM') OR starts_with(line, 'HETATM')) AND length(line) > 26"""
)
def atom_columns(s: SparkSession, d: str) -> DataFrame:
    """Atom lines by fixed columns."""
    return structures.fixed_columns(t(s, d, "pqr_lines").select("line_id", "line"))


# ------------------------------------------------------ membership and titles
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_FLAGS = """SELECT cid, bool_or(hit AND affinity > 0 AND type IN {types} AND NOT blocked) AS usable, bool_or(hit) AS known, bool_or(high) AND NOT bool_or(fine) AS excluded
    FROM (SELECT *, bool_or(high) OVER {w} AND NOT bool_or(fine) OVER {w} AS blocked FROM ({rows})) GROUP BY cid"""
_EVENT_ROWS = f"""SELECT event_id, user_id AS cid, {_K} % 25 IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) AS hit, value - 20 AS affinity, event_type AS type,
    {_K} % 13 > 10 AS high, {_K} % 13 <= 10 AS fine FROM events WHERE user_id IS NOT NULL"""


def _event_flags(s: SparkSession, d: str, order: str | None) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    rows = t(s, d, "events").select(
        "event_id", F.col("user_id").alias("cid"), (k % 25).alias("gene_id"), (F.col("value") - 20).alias("affinity"), F.col("event_type").alias("type"), (k % 13).cast("int").alias("rotatable_bonds")
    )
    genes = t(s, d, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("gene_id"))
    return assays.membership_flags(rows, genes, 10, ("purchase", "view"), order)


@query(_FLAGS.format(types="('purchase', 'view')", w="(PARTITION BY cid)", rows=_EVENT_ROWS))
def eligibility_sets(s: SparkSession, d: str) -> DataFrame:
    """Flags per key from all its rows."""
    return _event_flags(s, d, None)


@query(_FLAGS.format(types="('purchase', 'view')", w="(PARTITION BY cid ORDER BY event_id ROWS UNBOUNDED PRECEDING)", rows=_EVENT_ROWS))
def eligibility_running(s: SparkSession, d: str) -> DataFrame:
    """Flags per key, where the bond test sees the rows up to the current one only."""
    return _event_flags(s, d, "event_id")


_READING_ROWS = f"""SELECT cid, coalesce(trim(target_geneid) IN (SELECT target_geneid FROM targets WHERE protein_kind = 'kinase'), false) AS hit, {_VALUE} AS affinity, activity_name AS type,
    measurement_id % 14 > 10 AS high, measurement_id % 14 <= 10 AS fine FROM measurements WHERE cid IS NOT NULL"""


@query(
    f"""WITH f AS ({_FLAGS.format(types="('IC50', 'Ki', 'Kd', 'EC50')", w="(PARTITION BY cid)", rows=_READING_ROWS)}),
    b AS (SELECT pose_id, ligand_id AS title, coalesce(regexp_matches(ligand_id, '^[A-Za-z0-9]{{3}}_[A-Za-z0-9]{{4}}(?:_copy_\\d+)?$'), false) AS structure FROM poses),
    r AS (SELECT CASE WHEN structure THEN 'kept_structure' WHEN coalesce(f.usable, false) THEN 'kept_affinity' WHEN coalesce(f.known, false) THEN 'drop_known' ELSE 'drop_unknown' END AS reason
      FROM b LEFT JOIN f ON NOT structure AND CAST(f.cid AS VARCHAR) = string_split(title, '_')[1])
    SELECT count(*) AS total, count(*) FILTER (starts_with(reason, 'kept')) AS kept, count(*) FILTER (NOT starts_with(reason, 'kept')) AS dropped,
    count(*) FILTER (starts_with(reason, 'kept')) / greatest(count(*), 1) AS kept_share FROM r"""
)
def keep_drop_counters(s: SparkSession, d: str) -> DataFrame:
    """Poses kept and dropped by what is known of their ligand."""
    rows = t(s, d, "measurements").select(
        "cid", F.trim("target_geneid").alias("gene_id"), lenient_double("activity_value").alias("affinity"), F.col("activity_name").alias("type"), (F.col("measurement_id") % 14).cast("int").alias("rotatable_bonds")
    )
    genes = t(s, d, "targets").where("protein_kind = 'kinase'").select(F.col("target_geneid").alias("gene_id"))
    flags = assays.membership_flags(rows, genes, 10, ("IC50", "Ki", "Kd", "EC50"))
    return assays.counters(assays.keep_reasons(t(s, d, "poses").select("pose_id", F.col("ligand_id").alias("title")), flags))


@query("SELECT vec_id, CAST(k AS INTEGER) AS atom, " + ", ".join(f"CAST(format('{{:.4f}}', embedding[3 * k + {i}]::DOUBLE) AS DOUBLE) AS {c}" for i, c in enumerate("xyz", 1)) + " FROM (SELECT vec_id, embedding, unnest(range(0, 21)) AS k FROM embeddings)")
def coords_explode(s: SparkSession, d: str) -> DataFrame:
    """Each vector as a block of 21 atom lines, of which the coordinates are read."""
    lines = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda k: F.concat_ws(" ", *(F.format_string("%.4f", F.element_at("embedding", (3 * k + i).cast("int")).cast("double")) for i in (1, 2, 3)), F.lit("C")))
    block = F.concat(F.lit("title\n\n\n 21  0  0  V2000\n"), F.array_join(lines, "\n"), F.lit("\nM  END\n"))
    blocks = t(s, d, "embeddings").select("vec_id", block.alias("block"))
    return blocks.select("vec_id", F.posexplode(sdf.coordinates("block")).alias("atom", "p")).select("vec_id", "atom", "p.x", "p.y", "p.z")


@query(
    f"""SELECT DISTINCT source_file, {_part(17, 20)} AS resname FROM pqr_lines WHERE starts_with(line, 'HETATM') AND {_part(0, 6)} = 'HETATM' AND length(line) > 26 AND length({_part(17, 20)}) = 3
    AND {_part(17, 20)} NOT IN ('GOL', 'EDO', 'SO4', {", ".join(f"'{w}'" for w in WATERS)})"""
)
def impurity_antijoin(s: SparkSession, d: str) -> DataFrame:
    """Names of hetero residues that are neither water nor a listed impurity."""
    atoms = structures.fixed_columns(t(s, d, "pqr_lines").select("source_file", "line"))
    return structures.ligand_names(atoms, ("GOL", "EDO", "SO4"))


# -------------------------------------------------------- batches and limits
@query(
    """SELECT protein_id, batch, 'bt_' || batch || '_' || min(protein_id) OVER (PARTITION BY batch) || '_' || max(protein_id) OVER (PARTITION BY batch) || '.parquet' AS file_name FROM
    (SELECT protein_id, (row_number() OVER (ORDER BY protein_id) - 1) // 200 AS batch FROM (SELECT DISTINCT protein_id FROM poses WHERE protein_id IS NOT NULL))"""
)
def batch_assign(s: SparkSession, d: str) -> DataFrame:
    return poses.protein_batches(t(s, d, "poses"), 200)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 500 OFFSET 100")
def slice_rows(s: SparkSession, d: str) -> DataFrame:
    return poses.row_slice(t(s, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 100, 600)


@query("SELECT protein_id, count(*) AS n FROM poses GROUP BY protein_id")
def dataset_stats(s: SparkSession, d: str) -> DataFrame:
    """Poses written by protein and counted from the partitions."""
    path = fresh_path(s, "poses-by-protein")
    rows = t(s, d, "poses").select("protein_id", "pose_id").withColumn("protein", F.col("protein_id"))
    poses.write_by_protein(rows, path)
    back = s.read.parquet(path)
    return back.groupBy(F.col("protein").alias("protein_id")).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- streaming
@query("SELECT CAST(date_trunc('day', loaded_at) AS TIMESTAMP) AS day, depositor, count(*) AS n FROM measurements GROUP BY ALL")
def stream_day_counts(s: SparkSession, d: str) -> DataFrame:
    """Rows per day of arrival and depositor, by a stream over the table's files."""
    path = f"{d}/measurements.parquet"
    schema = s.read.parquet(path).schema
    target, checkpoint = fresh_path(s, "days"), fresh_path(s, "days-checkpoint")
    stream = s.readStream.schema(schema).parquet(f"{path}*").select("loaded_at", "depositor")
    counted = ingest.late_counts(stream, "loaded_at", "depositor", "30 days")

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    q = counted.writeStream.outputMode("complete").foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return s.read.parquet(target).select(F.col("window.start").cast("timestamp_ntz").alias("day"), "depositor", "n")
