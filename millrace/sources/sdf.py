"""Multi-record structure files: blocks, fields, poses, coordinates, and back to text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.nulls import int_or_zero, strip

DELIMITER = "$$$$"
_TRIM = r"^[\n\r ]+|[\n\r ]+$"
#: Score column -> field of the block.
SCORE_FIELDS = {
    "Vina_affinity": "minimizedAffinity",
    "CNNscore": "CNNscore",
    "CNNaffinity": "CNNaffinity",
    "CNN_VS": "CNN_VS",
    "CNNaffinity_variance": "CNNaffinity_variance",
    "Energy": "Energy",
}


class TruncatedFile(ValueError):
    """A file does not end with the record delimiter."""


def read_texts(spark: SparkSession, *paths: str) -> DataFrame:
    """``source_file, text``: one row per file; gzip is unpacked by its suffix."""
    return spark.read.text(list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("text"))


def docking_tree(root: str) -> str:
    """Glob of the docked files below a tree of protein folders; hidden folders do not match."""
    return f"{root}/[!.]*/gypsum_out_*/*_docked.sdf*"


def protein_of_path(path: Column) -> Column:
    """The protein folder of a docked file, else its file name up to the first ``_``."""
    folder = F.regexp_extract(path, r"([^/]+)/gypsum_out_[^/]*/[^/]+$", 1)
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.when(folder != "", folder).when(name.contains("_"), F.substring_index(name, "_", 1)).otherwise("")


def split_blocks(texts: DataFrame) -> DataFrame:
    """``source_file, block_no, block_start, block_end, block, terminated`` of every record.

    Offsets count characters from 0 and enclose the trimmed record (line feeds,
    returns and blanks go).  Empty records are left out; a NULL or empty text
    gives none.  The last record is ``terminated`` only if the delimiter follows.
    """
    parts = texts.select("source_file", F.posexplode(F.split("text", r"\$\$\$\$", -1)).alias("block_no", "raw"), F.size(F.split("text", r"\$\$\$\$", -1)).alias("n"))
    before = Window.partitionBy("source_file").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.length("raw") + len(DELIMITER)).over(before), F.lit(0)).cast("bigint")
    lead = F.length("raw") - F.length(F.regexp_replace("raw", r"^[\n\r ]+", ""))
    out = parts.withColumn("block_start", offset + lead).withColumn("block", F.regexp_replace("raw", _TRIM, ""))
    out = out.withColumn("block_end", F.col("block_start") + F.length("block")).withColumn("terminated", F.col("block_no") < F.col("n") - 1)
    return out.where(strip("block") != "").select("source_file", "block_no", "block_start", "block_end", "block", "terminated")


def truncated_files(texts: DataFrame) -> DataFrame:
    """Files that hold no record or do not end with the delimiter."""
    return texts.where(~F.coalesce(F.regexp_replace("text", r"\s+$", ""), F.lit("")).endswith(DELIMITER)).select("source_file")


def require_complete(texts: DataFrame) -> DataFrame:
    bad = truncated_files(texts).limit(5).collect()
    if bad:
        raise TruncatedFile(f"not ended by {DELIMITER}: {[r[0] for r in bad]}")
    return texts


def fields(block: Column | str = "block") -> Column:
    """Map of the ``> <name>`` fields of a record; the last of equal names counts."""
    c = F.col(block) if isinstance(block, str) else block
    pattern = F.lit(r">[^\S\n]+<([^>\n]+)>[^\n]*\n([^\n]*)")
    return F.map_from_arrays(F.regexp_extract_all(c, pattern, 1), F.transform(F.regexp_extract_all(c, pattern, 2), lambda v: strip(v)))


def atom_count(block: Column | str = "block") -> Column:
    """The atom count of the counts line, 0 where it can't be read."""
    c = F.col(block) if isinstance(block, str) else block
    line = F.get(F.split(c, "\n"), F.lit(3))
    return F.coalesce(strip(F.substring(line, 1, 3)).try_cast("int"), F.lit(0))


def resolve_modes(counts: DataFrame, keys: Sequence[str], modes: Sequence[int] | None = None) -> DataFrame:
    """``num_modes`` per group: the largest candidate that divides its count, else that of the smallest remainder.

    Candidates are ``modes`` or the distinct counts; equal remainders go to the
    larger candidate.  ``counts`` holds ``keys`` and ``n``.
    """
    if modes is not None and not modes:
        raise ValueError("no candidates")
    distinct = F.array(*(F.lit(int(m)) for m in sorted(set(modes), reverse=True))) if modes else None
    if distinct is None:
        # distinct counts of records per group: bounded by the square root of the records
        found = counts.agg(F.sort_array(F.collect_set(F.col("n").cast("int")), asc=False).alias("__modes"))
        counts, distinct = counts.crossJoin(F.broadcast(found)), F.col("__modes")
    n = F.col("n")
    whole = F.get(F.filter(distinct, lambda m: n % m == 0), F.lit(0))
    least = F.array_min(F.transform(distinct, lambda m: F.struct((n % m).alias("rest"), (-m).alias("neg"))))["neg"]
    return counts.withColumn("num_modes", F.coalesce(whole, -least).cast("int")).drop("__modes")


def number_poses(poses: DataFrame, modes: int | Sequence[int] | None = 9) -> DataFrame:
    """Adds ``conformer_idx`` and ``pose_rank``: a running number per ligand and UniqueID, in file order, by div and mod."""
    keys = ["source_file", "ligand_id", "UniqueID"]
    seq = F.row_number().over(Window.partitionBy(*keys).orderBy("block_start")) - 1
    if isinstance(modes, int):
        if modes < 1:
            raise ValueError("num_modes must be positive")
        out = poses.withColumn("num_modes", F.lit(modes))
    else:
        out = poses.join(resolve_modes(poses.groupBy(*keys).agg(F.count("*").alias("n")), keys, modes).drop("n"), keys)
    out = out.withColumn("__seq", seq)
    return out.withColumn("conformer_idx", F.expr("__seq div num_modes").cast("int")).withColumn("pose_rank", (F.col("__seq") % F.col("num_modes")).cast("int")).drop("__seq")


def poses_of(blocks: DataFrame, modes: int | Sequence[int] | None = 9, protein: Column | str | None = None) -> DataFrame:
    """The 16 pose columns of every record, and its ``block``.  Scores that can't be read are NaN, texts ""."""
    f = F.col("__f")
    protein = protein_of_path(F.col("source_file")) if protein is None else (F.lit(protein) if isinstance(protein, str) else protein)
    rows = blocks.withColumn("__f", fields()).select(
        "block_start",
        "block_end",
        protein.alias("protein_id"),
        strip(F.substring_index("block", "\n", 1)).alias("ligand_id"),
        int_or_zero(f["UniqueID"]).alias("UniqueID"),
        F.coalesce(f["SMILES"], F.lit("")).alias("SMILES"),
        atom_count().alias("n_atoms"),
        *(F.coalesce(f[src].try_cast("double"), F.lit(float("nan"))).alias(c) for c, src in SCORE_FIELDS.items()),
        "source_file",
        "block",
    )
    rows = number_poses(rows, modes).drop("num_modes")
    first = "block_start block_end protein_id ligand_id UniqueID conformer_idx pose_rank SMILES n_atoms".split()
    return rows.select(*first, *SCORE_FIELDS, "source_file", "block")


def coordinates(block: Column | str = "block") -> Column:
    """Array of ``(x, y, z, element)`` of the atom lines."""
    c = F.col(block) if isinstance(block, str) else block
    lines = F.slice(F.split(c, "\n"), F.lit(5), F.greatest(F.lit(0), atom_count(c)))
    parts = F.transform(lines, lambda s: F.split(F.trim(s), r"\s+"))
    return F.transform(
        parts,
        lambda w: F.struct(F.get(w, F.lit(0)).try_cast("double").alias("x"), F.get(w, F.lit(1)).try_cast("double").alias("y"), F.get(w, F.lit(2)).try_cast("double").alias("z"), F.get(w, F.lit(3)).alias("element")),
    )


def block_at(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Text between offsets: ``places`` holds ``source_file, block_start, block_end``."""
    cut = F.expr("substring(text, cast(block_start + 1 as int), cast(block_end - block_start as int))")
    return places.join(texts, "source_file").withColumn("block", cut).drop("text")


def render_file(blocks: DataFrame, order: str = "block_start", group: str = "source_file") -> DataFrame:
    """``group, text``: the records of each file joined by the delimiter, in order."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "block"))), lambda s: s["block"]), f"\n{DELIMITER}\n")
    return blocks.groupBy(group).agg(F.concat(joined, F.lit(f"\n{DELIMITER}\n")).alias("text"))


def write_sdf(blocks: DataFrame, path: str, mode: str = "errorifexists", codec: str | None = None) -> None:
    """Records as text, each followed by the delimiter; one task writes one file, so no record is gathered elsewhere."""
    w = blocks.select("block").write.mode(mode).option("lineSep", f"\n{DELIMITER}\n")
    (w.option("compression", codec) if codec else w).text(path)


def without_empty(blocks: DataFrame) -> DataFrame:
    """Records that hold a molecule: those whose counts line says no atoms and no bonds go."""
    return blocks.where(~F.col("block").rlike(r"(?m)^\s*0\s+0\s.*V2000"))
