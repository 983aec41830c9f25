"""Sinks whose files have names of their own: one file per name, published by renames."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.poses import protein_batches
from millrace.session import fresh_path
from millrace.sources.tables import line_chunks


def write_named(df: DataFrame, path: str, name: str, order: Sequence[str] = (), kind: str = "text", mode: str = "error", dropped: Sequence[str] = (), **options: str) -> int:
    """The rows of each ``name`` as one file ``path/name``, in the given order; the number of files.

    The column ``name`` and those of ``dropped`` are not written.  Rows with a NULL or empty name are
    refused.  Files are written to a staging folder first and appear under their
    names by renames, so a task that is repeated leaves nothing behind.  An
    existing file is an error, or with ``mode`` ``skip`` it stays as it is.  Only
    names and no rows come to the driver.
    """
    if mode not in ("error", "skip"):
        raise ValueError("mode is error or skip")
    if df.where(F.col(name).isNull() | (F.col(name) == "")).take(1):
        raise ValueError("a file needs a name")
    spark, staging = df.sparkSession, fresh_path(df.sparkSession, "named")
    rows = df.withColumn("__name", F.col(name)).drop(name).repartition("__name").sortWithinPartitions("__name", *order).drop(*dropped)
    rows.write.partitionBy("__name").format(kind).options(**options).save(staging)
    jvm = spark.sparkContext._jvm
    place, base = jvm.org.apache.hadoop.fs.Path, path.rstrip("/")
    source = place(staging)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(place(base))
    files, n = fs.listFiles(source, True), 0
    while files.hasNext():
        at = files.next().getPath()
        folder = at.getParent().getName()
        if not folder.startswith("__name=") or at.getName().startswith(("_", ".")):
            continue
        to = place(f"{base}/{unquote(folder.removeprefix('__name='))}")
        if fs.exists(to):
            if mode == "skip":
                continue
            raise FileExistsError(str(to))
        fs.mkdirs(to.getParent())
        if not fs.rename(at, to):
            raise OSError(f"{at} can't be renamed to {to}")
        n += 1
    fs.delete(source, True)
    return n


def file_stem(path: Column | str) -> Column:
    """The file's name without folders and its last suffix (``.gz`` goes too)."""
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(F.regexp_extract(c, r"([^/]+)$", 1), r"\.[^.]*?(?:\.gz)?$", "")


def write_filtered_sdf(blocks: DataFrame, path: str, keep: Column, suffix: str = "_filtered.sdf") -> int:
    """The kept records of each source file as a file of its own; a file of which nothing is kept is not written."""
    name = F.concat(file_stem("source_file"), F.lit(suffix))
    kept = blocks.where(keep).select(name.alias("name"), "block_start", F.concat("block", F.lit("\n$$$$")).alias("value"))
    return write_named(kept, path, "name", ["block_start"], dropped=["block_start"])


def write_chunks(lines: DataFrame, path: str, size: int = 250, file: str = "source_file", order: str = "line_no", line: str = "line", suffix: str = ".smi") -> int:
    """Lines in files of at most ``size`` lines, named ``{stem}_part{k}.smi`` with k from 1."""
    chunks = line_chunks(lines, file, order, size)
    name = F.concat(file_stem(file), F.lit("_part"), F.col("chunk").cast("string"), F.lit(suffix))
    return write_named(chunks.select(name.alias("name"), F.col(order).alias("at"), F.col(line).alias("value")), path, "name", ["at"], dropped=["at"])


def write_values(values: DataFrame, path: str, name: str, order: Sequence[str], text: Column) -> int:
    """One text file per ``name``, a line for each row: RMSD values, command lists and the like."""
    rows = values.select(F.col(name).alias("name"), F.struct(*order).alias("at"), text.alias("value"))
    return write_named(rows, path, "name", ["at"], dropped=["at"])


def write_batch_files(poses: DataFrame, path: str, per_batch: int = 200, **options: str) -> int:
    """One Parquet file ``bt_{n}_{first}_{last}.parquet`` for each batch of proteins; a protein is in one batch only."""
    named = poses.join(protein_batches(poses, per_batch).select("protein_id", "file_name"), "protein_id")
    return write_named(named.select(*poses.columns, "file_name"), path, "file_name", ["protein_id"], "parquet", **options)
