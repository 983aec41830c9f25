"""Command lines of external programs as rows, and an optional runner in tasks."""

from __future__ import annotations

import shutil
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config.rules import DOCKING

RECEPTORS, LIGANDS = (".pdb", ".pdbqt"), (".sdf", ".sdf.gz", ".mol2", ".pdbqt")


def dock_command(receptor: str, ligand: str, settings: dict | None = None, program: str = "gnina") -> list[str]:
    """Words of one docking run; the output is named after the ligand."""
    if not receptor.endswith(RECEPTORS):
        raise ValueError(f"receptor {receptor!r} is none of {RECEPTORS}")
    if not ligand.endswith(LIGANDS):
        raise ValueError(f"ligand {ligand!r} is none of {LIGANDS}")
    stem = ligand.removesuffix(".gz").rsplit(".", 1)[0]
    tree = DOCKING.tree({**(settings or {}), "receptor": receptor, "ligand": ligand, "out": f"{stem}_docked.sdf.gz"})
    return [program, *(w for word in tree.words() for w in word.split(" ", 1))]


def dock_commands(pairs: DataFrame, settings: dict | None = None, program: str = "gnina") -> DataFrame:
    """``pairs`` (receptor, ligand) with ``command``: every ligand has an output of its own."""
    options = DOCKING.tree(settings or {}).words()
    stem = F.regexp_replace(F.regexp_replace("ligand", r"\.gz$", ""), r"\.[^./]*$", "")
    ok = F.col("receptor").rlike(r"\.(pdb|pdbqt)$") & F.col("ligand").rlike(r"\.(sdf|sdf\.gz|mol2|pdbqt)$")
    line = F.concat_ws(" ", F.lit(program), F.concat(F.lit("--receptor "), "receptor"), F.concat(F.lit("--ligand "), "ligand"), F.concat(F.lit("--out "), stem, F.lit("_docked.sdf.gz")), *(F.lit(o) for o in options))
    return pairs.withColumn("command", F.when(ok, line))


def run_commands(commands: DataFrame, column: str = "command") -> DataFrame:
    """Adds ``exit_code`` and ``output``; raises on the driver where the program isn't installed there."""
    first = commands.select(column).where(F.col(column).isNotNull()).take(1)
    if first and shutil.which(first[0][0].split()[0]) is None:
        raise RuntimeError(f"{first[0][0].split()[0]} is not installed")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import shlex
        import subprocess

        for b in batches:
            done = [subprocess.run(shlex.split(c), capture_output=True, text=True, check=False) if c else None for c in b[column]]
            yield b.assign(exit_code=[d.returncode if d else None for d in done], output=[d.stdout if d else None for d in done])

    from pyspark.sql import types as T

    return commands.mapInPandas(run, T.StructType([*commands.schema, T.StructField("exit_code", T.LongType()), T.StructField("output", T.StringType())]))
