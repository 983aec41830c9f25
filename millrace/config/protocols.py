"""What plug-ins implement, and the choices between preparation tools."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from enum import StrEnum
from typing import Protocol

from pyspark.sql import DataFrame


class Docking(Protocol):
    def commands(self, pairs: DataFrame) -> DataFrame:
        """(receptor, ligand) rows with a command each."""


class Clusterer(Protocol):
    def cluster(self, items: DataFrame) -> DataFrame:
        """item, cluster_id, representative."""


class Deviation(Protocol):
    def calculate(self, pairs: DataFrame) -> DataFrame:
        """keys, rmsd."""


class Method(StrEnum):
    BUTINA = "butina"
    SEQUENCE = "sequence"


class Strategy(StrEnum):
    ALL = "all"
    MIN = "min"
    AVERAGE = "average"


class Preparation(StrEnum):
    DEFAULT = "default"
    CAPPED = "capped"
    CONFIGURED = "configured"


@dataclass(frozen=True)
class ButinaClusters:
    """The Clusterer of the core: Tanimoto edges at a cutoff, then Butina."""

    cutoff: float = 0.7
    start: int = 0
    params: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not 0 < self.cutoff <= 1:
            raise ValueError("cutoff must lie in (0, 1]")

    def cluster(self, items: DataFrame) -> DataFrame:
        from millrace.operators.similarity import butina, tanimoto_edges

        return butina(items, tanimoto_edges(items, self.cutoff), self.start)


def preparation_of(has_caps: bool, configured: bool) -> Preparation:
    """A user's settings go first; capped chains need the plain structure; else the default way without HETATM lines."""
    if configured:
        return Preparation.CONFIGURED
    return Preparation.CAPPED if has_caps else Preparation.DEFAULT


def sequence_cluster_command(fasta: str, out: str, tmp: str, identity: float = 0.9, coverage_mode: int = 0, sensitivity: float = 7.0, program: str = "mmseqs") -> list[str]:
    """Words of a sequence clustering run."""
    if not 0 <= identity <= 1:
        raise ValueError("identity must lie in [0, 1]")
    if coverage_mode not in (0, 1, 2, 3):
        raise ValueError("mode must be 0, 1, 2 or 3")
    return [program, "easy-cluster", fasta, out, tmp, "--min-seq-id", str(identity), "--cov-mode", str(coverage_mode), "-s", str(sensitivity)]


def numbered_outputs(files: Sequence[str]) -> list[str]:
    """One output name per ligand file."""
    return [f.removesuffix(".gz").rsplit(".", 1)[0] + "_docked.sdf.gz" for f in files]
