"""Table-driven validation of settings: kinds, ranges, choices, rules across fields."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from millrace.config.tree import ConfigTree


@dataclass(frozen=True)
class Rule:
    """What one setting may be."""

    kind: type | tuple[type, ...]
    least: float | None = None
    most: float | None = None
    choices: Sequence[Any] = ()
    needed: bool = False
    each: bool = False

    def problem(self, value: Any) -> str | None:
        if value is None:
            return "is missing" if self.needed else None
        if self.each:
            if not isinstance(value, list):
                return "must be a list"
            return next((p for v in value if (p := Rule(self.kind, self.least, self.most, self.choices).problem(v))), None)
        kinds = self.kind if isinstance(self.kind, tuple) else (self.kind,)
        if isinstance(value, bool) and bool not in kinds or not isinstance(value, (*kinds, int) if float in kinds else kinds):
            return f"must be {' or '.join(k.__name__ for k in kinds)}"
        if self.choices and value not in self.choices:
            return f"must be one of {list(self.choices)}"
        if self.least is not None and value < self.least:
            return f"must be at least {self.least}"
        if self.most is not None and value > self.most:
            return f"must be at most {self.most}"
        return None


@dataclass
class Settings:
    """A tree with a table of rules and of checks across fields; ``problems`` lists all that is wrong."""

    rules: Mapping[str, Rule]
    checks: Sequence[Callable[[dict[str, Any]], str | None]] = ()
    defaults: dict[str, Any] = field(default_factory=dict)
    open_: bool = False

    def problems(self, data: dict[str, Any]) -> list[str]:
        tree = ConfigTree(data, self.defaults)
        flat = dict(tree.leaves())
        out = [f"{k} {p}" for k, rule in self.rules.items() if (p := rule.problem(flat.get(k)))]
        if not self.open_:
            out += [f"{k} is unknown" for k in flat if k not in self.rules]
        return out + [p for check in self.checks if (p := check(flat))]

    def tree(self, data: dict[str, Any]) -> ConfigTree:
        bad = self.problems(data)
        if bad:
            raise ValueError("; ".join(bad))
        return ConfigTree(data, self.defaults)


def _box(flat: dict[str, Any]) -> str | None:
    given = [k for k in ("center_x", "center_y", "center_z", "size_x", "size_y", "size_z") if flat.get(k) is not None]
    if flat.get("autobox_ligand") and given:
        return "autobox_ligand and a box exclude each other"
    return "a box needs centre and size in all directions" if 0 < len(given) < 6 else None


def _ph(flat: dict[str, Any]) -> str | None:
    lo, hi = flat.get("min_ph"), flat.get("max_ph")
    return "min_ph must not exceed max_ph" if lo is not None and hi is not None and lo > hi else None


#: Names that the docking program knows.
SCORINGS = ("ad4_scoring", "default", "dkoes_fast", "dkoes_scoring", "dkoes_scoring_old", "vina", "vinardo")
CNN_MODES = ("none", "rescore", "refinement", "metrorescore", "metrorefine", "all")

DOCKING = Settings(
    {
        "receptor": Rule(str),
        "ligand": Rule(str),
        "out": Rule(str),
        "scoring": Rule(str, choices=SCORINGS),
        "cnn_scoring": Rule(str, choices=CNN_MODES),
        "cnn": Rule(str),
        "autobox_ligand": Rule(str),
        "autobox_add": Rule(float, least=0),
        **{f"{p}_{a}": Rule(float, least=0 if p == "size" else None) for p in ("center", "size") for a in "xyz"},
        "exhaustiveness": Rule(int, least=1),
        "num_modes": Rule(int, least=1),
        "min_rmsd_filter": Rule(float, least=0),
        "energy_range": Rule(float, least=0),
        "cpu": Rule(int, least=1),
        "seed": Rule(int),
        "device": Rule(int, least=0),
        "no_gpu": Rule(bool),
    },
    (_box,),
    {"num_modes": 9, "exhaustiveness": 8},
)
LIGAND_PREPARATION = Settings(
    {
        "source": Rule(str),
        "output_folder": Rule(str),
        "num_processors": Rule(int, least=-1),
        "max_variants_per_compound": Rule(int, least=1),
        "thoroughness": Rule(int, least=1),
        "min_ph": Rule(float, least=0, most=14),
        "max_ph": Rule(float, least=0, most=14),
        "pka_precision": Rule(float, least=0),
        "job_manager": Rule(str, choices=("mpi", "multiprocessing", "serial")),
        "separate_output_files": Rule(bool),
        "add_pdb_output": Rule(bool),
        "skip_optimize_geometry": Rule(bool),
    },
    (_ph,),
)
PROTONATION = Settings(
    {
        "ff": Rule(str, choices=("AMBER", "CHARMM", "PARSE", "TYL06", "PEOEPB", "SWANSON")),
        "with-ph": Rule(float, least=0, most=14),
        "pH": Rule(float, least=0, most=14),
        "titration-state-method": Rule(str, choices=("propka",)),
        "keep-chain": Rule(bool),
        "drop-water": Rule(bool),
        "whitespace": Rule(bool),
        "nodebump": Rule(bool),
        "reference": Rule(str, choices=("neutral", "low-pH")),
        "chain": Rule(str),
        "log-level": Rule(str, choices=("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")),
    }
)
RECEPTOR_BOX = Settings(
    {
        "read_pdb": Rule(str),
        "output_basename": Rule(str),
        "box_size": Rule(float, least=0, each=True),
        "box_center": Rule(float, each=True),
        "padding": Rule(float, least=0),
        "charge_model": Rule(str, choices=("gasteiger", "espaloma", "zero", "read")),
        "allow_bad_res": Rule(bool),
        "default_altloc": Rule(str),
    },
    (lambda f: "box_size needs three numbers" if f.get("box_size") and len(f["box_size"]) != 3 else None,),
)
RECEPTOR_FLAGS = Settings(
    {"r": Rule(str), "o": Rule(str), "A": Rule(str, choices=("bonds_hydrogens", "bonds", "hydrogens", "checkhydrogens", "None")), "U": Rule(str), "C": Rule(bool), "e": Rule(bool), "v": Rule(bool)}
)


def vocabulary_problems(additives: Sequence[str], cofactors: Sequence[str]) -> list[str]:
    """Codes listed twice, or in both lists (these lists are parameters: pass your own vocabulary)."""
    out = [f"{name}: {c} is listed twice" for name, codes in (("additives", additives), ("cofactors", cofactors)) for c in sorted({c for c in codes if codes.count(c) > 1})]
    return out + [f"{c} is in both lists" for c in sorted(set(additives) & set(cofactors))]
