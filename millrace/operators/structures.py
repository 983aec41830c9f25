"""Atom tables: fixed-column lines, selections, waters by distance, runs of residues, RMSD."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.nulls import strip
from millrace.schemas import ELECTRONEGATIVE, STANDARD_RESIDUES, WATERS


def _cut(line: Column, first: int, past: int) -> Column:
    return F.trim(F.substring(line, first + 1, past - first))


def is_atom(line: Column | str) -> Column:
    """Lines of an atom record that reach the residue number's last column."""
    c = F.col(line) if isinstance(line, str) else line
    return (c.startswith("ATOM") | c.startswith("HETATM")) & (F.length(c) > 26)


def fixed_columns(lines: DataFrame, line: str = "line") -> DataFrame:
    """Atom lines by the columns of the PDB layout; fields that don't parse are NULL."""
    c = F.col(line)
    rows = lines.where(is_atom(c))
    num = {"x": (30, 38), "y": (38, 46), "z": (46, 54)}
    name, element = _cut(c, 12, 16), F.upper(_cut(c, 76, 78))
    return rows.select(
        *(x for x in lines.columns if x != line),
        _cut(c, 0, 6).alias("record"),
        _cut(c, 6, 11).try_cast("bigint").alias("serial"),
        name.alias("name"),
        _cut(c, 17, 20).alias("resname"),
        F.substring(c, 22, 1).alias("chain"),
        _cut(c, 22, 26).try_cast("bigint").alias("resseq"),
        _cut(c, 26, 27).alias("icode"),
        *(_cut(c, a, b).try_cast("double").alias(k) for k, (a, b) in num.items()),
        F.when(element != "", element).otherwise(F.substring(F.regexp_replace(name, "[^A-Za-z]", ""), 1, 1)).alias("element"),
    )


def render_atoms(atoms: DataFrame) -> DataFrame:
    """``line``: atom rows in columns.  Coordinates shed decimals where they are too wide; every other field is padded and
    never cut, so a number of too many digits moves what follows.  Residue names stand on the right, a name of four signs
    or with a digit first begins a column earlier; NULL chains and insertion letters are blanks."""
    whole = (F.length("name") >= 4) | F.col("name").rlike("^[0-9]")
    name = F.when(whole, F.format_string("%-4s", "name")).otherwise(F.format_string(" %-3s", "name"))
    head = F.format_string("%-6s%5d %s %3s %1s%4d%1s   ", "record", "serial", name, "resname", F.coalesce("chain", F.lit(" ")), "resseq", F.coalesce("icode", F.lit(" ")))
    numbers = (fixed_number("x", 8, 3, False), fixed_number("y", 8, 3), fixed_number("z", 8, 3), fixed_number("charge", 8, 4), fixed_number("radius", 7, 4))
    return atoms.withColumn("line", F.concat(head, *numbers))


def fixed_number(c: Column | str, width: int, decimals: int, gap: bool = True) -> Column:
    """A number right-aligned in ``width``, shedding decimals until it fits with a blank before it (if ``gap``)."""
    c = F.col(c) if isinstance(c, str) else c
    room = width - 1 if gap else width
    out = F.format_string(f"%{width}.{decimals}f", c)
    tries = [F.format_string(f"%.{d}f", c) for d in range(decimals, -1, -1)]
    choice = F.when(F.length(tries[0]) <= room, F.lpad(tries[0], width, " "))
    for t in tries[1:-1]:
        choice = choice.when(F.length(t) <= room, F.lpad(t, width, " "))
    return choice.when(F.length(tries[-1]) <= width, F.lpad(tries[-1], width, " ")).otherwise(out)


# -------------------------------------------------------------- selections
def hetero(atoms: DataFrame, keep: bool = True) -> DataFrame:
    return atoms.where((F.col("record") == "HETATM") == F.lit(keep))


def chains(atoms: DataFrame, wanted: Sequence[str], per: str = "source_file") -> DataFrame:
    """Atoms of the wanted chains; a structure with one chain only is kept whole."""
    single = atoms.groupBy(per).agg((F.count_distinct("chain") == 1).alias("__single"))
    out = atoms.join(single, per).where(F.col("__single") | F.col("chain").isin(list(wanted)))
    return out.drop("__single").select(*atoms.columns)


def residues(atoms: DataFrame, names: Iterable[str] = (), numbers: Iterable[int] = (), keep: bool = True) -> DataFrame:
    """Atoms of the residues with a given name or number, or all others."""
    names, numbers = list(names), list(numbers)
    hit = (F.col("resname").isin(names) if names else F.lit(False)) | (F.col("resseq").isin(numbers) if numbers else F.lit(False))
    return atoms.where(F.coalesce(hit, F.lit(False)) == F.lit(keep))


def merge(*parts: DataFrame) -> DataFrame:
    """All atoms of the parts, none dropped."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def common_names(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("name").intersect(b.select("name"))


def record_of_residue(resname: Column | str) -> Column:
    """ATOM for a standard residue, else HETATM."""
    c = F.col(resname) if isinstance(resname, str) else resname
    return F.when(F.upper(F.trim(c)).isin(STANDARD_RESIDUES), "ATOM").otherwise("HETATM")


def is_protein(names: Column | str) -> Column:
    """Whether most of the distinct residue names of an array are standard."""
    c = F.array_distinct(F.col(names) if isinstance(names, str) else names)
    known = F.size(F.array_intersect(c, F.array(*(F.lit(r) for r in STANDARD_RESIDUES))))
    return F.when(F.size(c) > 0, known / F.size(c) > 0.5).otherwise(False)


def stripped(lines: DataFrame, cleanup: str, line: str = "line") -> DataFrame:
    """Lines without the HETATM records that the cleanup modes (``waters``, ``nonstdres``) remove."""
    water = F.arrays_overlap(F.split(F.col(line), r"\s+"), F.array(*(F.lit(w) for w in WATERS)))
    drop = F.when(water, F.lit("waters" in cleanup)).otherwise(F.lit("nonstdres" in cleanup))
    return lines.where(~(F.col(line).startswith("HETATM") & drop))


def fused_numbers(lines: DataFrame, line: str = "line", per: str = "source_file") -> DataFrame:
    """``per, fused``: whether a chain sign touches a number of four digits."""
    c = F.col(line)
    hit = is_atom(c) & (F.substring(c, 22, 1) != " ") & F.trim(F.substring(c, 23, 4)).rlike(r"^\d{4,}$")
    return lines.groupBy(per).agg(F.max(F.coalesce(hit, F.lit(False))).alias("fused"))


def odd_numbers(atoms: DataFrame, per: str = "source_file") -> DataFrame:
    """Residue numbers that carry more than one residue name."""
    return atoms.groupBy(per, "chain", "resseq", "icode").agg(F.count_distinct("resname").alias("n_names")).where("n_names > 1")


def blank_chain(line: Column | str) -> Column:
    c = F.col(line) if isinstance(line, str) else line
    return F.when(is_atom(c), F.overlay(c, F.lit(" "), F.lit(22), F.lit(1))).otherwise(c)


def runs(rows: DataFrame, per: str, order: str, keys: Sequence[str], name: str = "run") -> DataFrame:
    """Adds the number (from 0) of the run of equal keys in the order of each ``per``."""
    w = Window.partitionBy(per).orderBy(order)
    now = F.struct(*keys)
    change = F.when(F.lag(now).over(w).eqNullSafe(now) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return rows.withColumn("__c", change).withColumn(name, (F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("int")).drop("__c")


def residue_runs(atoms: DataFrame, per: str = "source_file", order: str = "serial") -> DataFrame:
    """One row per contiguous residue: ``per, run, chain, resseq, icode, resname``."""
    r = runs(atoms, per, order, ["chain", "resseq", "icode", "resname"])
    return r.groupBy(per, "run").agg(*(F.first(c).alias(c) for c in ("chain", "resseq", "icode", "resname")))


def align_chains(source: DataFrame, output: DataFrame, per: str = "source_file") -> DataFrame:
    """``per, run, chain``: the chain of each residue of ``output``, from ``source`` by order.

    Both hold residue runs.  Each output residue takes the next source residue
    of its number; if there is none, the order was not kept and it raises.
    """

    def run(key, s: pd.DataFrame, o: pd.DataFrame) -> pd.DataFrame:  # noqa: ANN001
        s, o = s.sort_values("run"), o.sort_values("run")
        seq = list(zip(s["resseq"], s["icode"], s["chain"]))
        at, out = 0, []
        for number, icode, n in zip(o["resseq"], o["icode"], o["run"]):
            while at < len(seq) and seq[at][:2] != (number, icode):
                at += 1
            if at == len(seq):
                raise ValueError(f"{key[0]}: residue {number}{icode or ''} has no place in the source")
            out.append((key[0], n, seq[at][2]))
            at += 1
        return pd.DataFrame(out, columns=[per, "run", "chain"])

    kind = output.schema[per].dataType.simpleString()
    return source.groupBy(per).cogroup(output.groupBy(per)).applyInPandas(run, f"{per} {kind}, run int, chain string")


# ---------------------------------------------------------------- distances
def within(a: DataFrame, b: DataFrame, radius: float, keys: Sequence[str] = (), xyz: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Pairs of points of ``a`` and ``b`` (columns prefixed ``a_``, ``b_``) at most ``radius`` apart.

    Points fall into cells of the radius; each point of ``b`` is copied to its
    27 neighbour cells, so the pairs come from an equi-join on cells.
    """
    if radius <= 0:
        raise ValueError("radius must be positive")
    cell = [F.floor(F.col(c) / radius).cast("bigint") for c in xyz]
    known = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in xyz)
    steps = F.array(*(F.lit(i) for i in (-1, 0, 1)))
    left = a.where(known).select(*(F.col(c).alias(f"a_{c}") for c in a.columns), *(c.alias(f"__{i}") for i, c in enumerate(cell)))
    right = b.where(known).select(*(F.col(c).alias(f"b_{c}") for c in b.columns), *(c.alias(f"__{i}") for i, c in enumerate(cell)))
    for i in range(3):
        right = right.withColumn("__s", F.explode(steps)).withColumn(f"__{i}", F.col(f"__{i}") + F.col("__s")).drop("__s")
    on = [F.col(f"a_{k}") == F.col(f"b_{k}") for k in keys]
    right = right.withColumnsRenamed({f"__{i}": f"__b{i}" for i in range(3)})
    for i in range(3):
        on.append(F.col(f"__{i}") == F.col(f"__b{i}"))
    d2 = sum((F.pow(F.col(f"a_{c}") - F.col(f"b_{c}"), F.lit(2.0)) for c in xyz), F.lit(0.0))
    pairs = left.join(right, on).withColumn("distance", F.sqrt(d2)).where(d2 <= radius * radius + 1e-12)
    return pairs.drop(*(f"__{i}" for i in range(3)), *(f"__b{i}" for i in range(3)))


def waters_near(atoms: DataFrame, ligand: str, mode: str = "surface", radius: float = 3.6, per: str = "source_file") -> DataFrame:
    """Water atoms near ligand or protein (``surface``) or near both (``interfacial``); only electronegative atoms count."""
    if mode not in ("surface", "interfacial"):
        raise ValueError("mode is surface or interfacial")
    polar = F.upper("element").isin(ELECTRONEGATIVE)
    water = atoms.where(F.col("resname").isin(WATERS))
    cols = [per, "serial", "x", "y", "z"]
    lig = atoms.where((F.col("resname") == ligand) & polar).select(*cols)
    prot = atoms.where(F.col("resname").isin(STANDARD_RESIDUES) & polar).select(*cols)

    def near(part: DataFrame) -> DataFrame:
        return within(water.select(*cols), part, radius, [per]).select(F.col(f"a_{per}").alias(per), F.col("a_serial").alias("serial")).distinct()

    ids = near(lig.unionByName(prot)) if mode == "surface" else near(lig).intersect(near(prot))
    return water.join(ids, [per, "serial"], "left_semi")


def ligand_names(atoms: DataFrame, impurities: Sequence[str] = (), per: str = "source_file") -> DataFrame:
    """Distinct three-sign names of hetero residues that are no impurity and no water."""
    names = atoms.where((F.col("record") == "HETATM") & (F.length("resname") == 3) & ~F.col("resname").isin([*impurities, *WATERS]))
    return names.select(per, "resname").distinct()


def separate(atoms: DataFrame, impurities: Sequence[str] = (), remove_water: bool = True, start_chain: str = "A", per: str = "source_file") -> tuple[DataFrame, DataFrame]:
    """(protein atoms, ligand atoms): the ligand lies in the first chain from ``start_chain`` on that holds one.

    Impurities and ions (names of less than three signs) go; waters go or stay
    with the protein.
    """
    lig = atoms.where((F.col("record") == "HETATM") & (F.length("resname") >= 3) & ~F.col("resname").isin([*impurities, *WATERS]))
    chain = lig.where(F.col("chain") >= start_chain).groupBy(per).agg(F.min("chain").alias("chain"))
    ligand = lig.join(chain, [per, "chain"], "left_semi").select(*atoms.columns)
    protein = atoms.where((F.col("record") == "ATOM") | (F.col("resname").isin(WATERS) & F.lit(not remove_water)))
    return protein, ligand


# --------------------------------------------------------------------- RMSD
def rmsd_in_place(a: DataFrame, b: DataFrame, keys: Sequence[str], atom: str = "atom") -> DataFrame:
    """Root mean square deviation of equal atoms as they stand; groups of different size raise by a NULL ``rmsd``."""
    x, y = a.withColumnsRenamed({c: f"a{c}" for c in "xyz"}), b.withColumnsRenamed({c: f"b{c}" for c in "xyz"})
    d2 = sum((F.pow(F.col(f"a{c}") - F.col(f"b{c}"), F.lit(2.0)) for c in "xyz"), F.lit(0.0))
    both = x.select(*keys, atom, "ax", "ay", "az").join(y.select(*keys, atom, "bx", "by", "bz"), [*keys, atom], "full")
    whole = F.count(F.when(F.col("ax").isNotNull() & F.col("bx").isNotNull(), 1)) == F.count("*")
    return both.groupBy(*keys).agg(F.when(whole, F.sqrt(F.avg(d2))).alias("rmsd"), F.count("*").alias("n_atoms"))


def kabsch(p: np.ndarray, q: np.ndarray) -> float:
    """RMSD after the best superposition."""
    if p.shape != q.shape:
        raise ValueError("the structures have different numbers of atoms")
    p, q = p - p.mean(axis=0), q - q.mean(axis=0)
    u, s, vt = np.linalg.svd(p.T @ q)
    sign = np.sign(np.linalg.det(u @ vt)) or 1.0
    e = (p**2).sum() + (q**2).sum() - 2 * (s[0] + s[1] + sign * s[2])
    return math.sqrt(max(0.0, e) / len(p))


def rmsd_superposed(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, rmsd`` of rows ``keys, atom, ax..az, bx..bz`` after superposition of each group (one structure, so bounded)."""
    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema}

    def run(d: pd.DataFrame) -> pd.DataFrame:
        d = d.sort_values("atom")
        value = kabsch(d[["ax", "ay", "az"]].to_numpy(float), d[["bx", "by", "bz"]].to_numpy(float))
        return pd.DataFrame([[*d[list(keys)].iloc[0], value]], columns=[*keys, "rmsd"])

    return pairs.groupBy(*keys).applyInPandas(run, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "rmsd double"]))


def guess_type(name: Column | str) -> Column:
    """Atom type by the first letter of the atom's name; NULL for others."""
    first = F.upper(F.substring(strip(name), 1, 1))
    return F.when(first == "C", "C.3").when(first == "O", "O.2").when(first == "N", "N.3").when(first == "S", "S.2").when(first == "H", "H")


def repaired_mol2(lines: DataFrame, per: str = "source_file", order: str = "line_no", line: str = "line") -> DataFrame:
    """Lines whose atom type starts with no letter get a guessed type, inside the atom section."""
    w = Window.partitionBy(per).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    section = F.last(F.when(F.col(line).startswith("@<TRIPOS>"), F.trim(line)), ignorenulls=True).over(w)
    parts = F.split(F.trim(line), r"\s+")
    bad = (section == "@<TRIPOS>ATOM") & ~F.col(line).startswith("@") & (F.size(parts) >= 6) & ~F.get(parts, F.lit(5)).rlike("^[A-Za-z]")
    fixed = F.concat_ws(" ", F.slice(parts, 1, 5), F.coalesce(guess_type(F.get(parts, F.lit(1))), F.get(parts, F.lit(5))), F.slice(parts, F.lit(7), F.greatest(F.lit(0), F.size(parts) - 6)))
    return lines.withColumn(line, F.when(bad, fixed).otherwise(F.col(line)))


def restored_chains(lines: DataFrame, assigned: DataFrame, per: str = "source_file", order: str = "line_no", line: str = "line") -> DataFrame:
    """Lines whose chain column is overwritten by the chain assigned to their residue run (``per, run, chain``)."""
    c = F.col(line)
    atoms = lines.where(is_atom(c)).select("*", F.substring(c, 22, 1).alias("__c"), F.substring(c, 23, 5).alias("__n"), F.trim(F.substring(c, 18, 3)).alias("__r"))
    atoms = runs(atoms, per, order, ["__c", "__n", "__r"], "__run")
    a = assigned.select(F.col(per).alias("__per"), F.col("run").alias("__of"), F.col("chain").alias("__chain"))
    fixed = atoms.join(a, (F.col(per) == F.col("__per")) & (F.col("__run") == F.col("__of")), "left")
    fixed = fixed.withColumn(line, F.when(F.col("__chain").isNotNull(), F.overlay(c, F.col("__chain"), F.lit(22), F.lit(1))).otherwise(c)).select(*lines.columns)
    return fixed.unionByName(lines.where(~F.coalesce(is_atom(c), F.lit(False))))
