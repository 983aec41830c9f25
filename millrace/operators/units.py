"""Quantities in different units: a conversion graph, its closure, equi-joins.

Units are nodes and conversions are edges ``y = scale * x + offset`` with exact
fractions.  Shortest compositions to a canonical unit are computed once on the
driver (a graph has a few hundred units, whatever the data), every edge is held
against them (cycle consistency), and the data meet the result in equi-joins on
the spelled unit and its canonical target.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.nulls import col
from millrace.session import cut, fits_broadcast


class InconsistentUnits(ValueError):
    """Two ways between the same units give different functions."""


@dataclass(frozen=True)
class Affine:
    """``y = scale * x + offset``."""

    scale: Fraction
    offset: Fraction = Fraction(0)

    def then(self, after: Affine) -> Affine:
        return Affine(after.scale * self.scale, after.scale * self.offset + after.offset)

    def inverse(self) -> Affine:
        return Affine(1 / self.scale, -self.offset / self.scale)


@dataclass
class UnitGraph:
    """Undirected graph of units; every edge carries its affine function."""

    edges: dict[str, dict[str, Affine]] = field(default_factory=dict)
    aliases: dict[str, str] = field(default_factory=dict)

    def connect(self, source: str, target: str, scale: object, offset: object = 0) -> None:
        function = Affine(Fraction(scale), Fraction(offset))
        if not function.scale:
            raise ValueError("a scale of 0 can't be inverted")
        for a, b, f in ((source, target, function), (target, source, function.inverse())):
            known = self.edges.setdefault(a, {}).get(b)
            if known is not None and known != f:
                raise InconsistentUnits(f"{a} -> {b}: {known} and {f}")
            self.edges[a][b] = f

    def alias(self, spelling: str, unit: str) -> None:
        known = self.aliases.setdefault(spelling, unit)
        if known != unit:
            raise InconsistentUnits(f"{spelling!r} means {known} and {unit}")

    def compositions(self, canonical: str) -> dict[str, Affine]:
        """Shortest composition (fewest edges, then names) from each unit to ``canonical``."""
        if canonical not in self.edges:
            raise KeyError(canonical)
        best: dict[str, Affine] = {}
        queue: list[tuple[int, str, Affine]] = [(0, canonical, Affine(Fraction(1)))]
        while queue:
            hops, unit, function = heapq.heappop(queue)
            if unit in best:
                continue
            best[unit] = function
            for near in self.edges[unit]:
                if near not in best:
                    heapq.heappush(queue, (hops + 1, near, self.edges[near][unit].then(function)))
        for a in best:  # cycles: each edge must agree with the compositions at its ends
            for b, edge in self.edges[a].items():
                if edge.then(best[b]) != best[a]:
                    raise InconsistentUnits(f"the way {a} -> {b} -> {canonical} differs from {a} -> {canonical}")
        return best

    def spellings(self, canonical: str) -> dict[str, str]:
        """Every spelling of a unit that has a way to ``canonical``, with that unit."""
        best = self.compositions(canonical)
        return {**{u: u for u in best}, **{s: u for s, u in self.aliases.items() if u in best}}

    def table(self, spark: SparkSession, canonicals: Iterable[str]) -> DataFrame:
        """``unit_key, unit, canonical, scale, offset`` for every spelling; its size is that of the graph."""
        rows = []
        for canonical in canonicals:
            best = self.compositions(canonical)
            rows += [(s, u, canonical, float(best[u].scale), float(best[u].offset)) for s, u in sorted(self.spellings(canonical).items())]
        names = ("unit_key", "unit", "canonical", "scale", "offset")
        kinds = [pa.string()] * 3 + [pa.float64()] * 2
        return spark.createDataFrame(pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names))


#: Decimal prefixes and their long names.
PREFIXES = {"": 0, "d": -1, "c": -2, "m": -3, "u": -6, "n": -9, "p": -12, "f": -15, "a": -18}
LONG_PREFIXES = {"": 0, "deci": -1, "centi": -2, "milli": -3, "micro": -6, "nano": -9, "pico": -12, "femto": -15, "atto": -18}


def power(exponent: int) -> Fraction:
    return Fraction(10) ** exponent


def concentration_graph() -> UnitGraph:
    """Amount and mass per volume, and decadic logarithms of both kinds.

    Canonical units: ``mol/l`` (amount), ``g/l`` (mass), ``p`` (negative
    logarithm of mol/l), ``lg g/l`` (logarithm of mass).  Spellings are stored
    as ``unit_key`` writes them.
    """
    g = UnitGraph()
    for amount, canonical in (("mol", "mol/l"), ("g", "g/l")):
        names = {"": 0, "k": 3, **PREFIXES} if amount == "g" else PREFIXES
        for pre, e in names.items():
            if pre + amount != amount:
                g.connect(f"{pre}{amount}/l", canonical, power(e))
            for vol, v in (("dl", -1), ("cl", -2), ("ml", -3), ("ul", -6), ("nl", -9), ("pl", -12)):
                g.connect(f"{pre}{amount}/{vol}", f"{pre}{amount}/l", power(-v))
            for vol, same in (("dm3", "l"), ("dm^3", "l"), ("cm3", "ml"), ("cm^3", "ml"), ("cc", "ml"), ("liter", "l"), ("litre", "l"), ("mm3", "ul")):
                g.alias(f"{pre}{amount}/{vol}", f"{pre}{amount}/{same}")
            g.connect(f"{pre}{amount}/m3", f"{pre}{amount}/l", power(-3))
        for k in range(1, 19):
            unit = f"e-{k} {canonical}"
            g.connect(unit, canonical, power(-k))
            for writing in (f"10^-{k}", f"1e-{k}", f"1.0e-{k}", f"10**-{k}", f"10-{k}", f"x10^-{k}", f"*10^-{k}", f"1x10^-{k}", f"1*10^-{k}", f"e-{k}"):
                for stem in ("m", "molar", "mol/l") if amount == "mol" else ("g/l",):
                    if f"{writing} {stem}" != unit:
                        g.alias(f"{writing} {stem}", unit)
                    g.alias(f"{writing}{stem}", unit)
    for pre, e in PREFIXES.items():
        g.alias(f"{pre}m", f"{pre}mol/l")
    for pre, e in LONG_PREFIXES.items():
        short = next(s for s, x in PREFIXES.items() if x == e)
        for stem in ("molar", "mole/l", "moles/l", "mol/l", "mole/liter", "moles/liter", "mol/liter", "mole per liter", "moles per liter", "mol per l"):
            if f"{pre}{stem}" != f"{short}mol/l":
                g.alias(f"{pre}{stem}", f"{short}mol/l")
        for stem in ("gram/l", "grams/l", "gram per liter"):
            g.alias(f"{pre}{stem}", f"{short}g/l")
        for stem in ("gram/ml", "grams/ml", "gram per milliliter"):
            g.alias(f"{pre}{stem}", f"{short}g/ml")
    for part, unit in (("ppm", "mg/l"), ("ppb", "ug/l")):
        g.connect(part, unit, 1)
    # logarithms: lg(unit) -> p is affine, with scale -1 and the unit's exponent as offset
    exponents = {u: f for u, f in g.compositions("mol/l").items()}
    for unit, function in exponents.items():
        g.connect(f"lg {unit}", "p", -1, -_exponent(function.scale))
    for unit, function in g.compositions("g/l").items():
        if unit != "g/l":
            g.connect(f"lg {unit}", "lg g/l", 1, _exponent(function.scale))
    for spelling, unit in {**g.spellings("mol/l"), **g.spellings("g/l")}.items():
        if spelling != unit:
            g.alias(f"lg {spelling}", f"lg {unit}")
    for spelling in ("-log m", "-log(m)", "-log[m]", "-log10 m", "-log10(m)", "-log10[m]", "-lg m", "-lg(m)", "-log mol/l", "-log(mol/l)", "-log10(mol/l)", "neg. log m", "neg log m", "-log", "-log10", "-lg", "plog", "-log units"):
        g.alias(spelling, "p")
    return g


def _exponent(scale: Fraction) -> int:
    """The power of ten that ``scale`` is."""
    e = 0
    while scale < 1:
        scale, e = scale * 10, e - 1
    while scale >= 10:
        scale, e = scale / 10, e + 1
    if scale != 1:
        raise ValueError("only powers of ten have a logarithmic unit")
    return e


#: The last steps of a canonical spelling: ``l-1`` as ``/l``, no blanks around ``/``, the logarithm of a unit as ``lg unit``.
_KEY_RULES = (
    (r"^((?:(?:log|lg) ?(?:10)? ?[(\[]? ?)?\w+)[ .*]*(d|c|m|u|n|p|)(l|dm3|m3)\s?\^?\(?-1\)?([)\]]?)$", r"\1/\2\3\4"),
    (r" ?/ ?", "/"),
    (r"^(?:log|lg) ?(?:10)?(?: | ?\( ?| ?\[ ?)([^()\[\]]+?) ?[)\]]?$", r"lg \1"),
)


def unit_key(c: Column | str) -> Column:
    """Canonical spelling: lower case, one micro sign, ``/l`` for ``l-1``, no outer or doubled blanks."""
    text = F.translate(F.lower(col(c)), "µμ−⁻‐‑–⁰¹²³⁴⁵⁶⁷⁸⁹·⋅× ", "uu-----0123456789..x ")
    text = F.regexp_replace(text, r"\s+", " ")
    text = F.regexp_replace(text, r"^ | $", "")
    for pattern, into in _KEY_RULES:
        text = F.regexp_replace(text, pattern, re.sub(r"\\(\d)", r"$\1", into))
    return text


def py_unit_key(text: str) -> str:
    """``unit_key`` for one Python string, for tests and tables."""
    text = text.lower().translate(str.maketrans("µμ−⁻‐‑–⁰¹²³⁴⁵⁶⁷⁸⁹·⋅× ", "uu-----0123456789..x "))
    text = re.sub(r"\s+", " ", text).strip(" ")
    for pattern, into in _KEY_RULES:
        text = re.sub(pattern, into, text)
    return text


#: The measured quantities that are concentrations.
ENDPOINTS = ("ic50", "ki", "kd", "ec50", "ac50", "gi50", "cc50", "mic", "potency")
_E = "(?:" + "|".join(ENDPOINTS) + ")"
_NOISE = r"(?:\s*(?:value|values|conc\.?|concentration|mean|apparent|app\.?))*"
#: Writings of an endpoint; the group, if any, is the unit that the name states.
NAME_LINEAR = rf"^{_E}{_NOISE}(?:\s*[(\[{{]\s*([^()\[\]{{}}]+?)\s*[)\]}}]|\s*(?:,|/|_|:|\bin\b)\s*([^()\[\]{{}},]+?))?$"
NAME_LINEAR_FIRST = rf"^(\S+(?: l-1)?)\s+{_E}$"
NAME_NEGATIVE = rf"^(?:p\s*[_-]?\s*{_E}|(?:-|neg(?:ative|\.)?\s*)\s*(?:log|lg)\s*(?:10)?\s*[(\[]?\s*{_E}\s*[)\]]?|(?:log|lg)(?:10)?\s*\(?\s*1\s*/\s*{_E}\s*\)?)(?:\s*[(\[][^()\[\]]*[)\]])?(?:\s+(?:m|mol/l))?$"
NAME_LOG = rf"^(?:log|lg)\s*(?:10)?\s*[(\[]?\s*{_E}\s*(?:[)\]]?\s*[(\[/,]?\s*([^()\[\],/]+(?:/m?l)?)\s*)?[)\]]?$"
_QUALIFIER = r"^[\s ]*(?:>=|<=|=>|=<|>>|<<|>|<|=|~|≈|≥|≤|±|ca\.?|approx\.?)*[\s ]*"
_NUMBER = r"([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def _written(name: Column, pattern: str, *groups: int) -> Column:
    """The first non-empty group of the pattern, else NULL."""
    return F.coalesce(*(F.nullif(F.regexp_extract(name, pattern, i), F.lit("")) for i in groups))


def _kind(name: Column) -> Column:
    """What the cleaned name says of its values: ``linear``, ``neg`` (negative logarithm) or ``log``; NULL: no concentration."""
    linear = name.rlike(NAME_LINEAR) | name.rlike(NAME_LINEAR_FIRST)
    return F.when(name.rlike(NAME_NEGATIVE), "neg").when(name.rlike(NAME_LOG), "log").when(linear, "linear")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that costs time: filters behind it are not pushed into its expression, which would double the work."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def read_names(df: DataFrame, name: str, unit: str) -> DataFrame:
    """Adds ``__kind`` and the unit spellings ``__u1`` (unit column) and ``__u2`` (in the name); no row is lost."""
    text = F.regexp_replace(F.translate(F.lower(col(name)), "µμ− ", "uu- "), r"\s+", " ")
    df = _once(_once(df, "__name", F.trim(text)), "__kind", _kind(F.col("__name")))
    n = F.col("__name")
    linear = F.coalesce(_written(n, NAME_LINEAR, 1, 2), _written(n, NAME_LINEAR_FIRST, 1))
    stated = F.when(F.col("__kind") == "linear", linear).when(F.col("__kind") == "log", _written(n, NAME_LOG, 1))
    return _once(df.withColumn("__u2", unit_key(stated)), "__u1", unit_key(unit)).drop("__name")


#: A value such as "9e-9M": a qualifier, the longest number that leaves a unit or nothing, and the unit.
VALUE = _QUALIFIER + _NUMBER + r"[\s ]*(.*?)[\s ]*$"

#: Spellings that name another quantity: such a reading is no concentration.
OTHER_UNITS = ("%", "percent", "fold", "ratio", "min", "s", "h", "hr", "degc", "c", "k", "rlu", "rfu", "au")


def _meanings(spark: SparkSession, graph: UnitGraph) -> DataFrame:
    """``unit_key, target, scale, offset`` of every spelling, once for each kind of name (``as``) it may stand with.

    A name that says "logarithm" makes a plain unit its logarithm (``lg unit``);
    with any other name a unit means what it says.
    """
    known = graph.table(spark, ("mol/l", "g/l", "p", "lg g/l"))
    plain = known.select("unit_key", F.lit("linear").alias("as"), F.col("canonical").alias("target"), "scale", "offset")
    log = known.where(F.col("unit_key").startswith("lg ")).select(F.substring("unit_key", 4, 1 << 20).alias("unit_key"), F.lit("log").alias("as"), F.col("canonical").alias("target"), "scale", "offset")
    return plain.unionByName(log).unionByName(log.withColumn("unit_key", F.concat(F.lit("lg "), "unit_key")))


def to_molar(df: DataFrame, masses: DataFrame, graph: UnitGraph | None = None, key: str = "cid", **fields: str) -> DataFrame:
    """Concentrations as ``p = -log10(mol/l)``, with the rows that aren't any left out.

    ``df`` needs the three text fields ``activity_name``, ``activity_value`` and
    ``activity_unit`` (or others named by ``name``, ``value``, ``unit``) and
    ``key``; ``masses`` has ``key`` once with ``molecular_weight``.  The unit in
    the unit column goes before one in the name, and that before one in the
    value.  A negative logarithm is of mol/l; another logarithm is of its unit.
    NULL and blank fields, names of other quantities, values without a number
    and linear values of 0 or less give no row.

    Spellings meet the closure of the graph in equi-joins on (spelling, kind of
    name), and every reading takes its affine function from there.  Names and
    units are parsed once per distinct pair, as long as those are few; else row
    by row, with the same result.  Only mass concentrations are joined with
    ``masses``; all other rows need no shuffle.  Extra columns are kept; a
    column of ``df`` named ``p`` is replaced.
    """
    spark = df.sparkSession
    names = {"name": "activity_name", "value": "activity_value", "unit": "activity_unit"} | fields
    look = F.broadcast(_meanings(spark, graph or concentration_graph()))
    kept = [c for c in df.columns if c not in ("p", "molecular_weight")]

    def meant(part: DataFrame, i: int) -> DataFrame:
        """The function of spelling ``__u{i}``."""
        at = look.select(F.col("unit_key").alias("__k"), F.col("as").alias("__as"), F.struct("target", "scale", "offset").alias(f"__f{i}"))
        kind = F.when(F.col("__kind") == "log", "log").otherwise("linear")
        return part.join(at, (F.col(f"__u{i}") == F.col("__k")) & (kind == F.col("__as")), "left").drop("__k", "__as", f"__u{i}")

    def resolved(part: DataFrame, name: str, unit: str) -> DataFrame:
        """Adds ``__kind`` and the function ``__f`` that unit column or name give; rows of other quantities go."""
        part = read_names(part, name, unit).where("__kind IS NOT NULL")
        part = part.where(~F.coalesce(F.col("__u1").isin(*OTHER_UNITS), F.lit(False)))
        return meant(meant(part, 1), 2).withColumn("__f", F.coalesce("__f1", "__f2")).drop("__f1", "__f2")

    pairs = df.select(F.col(names["name"]).alias("__n"), F.col(names["unit"]).alias("__t")).distinct()
    # each distinct pair is parsed once; frozen, so that its size can be looked at before it is broadcast
    pairs = cut(resolved(pairs.repartition(spark.sparkContext.defaultParallelism), "__n", "__t").select("__n", "__t", "__kind", "__f"))
    base = df.select(*kept)
    if fits_broadcast(pairs):
        at = (F.col(names["name"]) == F.col("__n")) & F.col(names["unit"]).eqNullSafe(F.col("__t"))
        base = base.join(F.broadcast(pairs), at).drop("__n", "__t")
    else:
        base = resolved(base, names["name"], names["unit"])

    def read(part: DataFrame) -> DataFrame:
        """Adds the number and, where nothing else told it, the unit in the value; then ``__y``, the number on its target's scale."""
        clean = F.translate(F.col(names["value"]), "−\x01", "- ")
        # one match: number and rest around a sign; a text that doesn't match stays as it is, and is no number then
        part = _once(part, "__value", F.split(F.regexp_replace(clean, VALUE, "\x01$1\x01$2"), "\x01"))
        part = part.withColumn("__number", F.when(F.size("__value") == 3, F.get("__value", F.lit(1)).try_cast("double"))).where("__number IS NOT NULL")
        part = _once(part, "__u3", F.when(F.col("__f").isNull() & (F.col("__kind") != "neg"), unit_key(F.get("__value", F.lit(2))))).drop("__value")
        part = meant(part, 3).withColumn("__f", F.coalesce("__f", "__f3")).drop("__f3")
        part = part.withColumn("__target", F.when(F.col("__kind") == "neg", F.lit("p")).otherwise(F.col("__f.target"))).where("__target IS NOT NULL")
        part = part.where(~F.col("__target").isin("mol/l", "g/l") | (F.col("__number") > 0))
        return part.withColumn("__y", F.when(F.col("__kind") == "neg", F.col("__number")).otherwise(F.col("__number") * F.col("__f.scale") + F.col("__f.offset")))

    def negative(y: Column, target: Column) -> Column:
        """-lg of an amount or a mass, from a value in any of the four canonical units."""
        return F.when(target == "p", y).when(target == "lg g/l", -y).otherwise(-F.log10(y))

    y, target = F.col("__y"), F.col("__target")
    mass_units = ("g/l", "lg g/l")
    molar = read(base).where(~target.isin(*mass_units)).select(*kept, negative(y, target).alias("p"))
    mass = masses.where((F.col("molecular_weight") > 0) & ~F.isnan("molecular_weight")).select(F.col(key).alias("__key"), "molecular_weight")
    # a row whose unit column or name tells an amount or a negative logarithm can't be a mass; its value isn't read again
    may_be = (F.col("__kind") != "neg") & F.coalesce(F.col("__f.target").isin(*mass_units), F.lit(True))
    heavy = read(base.where(may_be)).where(target.isin(*mass_units))
    by_mass = heavy.join(mass, F.col(key) == F.col("__key")).select(*kept, (F.log10("molecular_weight") + negative(y, target)).alias("p"))
    return molar.unionByName(by_mass)


def latest_masses(compounds: DataFrame) -> DataFrame:
    """``cid, molecular_weight`` of the row of the greatest ``cache_part``; ties: the greatest mass."""
    w = F.col("MolecularWeight")
    return (
        compounds.where(F.col("cid").isNotNull())
        .groupBy("cid")
        .agg(F.max(F.struct("cache_part", F.nanvl(w, F.lit(None).cast("double")).alias("w"))).alias("m"))
        .select("cid", F.col("m.w").alias("molecular_weight"))
    )
