"""Unit graph and concentrations."""

import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from millrace.operators.units import InconsistentUnits, UnitGraph, concentration_graph, latest_masses, py_unit_key, to_molar, unit_key

SCHEMA = "measurement_id long, cid long, activity_name string, activity_value string, activity_unit string, p string"


def run(spark, rows, masses=((1, 500.0),), schema=SCHEMA):
    df = spark.createDataFrame([(i, *r, "clash") for i, r in enumerate(rows)], schema)
    m = spark.createDataFrame(list(masses), "cid long, molecular_weight double")
    return {r["measurement_id"]: r["p"] for r in to_molar(df, m).collect()}


def test_compositions_are_exact_and_shortest():
    g = concentration_graph()
    best = g.compositions("mol/l")
    assert best["nmol/ml"].scale == Fraction(1, 10**6) and best["fmol/ul"].scale == Fraction(1, 10**9)
    assert best["umol/l"].offset == 0


def test_affine_offsets_and_cycles():
    g = UnitGraph()
    g.connect("degC", "K", 1, Fraction("273.15"))
    g.connect("degF", "degC", Fraction(5, 9), Fraction(-160, 9))
    f = g.compositions("K")["degF"]
    assert float(f.scale * 212 + f.offset) == pytest.approx(373.15)
    g.connect("degF", "K", Fraction(5, 9), Fraction(-160, 9) + Fraction("273.15"))
    g.compositions("K")
    bad = UnitGraph()
    bad.connect("a", "b", 2)
    bad.connect("b", "c", 2)
    bad.connect("a", "c", 5)
    with pytest.raises(InconsistentUnits):
        bad.compositions("c")
    with pytest.raises(InconsistentUnits):
        bad.connect("a", "b", 3)


def test_table_holds_every_spelling(spark):
    g = UnitGraph()
    g.connect("g", "kg", Fraction(1, 1000))
    g.alias("gram", "g")
    rows = {(r.unit_key, r.scale) for r in g.table(spark, ["kg"]).collect()}
    assert rows == {("g", 0.001), ("gram", 0.001), ("kg", 1.0)}


def test_spellings_agree_in_python_and_spark(spark):
    texts = ["µM", "μg/ml", " nM", "nmol l-1", "umol.L-1", "10^-6 M", "mg / L", "NM"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", unit_key("t").alias("k")).collect()
    assert all(r.k == py_unit_key(r.t) for r in got)
    assert [py_unit_key(t) for t in texts[:5]] == ["um", "ug/ml", "nm", "nmol/l", "umol/l"]


CASES = [
    ((1, "IC50", "10", "uM"), 5.0),
    ((1, " ki ", "> 10 ", "nM"), 8.0),
    ((1, "IC50 (nM)", "100", None), 7.0),
    ((1, "IC50 (nM)", "100", "uM"), 4.0),
    ((1, "IC50 / µM", "5 mM", "none"), -math.log10(5e-6)),
    ((1, "EC50", "4080 nanomolar", "-"), -math.log10(4080e-9)),
    ((1, "EC50", "1.5e-9M", ""), -math.log10(1.5e-9)),
    ((1, "pIC50", "6.5", "log units"), 6.5),
    ((1, "-log10(Ki)", "7.25", None), 7.25),
    ((1, "p_IC50", "7", "uM"), 7.0),
    ((1, "IC50", "7", "-log M"), 7.0),
    ((1, "log10(IC50 / uM)", "0.5", ""), 5.5),
    ((1, "LOG Ki nM", "2", "log"), 7.0),
    ((1, "log IC50 (M)", "-6.1", "log units"), 6.1),
    ((1, "IC50", "5", "ug/mL"), 5.0),
    ((1, "MIC", "1", "10^-6 M"), 6.0),
    ((1, "Kd", "1", "pmol/mL"), 9.0),
    ((1, "nmol/L Ki", "1", ""), 9.0),
]


def test_concentrations(spark):
    got = run(spark, [c for c, _ in CASES])
    for i, (case, want) in enumerate(CASES):
        assert got.get(i) == pytest.approx(want), case


MASS_UNITS = [
    "ug mL^-1", "ug mL(-1)", "ug*mL-1", "ug mL\u207b\u00b9", "ug mL\u2212\u00b9", "ug mL\u22121", "ug\u22c5mL-1", "ug\u00a0/ mL", "ug\u00a0mL-1", "\u00b5g ml -1",
    "ug * mL^(-1)", "mg dm3-1", "g m3 -1", "MG/L", "microgram/mL", "PPM", "mg l-1", "ug/mL", "mg l\u207b\u00b9", "mg mL\u207b\u00b9", "mg ml^-1",
    "mg l^-1", "mg*ml-1", "mg\u22c5ml-1", "mg l (-1)", "ug\u00b7ml-1",
]


def test_every_spelling_of_mass_meets_its_compound(spark):
    g = concentration_graph()
    known, keys = g.compositions("g/l"), [py_unit_key(u) for u in MASS_UNITS]
    want = {i: math.log10(500.0 / float(known[g.aliases.get(k, k)].scale * 5)) for i, k in enumerate(keys)}
    got = run(spark, [(1, "IC50", "5", u) for u in MASS_UNITS])
    assert got == pytest.approx(want)
    # the unit in the name or the value
    named = run(spark, [(1, f"IC50 [{u}]", "5", None) for u in MASS_UNITS if "(" not in u] + [(1, "IC50", f"5 {u}", None) for u in MASS_UNITS])
    assert len(named) == 2 * len(MASS_UNITS) - sum("(" in u for u in MASS_UNITS)


def test_logarithms_of_units_follow_the_graph(spark):
    cases = {"lg nmol/l": 4.0, "lg mol/l": -5.0, "log nM": 4.0, "log10(nM)": 4.0, "lg [uM]": 1.0, "log (nmol L-1)": 4.0, "-log M": 5.0, "lg g/l": math.log10(500) - 5, "log ug/mL": math.log10(500) - 2}
    assert run(spark, [(1, "IC50", "5", u) for u in cases]) == pytest.approx(dict(enumerate(cases.values())))
    # the name says that the value is a logarithm: the unit may be plain or say so again
    assert run(spark, [(1, "log IC50", "2", "nM"), (1, "log IC50", "2", "lg nM"), (1, "log IC50 (ug/mL)", "2", None), (1, "pIC50", "6", "lg nM")]) == pytest.approx({0: 7.0, 1: 7.0, 2: math.log10(500) + 1, 3: 6.0})


def test_a_graph_with_a_unit_and_an_offset_of_its_own(spark):
    g = concentration_graph()
    g.connect("drop", "g/l", Fraction(1, 20))
    g.connect("above", "mol/l", Fraction(1, 1000), Fraction(1, 10))
    df = spark.createDataFrame([(7, 1, "IC50", "5", "drop", ""), (8, 1, "IC50", "900", "above", "")], SCHEMA)
    m = spark.createDataFrame([(1, 500.0)], "cid long, molecular_weight double")
    assert {r[0]: r.p for r in to_molar(df, m, g).collect()} == {7: pytest.approx(math.log10(500 / 0.25)), 8: pytest.approx(0.0)}


def test_pairs_too_many_for_a_broadcast_are_read_row_by_row(spark, monkeypatch):
    rows = [c for c, _ in CASES] + [(1, "IC50", "5", u) for u in MASS_UNITS] + [(1, "IC50", "5", None), (1, "IC50", "5", "\x00")]
    want = run(spark, rows)
    monkeypatch.setattr("millrace.operators.units.fits_broadcast", lambda df: False)
    assert run(spark, rows) == want


def test_what_is_no_concentration(spark):
    rows = [
        (1, "% inhibition at 10 uM", "50", "%"),
        (1, "IC50 fold change", "5", "fold"),
        (1, "Ki ratio", "5", None),
        (1, "Selectivity (IC50/IC50)", "5", "uM"),
        (1, "pKa", "5", None),
        (1, "logP", "2", None),
        (1, "IC50", "5", None),
        (1, "IC50", " ", "uM"),
        (1, "IC50", None, "uM"),
        (1, "IC50", "n.d.", "uM"),
        (1, "IC50", "0", "uM"),
        (1, "IC50", "-3", "uM"),
        (2, "IC50", "5", "ug/mL"),
        (None, "IC50", "5", "ug/mL"),
        (1, None, "5", "uM"),
        (1, "log IC50", "5", None),
        (1, "x" * 100_000, "5", "uM"),
        (1, "IC50", "9" * 5000, "%"),
    ]
    assert run(spark, rows, [(1, 500.0), (2, float("nan"))]) == {}


def test_empty_tables_and_repeats(spark):
    assert run(spark, []) == {}
    assert len(run(spark, [(1, "IC50", "1", "uM")] * 3, [])) == 3


def test_latest_mass_counts(spark):
    df = spark.createDataFrame([(1, "a", 10.0), (1, "b", 20.0), (1, "b", 20.0), (2, "a", 5.0), (2, "b", float("nan")), (None, "z", 1.0)], "cid long, cache_part string, MolecularWeight double")
    assert {tuple(r) for r in latest_masses(df).collect()} == {(1, 20.0), (2, None)}
    assert latest_masses(df.where(F.lit(False))).count() == 0
