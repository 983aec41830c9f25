"""Atom lines and dump lines: valid rows, reasons, blocks."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import strict_parse as S

ATOM_CASES = [
    ("ATOM      1  N   PHE A 537      -8.834   3.827 -18.279 -0.7800 1.5000", (1, "N", "PHE", "A", 537, None)),
    ("ATOM 2 CA PHE A1086 1.0 2.0 3.0 0.1 1.5", (2, "CA", "PHE", "A", 1086, None)),
    ("HETATM 3 C1 MQ7 1077 60.037 60.407 29.132 0.2362 1.4000", (3, "C1", "MQ7", None, 1077, None)),
    ("ATOM 4 CA GLY X 807A -18.713-100.168-3.5-0.1 1.5\r", (4, "CA", "GLY", "X", 807, "A")),
    ("ATOM 5 CA GLY 2 -3 1.0 2.0 3.0 0.1 1.5", (5, "CA", "GLY", "2", -3, None)),
    ("ATOM 6 CA GLY 5 1.0 2.0 3.0 0.1 1.5", (6, "CA", "GLY", None, 5, None)),
    ('ATOM 7 "HB2" GLY A 5 1.0 2.0 3.0 0.1 1.5', (7, "HB2", "GLY", "A", 5, None)),
    ("REMARK 1 text", None),
    ("TER", None),
    ("", None),
    ("ATOM 7 CA CYS C 2 -32.3 10.3 9.4 -0.07", "columns"),
    ("ATOM 64 HD11 ILE E 423 15.6 -26.7 8.8 -0.7 1.8 0.5", "columns"),
    ("ATOM 2 HA ARG A", "columns"),
    ("ATOM", "columns"),
    ('ATOM 1 CA LEU 2" 27 -1.0 4.0 1.0 0.3 1.2', "quoting"),
    ('ATOM 1 CA" LEU 2', "quoting"),
    ("ATOM 75 H THR AA 427 1.621 -74.497 28.868 0.1 1.85", "value"),
    ("ATOM 5 N PRO 2 -4.5 -42.5 -64.6 -80.8 -0.2 1.7", "value"),
    ("ATOM 4 C ALA A 1077AB 55.7 -65.2 7.0 -0.08 1.2", "value"),
    ("ATOM 4 C ALA A 10 55.7 -65.2 nan -0.08 1.2", "value"),
    ("ATOM x C ALA A 10 55.7 -65.2 1.0 -0.08 1.2", "value"),
    ("ATOM 4 C ALA A 10 55.7 -65.2 12,418 -0.08 1.2", "value"),
    ("ATOM 4 C ALA A 10 55 -65.2 1.0 -0.08 1.2", "value"),
    ("ATOM 4 C ALA A **** 5.5 -65.2 1.0 -0.08 1.2", "value"),
]
T = "\t"
READING_CASES = [
    (T.join(["1", "2", "Active", "IC50", "2.5", "=", "uM", "P1", "3", "4"]), (1, 2, 2.5, 3, 4)),
    (T.join(["1", "", "", "", "", "", "", "", "", ""]) + "\r", (1, None, None, None, None)),
    (T.join(['"1"', '"2"', '"A"', '"B ""x"""', '" 1e3 "', '""', '""', '""', '"3"', '"4"']), (1, 2, 1000.0, 3, 4)),
    (T.join(["1", "2", "Active", '"Ki (two\tfit"', "+.5", "", "", "", " 3 ", ""]), (1, 2, 0.5, 3, None)),
    (T.join(["1", "2", "A", 'Inhibition, 5" plate', "-0.01E+2", "", "", "", "", ""]), (1, 2, -1.0, None, None)),
    (T.join(S.HEADER), None),
    (T.join(f'"{h}"' for h in S.HEADER), None),
    ("", None),
    ("\r", None),
    (T.join(["1"] * 9), "columns"),
    (T.join(["1"] * 11), "columns"),
    ("no tabs at all", "columns"),
    (T.join(["1", "2", '"open', "x", "1", "", "", "", "", ""]), "quoting"),
    (T.join(["1", "2", '"a"b', "x", "1", "", "", "", "", ""]), "quoting"),
    (T.join(["1", "2", '""EC50"', "x", "y", ""]), "quoting"),
    (T.join(["n/a", "2", "A", "x", "1", "", "", "", "", ""]), "value"),
    (T.join(["1", "2", "A", "x", "nan", "", "", "", "", ""]), "value"),
    (T.join(["1", "2", "A", "x", "1e999", "", "", "", "", ""]), "value"),
    (T.join(["1", "2", "A", "x", ">5", "", "", "", "", ""]), "value"),
    (T.join(["1", "12.5", "A", "x", "5", "", "", "", "", ""]), "value"),
    (T.join(["9" * 30, "2", "A", "x", "5", "", "", "", "", ""]), "value"),
    (T.join(["1", "2", "A", "x" * 100_000, "5", "", "", "", "", ""]), (1, 2, 5.0, None, None)),
]


def outcome(fmt, row):
    if row is None or isinstance(row, str):
        return row
    return (row[1], row[2], row[3], row[4], row[5], row[6]) if fmt is S.ATOMS else (row[0], row[1], row[4], row[8], row[9])


@pytest.mark.parametrize(("fmt", "cases"), [(S.ATOMS, ATOM_CASES), (S.READINGS, READING_CASES)])
@pytest.mark.parametrize("block", [1, 3, 8192])
def test_lines(spark, monkeypatch, fmt, cases, block):
    monkeypatch.setattr(S, "BLOCK", block)
    for line, want in cases:
        assert outcome(fmt, fmt.strict(line)) == want, line
    df = spark.createDataFrame([(i, c[0], "clash") for i, c in enumerate(cases)] + [(999, None, "x")], "line_id long, line string, reason string").repartition(2)
    got = {r.line_id: (r.reason or tuple(r.row)) for r in S.parse_lines(df, fmt).collect()}
    assert {i: outcome(fmt, v) for i, v in got.items()} == {i: w for i, (_, w) in enumerate(cases) if w is not None}


def test_empty_table(spark):
    df = spark.createDataFrame([], "line_id long, line string")
    assert S.parse_atoms(df).count() == 0
    assert S.valid_rows(S.parse_readings(df)).columns[:3] == ["line_id", "aid", "cid"]
    assert S.failures(S.parse_readings(df)).where(F.lit(True)).count() == 0
