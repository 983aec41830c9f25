"""Lines into typed rows, with the lines that fail apart and their reasons.

Blocks of lines are parsed in bulk by Arrow (one regular expression over the
whole block, bulk casts).  A block that holds a line the fast path can't take is
halved, over the match it has already, until such lines are alone; only those
are diagnosed, strictly and one by one.  The fast path takes a subset of the valid lines, so the result doesn't
depend on how lines fall into blocks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lines of a block.
BLOCK = 8192

ATOM_FIELDS = (
    ("record", pa.string()),
    ("serial", pa.int64()),
    ("name", pa.string()),
    ("resname", pa.string()),
    ("chain", pa.string()),
    ("resseq", pa.int64()),
    ("icode", pa.string()),
    ("x", pa.float64()),
    ("y", pa.float64()),
    ("z", pa.float64()),
    ("charge", pa.float64()),
    ("radius", pa.float64()),
)
READING_FIELDS = (
    ("aid", pa.int64()),
    ("cid", pa.int64()),
    ("activity_outcome", pa.string()),
    ("activity_name", pa.string()),
    ("activity_value", pa.float64()),
    ("activity_qualifier", pa.string()),
    ("activity_unit", pa.string()),
    ("protein_accession", pa.string()),
    ("gene_id", pa.int64()),
    ("pmid", pa.int64()),
)
#: The header of assay dumps.
HEADER = ("AID", "CID", "Activity Outcome", "Activity Name", "Activity Value", "Activity Qualifier", "Activity Unit", "Protein Accession", "Gene ID", "PMID")

_DEC = r"[+-]?[0-9]+\.[0-9]+"
#: a decimal behind another: apart, or touching with a minus
_NEXT = r"(?:\s+[+-]?|-)[0-9]+\.[0-9]+"
_FAST_ATOM = (
    r"^(?P<record>ATOM|HETATM)\s+(?P<serial>[0-9]{1,18})\s+(?P<name>[^\s\"]+)\s+(?P<resname>[^\s\"]+)\s+(?P<chain>[A-Za-z0-9]\s+|[A-Za-z])?(?P<resseq>-?[0-9]{1,18})(?P<icode>[A-Za-z]?)"
    rf"\s+(?P<x>{_DEC})(?P<y>{_NEXT})(?P<z>{_NEXT})(?P<charge>{_NEXT})(?P<radius>{_NEXT})\s*$"
)
_INT = r"(?: *[+-]?[0-9]{0,18} *|\" *[+-]?[0-9]{0,18} *\")"
_TXT = r"(?:[^\t\"\r][^\t\r]*|\"[^\t\"\r]*\")?"
_DIGITS = r" *(?:[+-]?(?:[0-9]{1,18}\.?[0-9]{0,18}|\.[0-9]{1,18})(?:[eE][+-]?[0-9]{1,2})?)? *"
_NUM = rf"(?:{_DIGITS}|\"{_DIGITS}\")"
_FAST_READING = (
    rf"^(?P<aid>{_INT})\t(?P<cid>{_INT})\t(?P<activity_outcome>{_TXT})\t(?P<activity_name>{_TXT})\t(?P<activity_value>{_NUM})\t(?P<activity_qualifier>{_TXT})"
    rf"\t(?P<activity_unit>{_TXT})\t(?P<protein_accession>{_TXT})\t(?P<gene_id>{_INT})\t(?P<pmid>{_INT})\r?$"
)


class BlockError(ValueError):
    """A block holds a line that the fast path can't take."""


@dataclass(frozen=True)
class LineFormat:
    """How the lines of one kind of file are parsed."""

    fields: tuple[tuple[str, pa.DataType], ...]
    fast: str
    #: lines that are neither rows nor failures
    skip: Callable[[pa.Array], pa.Array]
    #: one line -> its values or the reason for its failure; None: neither
    strict: Callable[[str], tuple | str | None]
    #: whether a field may stand between quotes
    quoted: bool = False


def typed(groups: pa.StructArray, fmt: LineFormat) -> pa.StructArray:
    """The matched texts of a block as typed columns, by bulk casts; BlockError if any line doesn't fit."""
    if groups.null_count:
        raise BlockError
    out = []
    try:
        for name, kind in fmt.fields:
            text = pc.struct_field(groups, name)
            if fmt.quoted:
                text = pc.replace_substring_regex(text, r'^"([^"]*)"$', r"\1")
            if not pa.types.is_string(kind):
                bare = pc.replace_substring_regex(text, r"^\s*\+?|\s+$", "")
                value = pc.cast(pc.if_else(pc.equal(bare, ""), pa.scalar(None, pa.string()), bare), kind)
                if pa.types.is_floating(kind) and not pc.all(pc.is_finite(value), min_count=0).as_py():
                    raise BlockError
            elif name in ("chain", "icode"):
                bare = pc.utf8_trim_whitespace(text)
                value = pc.if_else(pc.equal(bare, ""), pa.scalar(None, pa.string()), bare)
            else:
                value = text
            out.append(value)
    except pa.ArrowInvalid as e:
        raise BlockError from e
    return pa.StructArray.from_arrays(out, names=[n for n, _ in fmt.fields])


def bisect(groups: pa.StructArray, start: int, test: Callable[[pa.StructArray], object]) -> Iterator[tuple[int, int, object]]:
    """``(first, past, result)`` of the pieces that pass ``test``, and ``(place, place + 1, None)`` of single lines that don't.

    A block that fails is halved until the failing lines are alone.
    """
    if not len(groups):
        return
    try:
        yield start, start + len(groups), test(groups)
    except BlockError:
        if len(groups) == 1:
            yield start, start + 1, None
            return
        half = len(groups) // 2
        yield from bisect(groups[:half], start, test)
        yield from bisect(groups[half:], start + half, test)


def _matched(groups: pa.StructArray) -> bool:
    if groups.null_count:
        raise BlockError
    return True


def parse_block(lines: pa.Array, fmt: LineFormat) -> Iterator[tuple[pa.Array, pa.StructArray | None, list[str]]]:
    """``(places, rows or None, reasons)`` for a block of lines; places of lines that are neither are left out."""
    groups = pc.extract_regex(lines, fmt.fast)
    pieces = list(bisect(groups, 0, _matched))
    alone = [a for a, _, ok in pieces if ok is None]
    clean = pa.array([i for a, b, ok in pieces if ok for i in range(a, b)], pa.int64())
    for a, b, rows in bisect(pc.take(groups, clean), 0, lambda g: typed(g, fmt)):
        if rows is None:
            alone += clean[a:b].to_pylist()
        else:
            yield clean[a:b], rows, []
    said = [(i, fmt.strict(lines[i].as_py())) for i in alone]
    names = [n for n, _ in fmt.fields]
    if rows := [(i, dict(zip(names, x, strict=True))) for i, x in said if isinstance(x, tuple)]:
        yield pa.array([i for i, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.struct(list(fmt.fields))), []
    if why := [(i, x) for i, x in said if isinstance(x, str)]:
        yield pa.array([i for i, _ in why], pa.int64()), None, [x for _, x in why]


# ------------------------------------------------------------------ atom lines
_MINUS = re.compile(r"(?<=[^\seE\-+])-(?=[0-9.])|(?<=[0-9][eE])(?!)")
_RESSEQ = re.compile(r"^([+-]?[0-9]+)([A-Za-z]?)$")
_FUSED = re.compile(r"^([A-Za-z])([+-]?[0-9]+)([A-Za-z]?)$")
_DECIMAL = re.compile(rf"^{_DEC}$|^[+-]?(?:\.[0-9]+|[0-9]+\.)$")


def _is_chain(t: str) -> bool:
    return len(t) == 1 and t.isascii() and t.isalnum()


def strict_atom(line: str) -> tuple | str | None:
    """One atom line: its fields, or 'quoting', 'columns' or 'value'.

    Fields are separated by white space; decimals may touch where a minus parts
    them.  The chain may be absent or touch the residue number.
    """
    words = line.split()
    if not words or words[0] not in ("ATOM", "HETATM"):
        return None
    if line.count('"') % 2:
        return "quoting"
    head, tail = words[:4], []
    for w in words[4:]:
        tail += _MINUS.sub(" -", w).split() if "." in w else [w]
    k = len(tail)
    if len(head) < 4 or k not in (6, 7):
        return "columns"
    a, b = tail[0], tail[1]
    whole = bool(_RESSEQ.match(b)) or "." not in b
    if k == 7:
        # a surplus field behind a line without a chain field
        if not _is_chain(a) and (_RESSEQ.match(a) or _FUSED.match(a)) and all(_DECIMAL.match(t) for t in tail[1:]):
            return "columns"
        chain, number = a, b
        if not _is_chain(chain):
            return "value"
        m = _RESSEQ.match(number)
        icode = m[2] if m else ""
        seq = m[1] if m else None
    else:
        if _is_chain(a) and whole:
            return "columns"  # chain and number, but a later field is missing
        if len(a) == 1 and a.isalpha():
            return "columns"  # a chain, but no number behind it
        if (m := _FUSED.match(a)) is not None:
            chain, seq, icode = m[1], m[2], m[3]
        elif (m := _RESSEQ.match(a)) is not None:
            chain, seq, icode = None, m[1], m[2]
        else:
            return "value" if "." in b else "columns"
    if seq is None or not re.fullmatch(r"[+-]?[0-9]+", head[1]):
        return "value"
    numbers = tail[-5:]
    if not all(_DECIMAL.match(t) for t in numbers):
        return "value"
    values = [float(t) for t in numbers]
    serial, resseq = int(head[1]), int(seq)
    if not all(map(math.isfinite, values)) or max(abs(serial), abs(resseq)) >= 2**63:
        return "value"
    name, resname = (t[1:-1] if len(t) > 2 and t[0] == t[-1] == '"' else t for t in head[2:4])
    return (head[0], serial, name, resname, chain, resseq, icode or None, *values)


def _skip_atom(lines: pa.Array) -> pa.Array:
    return pc.invert(pc.match_substring_regex(lines, r"^\s*(?:ATOM|HETATM)(?:\s|$)"))


# --------------------------------------------------------------- assay readings
_WHOLE = re.compile(r"[+-]?[0-9]+")
_NUMBER = re.compile(r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?")


def split_quoted(line: str) -> list[str] | None:
    """Fields between tabs; a quote at a field's start opens one that must close at its end.  None: broken quoting."""
    out, i, n = [], 0, len(line)
    while True:
        if i < n and line[i] == '"':
            text, i = [], i + 1
            while True:
                j = line.find('"', i)
                if j < 0:
                    return None
                text.append(line[i:j])
                if line.startswith('""', j):
                    text.append('"')
                    i = j + 2
                    continue
                i = j + 1
                break
            if i < n and line[i] != "\t":
                return None
            out.append("".join(text))
        else:
            j = line.find("\t", i)
            j = n if j < 0 else j
            out.append(line[i:j])
            i = j
        if i >= n:
            return out
        i += 1


def strict_reading(line: str) -> tuple | str | None:
    """One dump line: its ten fields, or 'quoting', 'columns' or 'value'; None for header and empty lines."""
    line = line.removesuffix("\n").removesuffix("\r")
    if not line:
        return None
    fields = split_quoted(line)
    if fields is None:
        return "quoting"
    if tuple(f.strip() for f in fields) == HEADER:
        return None
    if len(fields) != 10:
        return "columns"
    out: list = list(fields)
    for i in (0, 1, 8, 9):
        text = fields[i].strip()
        if not text:
            out[i] = None
        elif _WHOLE.fullmatch(text) and text.isascii() and -(2**63) <= int(text) < 2**63:
            out[i] = int(text)
        else:
            return "value"
    text = fields[4].strip()
    if not text:
        out[4] = None
    elif _NUMBER.fullmatch(text) and text.isascii() and math.isfinite(float(text)):
        out[4] = float(text)
    else:
        return "value"
    return tuple(out)


def _skip_reading(lines: pa.Array) -> pa.Array:
    return pc.match_substring_regex(lines, r"^(?:\"?AID\"?\t\"?CID\"?\t\"?Activity Outcome\"?\t.*|\r?)$")


ATOMS = LineFormat(ATOM_FIELDS, _FAST_ATOM, _skip_atom, strict_atom)
READINGS = LineFormat(READING_FIELDS, _FAST_READING, _skip_reading, strict_reading, True)


def parse_lines(lines: DataFrame, fmt: LineFormat, id_col: str = "line_id", line_col: str = "line") -> DataFrame:
    """``id_col, reason, row``: a typed row with NULL reason for a valid line, a reason with NULL row for a failing one.

    NULL lines, headers, empty lines and lines of other kinds give no row.  No
    shuffle; a line is never split, however long it is.
    """
    row_type = pa.struct(list(fmt.fields))
    spark_type = {pa.string(): T.StringType(), pa.int64(): T.LongType(), pa.float64(): T.DoubleType()}
    schema = T.StructType(
        [T.StructField(id_col, lines.schema[id_col].dataType), T.StructField("reason", T.StringType()), T.StructField("row", T.StructType([T.StructField(n, spark_type[t]) for n, t in fmt.fields]))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = batch.column(0), pc.cast(batch.column(1), pa.string())
            # left for parsing: neither NULL nor of another kind; a header that is no exact header is left to the strict parser
            use = pc.and_kleene(pc.is_valid(text), pc.invert(fmt.skip(text)))
            at = pc.indices_nonzero(pc.fill_null(use, False))
            ids, text = pc.take(ids, at), pc.take(text, at)
            for start in range(0, len(at), BLOCK):
                part, keys = text[start : start + BLOCK], ids[start : start + BLOCK]
                for places, rows, why in parse_block(part, fmt):
                    row = rows.cast(row_type) if rows is not None else pa.nulls(len(places), row_type)
                    reason = pa.array(why, pa.string()) if why else pa.nulls(len(places), pa.string())
                    yield pa.RecordBatch.from_arrays([pc.take(keys, places), reason, row], names=[id_col, "reason", "row"])

    return lines.select(id_col, line_col).mapInArrow(run, schema)


def parse_atoms(lines: DataFrame) -> DataFrame:
    return parse_lines(lines, ATOMS)


def parse_readings(lines: DataFrame) -> DataFrame:
    return parse_lines(lines, READINGS)


def valid_rows(parsed: DataFrame, id_col: str = "line_id") -> DataFrame:
    return parsed.where("reason IS NULL").select(id_col, "row.*")


def failures(parsed: DataFrame, id_col: str = "line_id") -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select(id_col, "reason")
