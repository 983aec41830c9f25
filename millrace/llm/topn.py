"""Top N items of every group, by bounded heaps that merge.

Each task keeps a heap of at most N items for every group it has met, with the
worst item at the root: an item enters by comparison with the root alone.  The
heaps, not the rows, are shuffled; those of one group are merged behind the
shuffle the same way.  A group of any size sends at most N rows a task and
flush, so no task gathers it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from heapq import heappush, heappushpop
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.functions.nulls import norm_id

#: Rows a task holds in its heaps before they go out (a group may then go out more than once, which merging allows).
HELD_ROWS = 200_000


class Backwards:
    """A value that compares the other way round, for types that have no negative."""

    __slots__ = ("value",)

    def __init__(self, value: object) -> None:
        self.value = value

    def __eq__(self, other: object) -> bool:
        return self.value == other.value

    def __lt__(self, other: Backwards) -> bool:
        return other.value < self.value


def _last(value: object, numeric: bool) -> tuple:
    """An ascending field as a key whose greater is the better: small values first, then NaN, then NULL.  Numbers keep their type."""
    if value is None:
        return (0,)
    if value != value:
        return (1,)
    return (2, -value if numeric else Backwards(value))


class Heaps:
    """Bounded heaps of rows by group; ``n_keys`` leading fields are the group, then score, ties and the unique field."""

    def __init__(self, n: int, n_keys: int, numeric: Sequence[bool]) -> None:
        self.n, self.n_keys, self.numeric = n, n_keys, numeric
        self.heaps: dict[tuple, list] = {}
        self.rows = 0
        self.arrival = count()

    def add(self, row: tuple) -> None:
        at = self.n_keys
        group, score = row[:at], row[at]
        heap = self.heaps.get(group)
        if heap is None:
            heap = self.heaps[group] = []
        elif len(heap) == self.n and score < heap[0][0][0]:
            return  # worse than the worst that is kept
        key = (score, *map(_last, row[at + 1 :], self.numeric))
        # the order of arrival keeps rows that agree in every field apart; it never decides which values are kept
        item = (key, -next(self.arrival), row)
        if len(heap) < self.n:
            heappush(heap, item)
            self.rows += 1
        else:
            heappushpop(heap, item)

    def drain(self) -> Iterator[list[tuple]]:
        """The rows of each group, best first; the heaps are empty afterwards."""
        for heap in self.heaps.values():
            yield [row for _, _, row in sorted(heap, reverse=True)]
        self.heaps, self.rows = {}, 0


def _tuples(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _early(n: int, n_keys: int, numeric: list[bool], schema: pa.Schema):
    """Before the shuffle: the heaps of all groups of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(n, n_keys, numeric)
        for batch in batches:
            for row in _tuples(batch):
                heaps.add(row)
            if heaps.rows > HELD_ROWS:
                yield _batch([r for rows in heaps.drain() for r in rows], schema)
        if heaps.rows:
            yield _batch([r for rows in heaps.drain() for r in rows], schema)

    return run


def _merged(n: int, n_keys: int, numeric: list[bool], schema: pa.Schema):
    """Behind the shuffle: rows come sorted by group, so closed groups go out with their ranks after each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(n, n_keys, numeric)
        for batch in batches:
            last = None
            for row in _tuples(batch):
                heaps.add(row)
                last = row[:n_keys]
            open_ = heaps.heaps.pop(last, None)
            out = [(*r, i) for rows in heaps.drain() for i, r in enumerate(rows)]
            if open_:
                heaps.heaps[last], heaps.rows = open_, len(open_)
            if out:
                yield _batch(out, schema)
        out = [(*r, i) for rows in heaps.drain() for i, r in enumerate(rows)]
        if out:
            yield _batch(out, schema)

    return run


def top_n(df: DataFrame, keys: Sequence[str], score: str, unique: str, n: int = 5, ties: Sequence[str] = (), rank: str = "rank") -> DataFrame:
    """``keys``, ``score``, ``ties``, ``unique`` and ``rank`` (from 0) of the N rows of greatest score of each group.

    Equal scores are decided by ``ties`` and then ``unique``, ascending, NaN and
    NULL last, so every run gives the same rows.  All fields keep their types and
    values (whole numbers are compared exactly).  Rows with a NULL in a key, and
    rows with a NULL or NaN score, are never chosen.  Repeated rows all count.
    Extra columns are not carried: join them by ``unique`` where they are wanted.
    """
    if n < 1:
        raise ValueError("n must be positive")
    known = F.col(score).isNotNull()
    if isinstance(df.schema[score].dataType, (T.DoubleType, T.FloatType)):
        known = known & ~F.isnan(score)
    for k in keys:
        known = known & F.col(k).isNotNull()
    names = [f"__k{i}" for i in range(len(keys))]
    fields = [*keys, score, *ties, unique]
    held = [*names, "__score", *(f"__t{i}" for i in range(len(ties))), "__unique"]
    slim = df.where(known).select(*(F.col(f).alias(h) for f, h in zip(fields, held)))
    numeric = [isinstance(df.schema[c].dataType, T.NumericType) for c in (*ties, unique)]
    early = slim.mapInArrow(_early(n, len(keys), numeric, to_arrow_schema(slim.schema)), slim.schema)
    ranked = T.StructType([*slim.schema, T.StructField(rank, T.IntegerType())])
    merged = early.repartition(*names).sortWithinPartitions(*names).mapInArrow(_merged(n, len(keys), numeric, to_arrow_schema(ranked)), ranked)
    return merged.select(*(F.col(h).alias(f) for f, h in zip(fields, held)), rank)


def top_poses(poses: DataFrame, n: int = 5) -> DataFrame:
    """``pose_id, pair_rank``: per protein and ligand the poses of highest CNNscore; blank ids form no pair."""
    rows = poses.select("pose_id", norm_id("protein_id").alias("protein"), norm_id("ligand_id").alias("ligand"), "CNNscore", "pose_rank")
    return top_n(rows, ["protein", "ligand"], "CNNscore", "pose_id", n, ["pose_rank"], "pair_rank").select("pose_id", "pair_rank")
