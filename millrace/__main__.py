"""Command line: ``python -m millrace COMMAND ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import functions as F

from millrace.operators import assays
from millrace.operators.pose_store import PoseStore
from millrace.session import build_session, ship
from millrace.sources import tables
from millrace.sources.parquet_store import ParquetStore


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="millrace")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("ingest-dump", help="tab-separated dump into a typed table")
    c.add_argument("source")
    c.add_argument("target")
    c.add_argument("--partitions", type=int, default=0)
    c = sub.add_parser("enrich", help="measurements of an outcome with properties")
    c.add_argument("measurements")
    c.add_argument("properties")
    c.add_argument("target")
    c.add_argument("--outcome", default="active", help="'all' keeps every outcome")
    c.add_argument("--columns", nargs="+", default=["SMILES", "MolecularWeight"])
    c.add_argument("--limit", type=int, default=0)
    c = sub.add_parser("build-poses", help="docked files into a pose store")
    c.add_argument("root")
    c.add_argument("store")
    c.add_argument("--modes", type=int, default=9)
    c.add_argument("--overwrite", action="store_true")
    c.add_argument("--keep-blocks", action="store_true")
    c = sub.add_parser("top-poses", help="best poses of each pair")
    c.add_argument("store")
    c.add_argument("target")
    c.add_argument("--score", default="CNNscore")
    c.add_argument("-n", type=int, default=5)
    c = sub.add_parser("repack", help="pose store into batches of proteins")
    c.add_argument("store")
    c.add_argument("target")
    c.add_argument("--per-batch", type=int, default=200)
    return p


def main(words: Sequence[str] | None = None) -> int:
    a = parser().parse_args(words)
    spark = ship(build_session())
    if a.command == "ingest-dump":
        ParquetStore(spark, a.target).write(tables.typed_readings(tables.read_dump(spark, a.source, a.partitions)))
    elif a.command == "enrich":
        rows = spark.read.parquet(a.measurements)
        rows = rows if a.outcome == "all" else assays.with_outcome(rows, a.outcome)
        out = assays.enrich(rows.where(F.col("cid").isNotNull()), assays.latest_properties(spark.read.parquet(a.properties), a.columns))
        out = out.orderBy("cid").limit(a.limit) if a.limit else out
        ParquetStore(spark, a.target).write(out)
        return int(not spark.read.parquet(a.target).take(1))
    elif a.command == "build-poses":
        PoseStore(spark, a.store).build(a.root, a.modes, a.overwrite, a.keep_blocks).show(truncate=False)
    elif a.command == "top-poses":
        ParquetStore(spark, a.target).write(PoseStore(spark, a.store).top_per_pair(a.score, a.n))
    elif a.command == "repack":
        PoseStore(spark, a.store).to_batches(a.target, a.per_batch).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
