"""Hierarchical HDF5 assay files into flat tables, where h5py is installed."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from millrace.schemas import ASSAY_COMPOUND


def available() -> bool:
    try:
        import h5py  # noqa: F401
    except ImportError:
        return False
    return True


def assay_compounds(spark: SparkSession, path: str) -> DataFrame:
    """``aid, cid, smiles, exact_mass`` of ``/aids/{aid}/cids/{cid}`` groups; raises without h5py."""
    if not available():
        raise RuntimeError("h5py is not installed")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        import h5py

        def text(v) -> str | None:  # noqa: ANN001
            v = v[()] if hasattr(v, "shape") else v
            return v.decode() if isinstance(v, bytes) else (None if v is None else str(v))

        for b in batches:
            rows = []
            for content in b["content"]:
                with h5py.File(io.BytesIO(content), "r") as f:
                    for aid, group in f["aids"].items():
                        for cid, item in group.get("cids", {}).items():
                            mass = item.get("exact_mass")
                            rows.append((int(aid), int(cid), text(item.get("smiles")), None if mass is None else float(mass[()])))
            yield pd.DataFrame(rows, columns=["aid", "cid", "smiles", "exact_mass"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, ASSAY_COMPOUND)
