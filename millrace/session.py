"""Session settings and the shared folder that lineage is cut into."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings that the operators rely on; a cluster may set more.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with SETTINGS whose executors have the package; ``conf`` keys use double underscores for dots."""
    builder = SparkSession.builder.appName(app).config(map=SETTINGS)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return ship(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset (local tests) a temporary folder is made, and
    removed when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context._jsc.sc().getCheckpointDir().isEmpty():
            context.setCheckpointDir(configured)
        return configured
    known = getattr(context, "_millrace_shared", None)
    if known is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        known = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, known, ignore_errors=True)
        context.setCheckpointDir(known)
        context._millrace_shared = known
    return known


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: the rows are written to the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as a Parquet table in the shared folder and read from there: columnar, compressed, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a table that may be broadcast: as held in memory, about.
BROADCAST_BYTES = 16 << 20


def fits_broadcast(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of ``df`` (checkpointed or stored by the caller) take at most ``most`` bytes: texts by length, 16 for any other field."""
    texts = [f.name for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    each = 16 * (2 + len(df.columns))
    size = df.agg((F.count("*") * each + sum((F.coalesce(F.sum(F.octet_length(f"`{c}`")), F.lit(0)) for c in texts), F.lit(0))).alias("n")).first()[0]
    return size <= most


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Marked for broadcast where its measured size allows it; else Spark shuffles it."""
    return F.broadcast(df) if fits_broadcast(df) else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows over all cores, where the scan has fewer splits than there are cores (one small file); else ``df`` as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package to the executors, unless PYTHONPATH or an installation gives it to them."""
    root = Path(__file__).resolve().parent
    context = spark.sparkContext
    on_path = str(root.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or root.parent.name == "site-packages"
    if on_path or getattr(context, "_millrace_shipped", False):
        return spark
    folder = tempfile.mkdtemp(prefix="millrace-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/millrace.zip", "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(f"{folder}/millrace.zip")
    context._millrace_shipped = True
    return spark
