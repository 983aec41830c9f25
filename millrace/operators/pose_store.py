"""A folder of poses by protein: build from docked files, read, rank, repack."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import poses as P
from millrace.operators import ranking
from millrace.operators.similarity import iter_batches
from millrace.schemas import POSE, struct_of
from millrace.sources import sdf


class PoseStore:
    """Poses under ``path/protein=...``; the record's text may be kept in a column ``block``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def __repr__(self) -> str:
        return f"PoseStore({self.path!r})"

    @property
    def schema(self):  # noqa: ANN201
        return struct_of(POSE)

    def exists(self) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def table(self) -> DataFrame:
        """All poses; ``protein`` is the partition, so filters on it prune folders.  An empty store gives no rows."""
        if not self.exists():
            return self.spark.createDataFrame([], self.schema).withColumn("protein", F.lit(None).cast("string"))
        return self.spark.read.option("mergeSchema", "true").parquet(self.path)

    def build(self, root: str, modes: int | Sequence[int] | None = 9, overwrite: bool = False, keep_blocks: bool = False, allow_truncated: bool = True) -> DataFrame:
        """Parses a tree of docked files; proteins that the store holds are skipped unless ``overwrite``.  Returns the rows per protein."""
        texts = sdf.read_texts(self.spark, sdf.docking_tree(root))
        if not allow_truncated:
            sdf.require_complete(texts)
        return self.add(sdf.poses_of(sdf.split_blocks(texts), modes), overwrite, keep_blocks)

    def add(self, rows: DataFrame, overwrite: bool = False, keep_blocks: bool = False) -> DataFrame:
        if not keep_blocks:
            rows = rows.drop("block")
        if not overwrite and self.exists():
            rows = rows.join(F.broadcast(self.protein_ids()), "protein_id", "left_anti").select(*rows.columns)
        counted = rows.withColumn("protein", F.col("protein_id"))
        counted.repartition("protein").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("protein").parquet(self.path)
        return self.stats()

    def read_protein(self, protein: str) -> DataFrame:
        """Rows of one protein; KeyError if the store lacks it."""
        df = self.table().where(F.col("protein") == protein)
        if not df.take(1):
            raise KeyError(protein)
        return df

    def read_proteins(self, proteins: Sequence[str]) -> DataFrame:
        """Rows of those of the proteins that the store holds."""
        return self.table().where(F.col("protein").isin(list(proteins)))

    def read_all(self, **equal: object) -> DataFrame:
        return P.keyword_filter(self.table(), **equal)

    def read_block(self, protein: str, row: int) -> str:
        """Text of the row's record, rows counted in the order of file and offset."""
        r = P.row_slice(self.read_protein(protein).select("source_file", "block_start", "block"), ["source_file", "block_start"], row, row + 1).take(1)
        if not r:
            raise IndexError(row)
        return r[0]["block"]

    def iter_batches(self, protein: str | None = None, size: int = 200, **equal: object) -> Iterator[list]:
        df = self.read_protein(protein) if protein else self.table()
        return iter_batches(P.keyword_filter(df, **equal), size)

    def protein_ids(self) -> DataFrame:
        return self.table().select(F.col("protein").alias("protein_id")).where("protein_id IS NOT NULL").distinct()

    def stats(self) -> DataFrame:
        return self.table().groupBy(F.col("protein").alias("protein_id")).agg(F.count("*").alias("n_poses"))

    def top_per_pair(self, score: str = "CNNscore", n: int = 5, keys: Sequence[str] = ("protein_id", "ligand_id"), rank_col: str | None = "pair_rank") -> DataFrame:
        return ranking.top_n(self.table(), keys, score, n, ties=["block_start", "source_file"], rank_col=rank_col)

    def to_batches(self, path: str, per_batch: int = 200, rows_per_file: int = 50_000) -> DataFrame:
        """Repacked by groups of proteins; returns the manifest of batch names."""
        P.write_batches(self.table().drop("protein"), path, per_batch, rows_per_file)
        return P.protein_batches(self.table(), per_batch)
