"""Parquet tables: filtered scans, required columns, codecs, nested structs to CSV."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Codecs that may be asked for; brotli needs a codec class that this build of Spark lacks.
CODECS = ("snappy", "zstd", "gzip", "lz4", "none", "brotli")
_OPS: dict[str, Callable[[Column, object], Column]] = {
    "==": lambda c, v: c == v,
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),  # type: ignore[call-overload]
    "not in": lambda c, v: ~c.isin(list(v)),  # type: ignore[call-overload]
}


def predicate(filters: Column | Sequence | None) -> Column | None:
    """A Column, one AND-list of ``(column, op, value)``, or an OR-list of AND-lists."""
    if filters is None or isinstance(filters, Column):
        return filters
    groups = filters if filters and isinstance(filters[0], list) else [filters]
    out: Column | None = None
    for group in groups:
        both: Column | None = None
        for name, op, value in group:
            if op not in _OPS:
                raise ValueError(f"unknown comparison {op!r}")
            one = _OPS[op](F.col(f"`{name}`"), value)
            both = one if both is None else both & one
        if both is not None:
            out = both if out is None else out | both
    return out


class ParquetStore:
    """One Parquet file or folder.  Reads are lazy; filters and columns reach the scan."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None, codec: str = "snappy") -> None:
        if codec not in CODECS:
            raise ValueError(f"codec {codec!r} is none of {CODECS}")
        self.spark, self.path, self.declared, self.codec = spark, path, schema, codec

    @property
    def schema(self) -> T.StructType:
        """The declared schema, else that of the files."""
        return self.declared or self.spark.read.parquet(self.path).schema

    def scan(self) -> DataFrame:
        reader = self.spark.read.schema(self.declared) if self.declared else self.spark.read
        return reader.parquet(self.path)

    def read(self, columns: Sequence[str] | None = None, filters: Column | Sequence | None = None) -> DataFrame:
        df = self.scan()
        where = predicate(filters)
        if where is not None:
            df = df.where(where)
        return df.select(*(f"`{c}`" for c in columns)) if columns else df

    def read_required(self, required: Sequence[str]) -> DataFrame:
        """The named columns; ValueError names those that are missing."""
        df = self.scan()
        missing = [c for c in required if c not in df.columns]
        if missing:
            raise ValueError(f"{self.path} lacks the columns {missing}")
        return df.select(*(f"`{c}`" for c in required))

    def where(self, column: str, condition: Callable[[Column], Column]) -> DataFrame:
        """Rows for which the callable holds on the column; it gets a Column, so the scan sees the predicate."""
        return self.scan().where(condition(F.col(f"`{column}`")))

    def metadata(self) -> DataFrame:
        """``file, n_rows, n_columns, n_row_groups`` from the footers, read by the executors."""
        paths = self.scan().select(F.col("_metadata.file_path").alias("file")).distinct()

        def run(batches):  # noqa: ANN001, ANN202
            import pandas as pd
            import pyarrow.parquet as pq

            for b in batches:
                rows = []
                for f in b["file"]:
                    m = pq.ParquetFile(f.removeprefix("file://").removeprefix("file:")).metadata
                    rows.append((f, m.num_rows, m.num_columns, m.num_row_groups))
                yield pd.DataFrame(rows, columns=["file", "n_rows", "n_columns", "n_row_groups"])

        return paths.mapInPandas(run, "file string, n_rows long, n_columns long, n_row_groups long")

    def write(self, df: DataFrame, mode: str = "overwrite", rows_per_file: int = 0, group_bytes: int = 0, partition_by: Sequence[str] = ()) -> None:
        """Writes with the store's codec; row groups are sized in bytes, files by rows."""
        if self.codec == "brotli":
            raise ValueError("this build of Spark has no brotli codec")
        w = df.write.mode(mode).option("compression", "uncompressed" if self.codec == "none" else self.codec)
        if rows_per_file:
            w = w.option("maxRecordsPerFile", rows_per_file)
        if group_bytes:
            w = w.option("parquet.block.size", group_bytes)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path)
        self.declared = None if mode == "overwrite" else self.declared

    def append(self, df: DataFrame) -> None:
        """The incremental writer."""
        self.write(df, "append")

    def create(self) -> None:
        """An empty table of the declared schema, which needs a column at least."""
        if not self.declared or not self.declared.fields:
            raise ValueError("an empty table needs a schema with a column")
        schema = self.declared
        self.write(self.spark.createDataFrame([], schema))
        self.declared = schema

    def to_csv(self, path: str, mode: str = "overwrite") -> None:
        flatten(self.scan()).write.mode(mode).option("header", True).csv(path)


def flatten(df: DataFrame) -> DataFrame:
    """Struct fields as columns named ``a.b.c``; arrays and maps as JSON text."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[tuple[tuple[str, ...], T.DataType]]:
        out = []
        for f in schema:
            here = (*path, f.name)
            out += leaves(f.dataType, here) if isinstance(f.dataType, T.StructType) else [(here, f.dataType)]
        return out

    cols = []
    for path, kind in leaves(df.schema, ()):
        c = F.col(".".join(f"`{p}`" for p in path))
        cols.append((F.to_json(c) if isinstance(kind, (T.ArrayType, T.MapType)) else c).alias(".".join(path)))
    return df.select(*cols)


def to_table(df: DataFrame):  # noqa: ANN201
    """Arrow table on the driver: for results of a known small size only."""
    return df.toArrow()
