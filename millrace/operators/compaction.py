"""Many small files into few well-sized ones, nothing lost and nothing twice.

A frozen manifest (one row per file: rows, bytes, checksum) is packed by
first-fit decreasing; each bin is rewritten as one file in a staging folder;
rows and checksums are held against the manifest; one rename commits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.ranks import rank_within
from millrace.session import broadcast_if_small, cut, fresh_path, stored

#: Sizes are rounded up to this many classes between a size and its double (4.4 % at most).
CLASSES = 16


class VerificationError(RuntimeError):
    """Rewritten rows differ from the manifest; nothing was committed."""


@dataclass(frozen=True)
class Compacted:
    """The committed folder, the bins (one file each) and the rows left out as repeats."""

    path: str
    bins: DataFrame
    repeats: DataFrame


def first_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """FFD over sizes with multiplicities: ``(size, first rank, last rank, bin)``.

    Equal bins are kept as runs, so the work follows the number of distinct
    sizes and runs, not of files.  A size over ``capacity`` takes a bin of its own.
    """
    runs: list[list[int]] = []  # [bins, room, first bin], in order of opening
    out: list[tuple[int, int, int, int]] = []
    opened = 0
    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        new: list[list[int]] = []
        for run in runs:
            each = run[1] // size if size else left
            if not left or not each:
                new.append(run)
                continue
            full, rest = divmod(left, each)
            if full >= run[0]:
                full, rest = run[0], 0
            for b in range(full):
                out.append((size, rank, rank + each - 1, run[2] + b))
                rank += each
            left -= full * each
            if full:
                new.append([full, run[1] - each * size, run[2]])
            used = full
            if rest:
                out.append((size, rank, rank + rest - 1, run[2] + full))
                rank, left, used = rank + rest, left - rest, full + 1
                new.append([1, run[1] - rest * size, run[2] + full])
            if used < run[0]:
                new.append([run[0] - used, run[1], run[2] + used])
        runs = new
        if left:
            each = max(1, capacity // size) if size else left
            full, rest = divmod(left, each)
            for b in range(full + bool(rest)):
                n = each if b < full else rest
                out.append((size, rank, rank + n - 1, opened + b))
                rank += n
            if full:
                runs.append([full, max(0, capacity - each * size), opened])
            if rest:
                runs.append([1, max(0, capacity - rest * size), opened + full])
            opened += full + bool(rest)
    return out


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: text by its length, 8 for any other field."""
    return sum((F.coalesce(F.octet_length(f.name), F.lit(0)) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.lit(8) for f in df.schema), F.lit(0))


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of all fields of a row, with NULLs told from blanks."""
    marked = [F.col(f"`{c}`") for c in df.columns] + [F.concat_ws("", *(F.when(F.col(f"`{c}`").isNull(), "n").otherwise("v") for c in df.columns))]
    return F.xxhash64(*marked)


def checksum(h: str) -> list[Column]:
    """``sum_high, sum_low``: a mergeable checksum of the row hashes ``h``; two sums of 32 bits, which 2^31 rows can't overflow."""
    return [F.sum(F.shiftright(h, 32)).alias("sum_high"), F.sum(F.col(h).bitwiseAND(F.lit(0xFFFFFFFF))).alias("sum_low")]


SUMS = ("sum_high", "sum_low")


def manifest(rows: DataFrame) -> DataFrame:
    """``file, n_rows, n_bytes, sum_high, sum_low`` of each file of ``rows`` (file, n_bytes, hash), frozen in the shared folder.  A NULL file is a file of its own."""
    return cut(rows.groupBy("file").agg(F.count("*").alias("n_rows"), F.sum("n_bytes").cast("bigint").alias("n_bytes"), *checksum("hash")))


def pack(files: DataFrame, target_bytes: int) -> DataFrame:
    """``files`` with ``bin``: first-fit decreasing by size class, up to ``target_bytes`` a bin.

    The driver packs the histogram of size classes (some hundred, whatever the
    number of files); files take their bin by their rank among files of their
    class, so their list never leaves the executors.
    """
    upper = F.ceil(F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(1), F.col("n_bytes"))) * CLASSES) / CLASSES))
    sized = cut(files.withColumn("size", F.least(F.lit(target_bytes + 1), F.greatest(F.lit(1), upper)).cast("bigint")))
    counts = {r["size"]: r["count"] for r in sized.groupBy("size").count().collect()}
    plan = first_fit_decreasing(counts, target_bytes)
    spark = files.sparkSession
    ranges = spark.createDataFrame(plan, "size long, first long, last long, bin long")
    places = ranges.select("size", F.explode(F.sequence("first", "last")).alias("rank"), "bin")
    return rank_within(sized, ["size"], ["file"]).join(places, ["size", "rank"]).drop("size", "rank")


def _record(df: DataFrame, record: dict[str, Column]) -> dict[str, Column]:
    """The fields that are compared: -0.0 is 0.0."""
    return {n: (c + F.lit(0.0) if isinstance(df.select(c).schema[0].dataType, (T.DoubleType, T.FloatType)) else c) for n, c in record.items()}


def _record_hash(fields: dict[str, Column]) -> Column:
    return F.xxhash64(*fields.values(), F.concat_ws("", *(F.when(c.isNull(), "n").otherwise("v") for c in fields.values())))


def repeated_rows(df: DataFrame, id_col: str, record: dict[str, Column], hashes: DataFrame | None = None) -> DataFrame:
    """Ids of the rows for which a row of smaller id holds the same record.

    NULL equals NULL and NaN equals NaN.  A 64-bit hash per row (``hashes`` with
    a column ``record``, where the caller has them stored) finds the few
    candidates; its counts combine on the map side.  Candidates are compared
    field by field with the first row of their record, in a salted equi-join, so
    that a record delivered millions of times stays spread.
    """
    fields = _record(df, record)
    rows = df.select(F.col(id_col).alias("__id"), *(c.alias(n) for n, c in fields.items()), _record_hash(fields).alias("__h"))
    hashes = rows.select(F.col("__h").alias("record")) if hashes is None else hashes
    again = cut(hashes.groupBy(F.col("record").alias("__h")).agg(F.count("*").alias("__n")).where("__n > 1").select("__h"))
    candidates = stored(rows.join(broadcast_if_small(again), "__h", "left_semi"), "candidates")
    firsts = cut(candidates.groupBy("__h", *fields).agg(F.min("__id").alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n"))
    salts = 8
    firsts = firsts.select(F.col("__h").alias("__fh"), *(F.col(n).alias(f"__f_{n}") for n in fields), "__first")
    firsts = firsts.withColumn("__fs", F.explode(F.array(*(F.lit(i) for i in range(salts)))))
    same = (F.col("__h") == F.col("__fh")) & (F.pmod(F.xxhash64("__id"), F.lit(salts)) == F.col("__fs")) & (F.col("__id") > F.col("__first"))
    for n in fields:
        same = same & F.col(n).eqNullSafe(F.col(f"__f_{n}"))
    return candidates.join(firsts, same).select(F.col("__id").alias(id_col))


def compact(
    df: DataFrame, file_col: str, id_col: str, record: dict[str, Column] | None = None, target_bytes: int = 128 << 20, path: str | None = None
) -> Compacted:
    """Rewrite the rows of ``df`` by bins of source files; commit only when rows and checksums agree.

    ``record`` names the fields that make two rows the same record; of those
    only the row of the smallest id is written, and the others are returned as
    ``repeats``.  Extra columns are written as they are; a column of ``df``
    called ``bin`` is refused.  ``df`` is read once for sizes and hashes (kept as
    a slim table), once for candidates of repeats, and once to be rewritten.
    """
    if "bin" in df.columns:
        raise ValueError("a column named bin is in the way")
    spark = df.sparkSession
    known = _record_hash(_record(df, record)) if record else F.lit(0).cast("bigint")
    slim = stored(df.select(F.col(file_col).alias("file"), row_bytes(df).cast("bigint").alias("n_bytes"), row_hash(df).alias("hash"), known.alias("record")), "hashes")
    packed = cut(pack(manifest(slim), target_bytes))
    repeats = cut(repeated_rows(df, id_col, record, slim)) if record else df.select(id_col).limit(0)
    where = cut(packed.select(F.col("file").alias("__file"), "bin", F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / target_bytes)).cast("int").alias("__parts")))
    placed = df.join(broadcast_if_small(where), F.col(file_col).eqNullSafe(F.col("__file"))).drop("__file")
    dropped = repeats.select(F.col(id_col).alias("__gone"), F.lit(True).alias("__repeat"))
    dropped = broadcast_if_small(dropped) if record else dropped
    placed = placed.join(dropped, F.col(id_col) == F.col("__gone"), "left").drop("__gone")
    keep = F.col("__repeat").isNull()
    staging, final = fresh_path(spark, "staging"), path or fresh_path(spark, "compacted")
    # a file over the target is cut into parts by row, so no task writes more than about one bin
    salted = placed.withColumn("__part", F.pmod(F.xxhash64(id_col), F.col("__parts")))
    ordered = salted.repartition("bin", "__part").drop("__parts", "__part")
    ordered.withColumn("__state", F.when(keep, "rows").otherwise("repeats")).drop("__repeat").write.partitionBy("__state", "bin").parquet(staging)
    back = spark.read.schema(T.StructType([*df.schema, T.StructField("__state", T.StringType()), T.StructField("bin", T.LongType())])).parquet(staging)
    written = back.select("bin", "__state", row_hash(df).alias("hash")).groupBy("bin").agg(
        F.count("*").alias("n_written"), F.count(F.when(F.col("__state") == "rows", 1)).alias("n_kept"), *(c.alias(f"{n}_written") for c, n in zip(checksum("hash"), SUMS))
    )
    due = packed.groupBy("bin").agg(F.count("*").alias("n_files"), *(F.sum(c).alias(c) for c in ("n_rows", "n_bytes", *SUMS)))
    bins = cut(due.join(written, "bin", "full"))
    agree = F.col("n_rows").eqNullSafe(F.col("n_written"))
    for c in SUMS:
        agree = agree & F.col(c).eqNullSafe(F.col(f"{c}_written"))
    wrong = bins.where(~agree).limit(5).collect()
    if wrong:
        raise VerificationError(f"bins that differ from the manifest: {wrong}")
    _rename(spark, staging, final)
    bins = bins.select("bin", "n_files", "n_rows", "n_kept", "n_bytes").withColumn("verified", F.lit(True))
    # the repeats are read from the committed folder; the rows to use lie in __state=rows
    gone = spark.read.schema(back.schema).parquet(final).where("__state = 'repeats'").select(id_col)
    return Compacted(final, bins, gone)


def compact_folder(spark: SparkSession, source: str, target: str, kind: str = "parquet", target_bytes: int = 128 << 20, **options: str) -> DataFrame:
    """A folder of small files rewritten as few files of about ``target_bytes`` below ``target``; ``bin, n_files, n_rows, n_bytes, verified``.

    The manifest is the listing as it stands at the start, with the sizes on
    disk; files that arrive later are not read, and a listed file that is gone
    or has changed fails the job.  Rows and checksums of each bin are held against those
    of its source files before one rename commits.  ``kind`` and ``options`` are
    those of Spark's reader; the rows are written as Parquet.  Files
    without rows need no place; a folder without rows gives no bin.
    """
    df = spark.read.options(**{"recursiveFileLookup": "true", **options}).format(kind).load(source)
    clash = {"bin", "__file"} & set(df.columns)
    if clash:
        raise ValueError(f"columns in the way: {sorted(clash)}")
    # the reader holds one listing, which all passes share
    rows = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_size").alias("__size"))
    listed = rows.select(F.col("__file").alias("file"), F.col("__size").alias("n_bytes"), row_hash(df).alias("hash"))
    frozen = cut(listed.groupBy("file").agg(F.count("*").alias("n_rows"), F.max("n_bytes").alias("n_bytes"), *checksum("hash")))
    if not frozen.take(1):
        return spark.createDataFrame([], "bin long, n_files long, n_rows long, n_bytes long, verified boolean")
    packed = cut(pack(frozen, target_bytes))
    parts = cut(packed.select(F.col("file").alias("__at"), "bin", F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / target_bytes)).cast("int").alias("__parts")))
    placed = rows.join(broadcast_if_small(parts), F.col("__file") == F.col("__at")).withColumn("__part", F.pmod(row_hash(df), F.col("__parts")))
    staging = fresh_path(spark, "staging")
    placed.repartition("bin", "__part").drop("__file", "__size", "__at", "__parts", "__part").write.partitionBy("bin").parquet(staging)
    want = packed.groupBy("bin").agg(F.count("*").alias("n_files"), *(F.sum(c).alias(c) for c in ("n_rows", "n_bytes", *SUMS)))
    back = spark.read.schema(T.StructType([*df.schema, T.StructField("bin", T.LongType())])).parquet(staging)
    got = back.select("bin", row_hash(df).alias("hash")).groupBy("bin").agg(F.count("*").alias("n_written"), *(c.alias(f"{n}_written") for c, n in zip(checksum("hash"), SUMS)))
    bins = cut(want.join(got, "bin", "full"))
    agree = (F.col("n_rows") == F.col("n_written")) & (F.col("sum_high") == F.col("sum_high_written")) & (F.col("sum_low") == F.col("sum_low_written"))
    wrong = bins.where(~F.coalesce(agree, F.lit(False))).limit(5).collect()
    if wrong:
        raise VerificationError(f"bins that differ from the manifest: {wrong}")
    _rename(spark, staging, target)
    return bins.select("bin", "n_files", "n_rows", "n_bytes").withColumn("verified", F.lit(True))


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """The commit: one rename of the folder."""
    jvm = spark.sparkContext._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(dst):
        raise FileExistsError(target)
    if dst.getParent() is not None:
        fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"{source} can't be renamed to {target}")


def read_compacted(spark: SparkSession, path: str) -> DataFrame:
    """The kept rows of a committed folder."""
    return spark.read.parquet(f"{path}/__state=rows")
