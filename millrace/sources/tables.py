"""Text tables: assay dumps, sequence headers, cluster lists, SMILES files, gzip by any suffix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.nulls import lenient_double, null_to_blank, strict_long
from millrace.schemas import DUMP_COLUMNS

#: Spellings of a missing field in a dump.
MISSING = ("", "NULL", "null")


def read_dump(spark: SparkSession, path: str, partitions: int = 0) -> DataFrame:
    """A tab-separated dump with header, ten text columns, missing fields as NULL.

    A gzip file can't be split: give ``partitions`` to spread it after reading.
    """
    schema = ", ".join(f"`{c}` string" for c in DUMP_COLUMNS)
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    df = df.select(*(F.when(~F.col(f"`{c}`").isin(*MISSING), F.col(f"`{c}`")).alias(c) for c in DUMP_COLUMNS))
    return df.repartition(partitions) if partitions else df


def typed_readings(dump: DataFrame) -> DataFrame:
    """Dump rows as typed readings: whole numbers or NULL, lenient values, blank for missing text."""
    types = {"aid": strict_long, "cid": strict_long, "target_geneid": strict_long, "pubmed_id": strict_long, "activity_value": lenient_double}
    return dump.select(*(types.get(new, null_to_blank)(F.col(f"`{old}`")).alias(new) for old, new in DUMP_COLUMNS.items()))


def load_assay(dump: DataFrame, aid: int | str) -> DataFrame:
    """Rows of one assay: equality on the text column, which reaches the Parquet scan."""
    return dump.where(F.col("AID") == str(aid))


def fasta_headers(lines: DataFrame, delimiter: str | None = None, line: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``header`` of each sequence, up to the delimiter if one is given, behind the columns to keep."""
    text = F.regexp_replace(F.col(line), r"^>+|\s+$", "")
    return lines.where(F.col(line).startswith(">")).select(*keep, (F.substring_index(text, delimiter, 1) if delimiter else text).alias("header"))


def fasta_text(sequences: DataFrame, key: str, sequence: str, order: str) -> DataFrame:
    """``value``: header and sequence of the first row (by ``order``) of each key; blank sequences are left out."""
    first = sequences.where(F.length(F.trim(F.coalesce(sequence, F.lit("")))) > 0).groupBy(key).agg(F.min_by(sequence, order).alias("__s"))
    return first.select(F.concat(F.lit(">"), F.col(key).cast("string"), F.lit("\n"), F.col("__s")).alias("value"))


def cluster_members(spark: SparkSession, path: str) -> DataFrame:
    """``cluster, members`` (sorted list) of a two-column list without header."""
    pairs = spark.read.schema("cluster string, member string").option("sep", "\t").csv(path)
    return pairs.groupBy("cluster").agg(F.sort_array(F.collect_list("member")).alias("members"))


def list_column(c: Column | str) -> Column:
    """A list that a CSV cell holds as text (``['a', 'b']``) as an array."""
    c = F.col(c) if isinstance(c, str) else c
    return F.from_json(F.regexp_replace(c, "'", '"'), "array<string>")


def smiles_lines(rows: DataFrame, smiles: str = "smiles", cid: str = "actives", tag: str = "pubmed") -> DataFrame:
    """``value``: ``{smiles} {cid}_{tag}``; rows without a structure or tag are left out."""
    ok = F.col(smiles).isNotNull() & (F.col(smiles) != "") & F.col(tag).isNotNull() & ~F.coalesce(F.isnan(F.col(tag).try_cast("double")), F.lit(False))
    return rows.where(ok).select(F.concat_ws("", F.col(smiles), F.lit(" "), F.col(cid).cast("string"), F.lit("_"), F.col(tag).cast("string")).alias("value"))


def line_chunks(lines: DataFrame, file: str, order: str, size: int = 250) -> DataFrame:
    """Adds ``chunk`` (from 1) of at most ``size`` lines per file."""
    if size < 1:
        raise ValueError("size must be positive")
    rn = F.row_number().over(Window.partitionBy(file).orderBy(order))
    return lines.withColumn("chunk", (F.floor((rn - 1) / size) + 1).cast("int"))


def gunzipped(spark: SparkSession, path: str) -> DataFrame:
    """``source_file, text`` of files whose gzip is not told by a ``.gz`` suffix; the suffix keeps its inner part."""

    @F.pandas_udf("string")
    def unpack(content):  # noqa: ANN001, ANN202
        import gzip

        return content.map(lambda b: gzip.decompress(b).decode("utf-8", "replace") if b[:2] == b"\x1f\x8b" else b.decode("utf-8", "replace"))

    files = spark.read.format("binaryFile").load(path)
    name = F.regexp_replace(F.regexp_replace("path", r"\.gz$", ""), r"\.(\w+)gz$", r".$1")
    return files.select(name.alias("source_file"), unpack("content").alias("text"))


def with_md5(spark: SparkSession, path: str) -> DataFrame:
    """``source_file, md5`` of whole files."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("source_file"), F.md5("content").alias("md5"))
