"""Files in and out: JSON lines, whole files, results, merged JSON, line offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; a broken line gives a row of nulls with the line in ``_corrupt``."""
    return spark.read.schema(f"{schema}, _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def read_whole(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, length and content of every file whose name fits the pattern."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "length", "content")


def write_results(df: DataFrame, path: str, by: str = "version") -> None:
    """Appends rows, one folder per value of ``by``; rows of a value are spread over tasks by the rest of the row."""
    df.write.mode("append").partitionBy(by).parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def merged_json(df: DataFrame, group: str) -> DataFrame:
    """One JSON array of the rows of each group, in order of their JSON text. Groups must be small, as one file is."""
    row = F.to_json(F.struct(*[c for c in df.columns if c != group]))
    return df.groupBy(group).agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(row)), ","), F.lit("]")).alias("json"))


def line_offsets(lines: DataFrame, file: str, number: str, text: str) -> DataFrame:
    """Byte offset of every line of a file, as running lengths."""
    order = W.partitionBy(file).orderBy(number).rowsBetween(W.unboundedPreceding, -1)
    return lines.withColumn("offset", F.coalesce(F.sum(F.octet_length(text) + 1).over(order), F.lit(0)))
