"""Catalog scans: latest versions, ordered batches, keys of stored objects, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.runtime import materialize

# File extensions that are taken as they are, and those that are converted.
READABLE = (".mobi", ".epub", ".pdf", ".fb2", ".svg", ".txt", ".xps", ".cbz", ".none")
CONVERTED = ((".azw3", ".epub"), (".djvu", ".pdf"))
BATCH_ROWS = 4
POD_ROWS, SECONDS_PER_ROW = 50_000, 100


def latest(df: DataFrame, keys: list[str], version: Column, ties: list[Column]) -> DataFrame:
    """One row per key: the one of the highest version, ties by ``ties`` (all ascending). Null versions come last.

    An aggregation with map-side combine, so that a hot key costs one row per task, not a sorted group.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    best = df.groupBy(*keys).agg(F.max_by(row, F.struct(F.coalesce(version, F.lit("").cast(df.select(version).schema[0].dataType)), *ties)).alias("r"))
    return best.select("r.*")


def ranked(df: DataFrame, partition: str, order: list[str], name: str = "rank") -> DataFrame:
    """Row number within ``partition`` by ``order``, without gathering a partition in one task.

    Rows are sorted into ranges over (partition, order); each range is numbered by itself and shifted by
    the counts of the ranges before it, of which there is one small row per range and partition value.
    """
    sorted_rows = materialize(
        df.repartitionByRange(F.col(partition), *[F.col(c) for c in order]).sortWithinPartitions(partition, *order).withColumn("_range", F.spark_partition_id())
    )
    counts = sorted_rows.groupBy("_range", partition).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(partition).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shifts = counts.select("_range", F.col(partition).alias("_p"), before.alias("_before"))
    local = F.row_number().over(W.partitionBy("_range", partition).orderBy(*order))
    numbered = sorted_rows.withColumn("_local", local)
    joined = numbered.join(shifts, (numbered["_range"] == shifts["_range"]) & numbered[partition].eqNullSafe(shifts["_p"]))
    return joined.select(*[numbered[c] for c in df.columns], (F.col("_local") + F.col("_before")).cast("long").alias(name))


def batches(rows: DataFrame, partition: str, rank: str = "rank", size: int = BATCH_ROWS) -> DataFrame:
    """(partition, batch_no, taken_start, taken_end, items): slices of ``size`` rows; taken_end may pass the count."""
    sliced = rows.withColumn("batch_no", F.floor((F.col(rank) - 1) / size).cast("long"))
    return sliced.groupBy(partition, "batch_no").agg(
        (F.min(rank) - 1).alias("taken_start"), (F.min(rank) - 1 + size).alias("taken_end"), F.array_sort(F.collect_list(F.struct(rank, "id"))).alias("items")
    )


def json_fields(df: DataFrame, column: str = "attribute2") -> DataFrame:
    """Extension and language out of JSON text; null where it is null, broken or lacks them."""
    return df.withColumn("file_extension", F.get_json_object(column, "$.extension")).withColumn("language", F.get_json_object(column, "$.language"))


def normal_extension(c: Column) -> Column:
    """Lower-case extension with its dot, .pdf for null, converted kinds as what they become, null for unknown kinds."""
    dotted = F.when(c.isNull(), F.lit(".pdf")).otherwise(F.concat(F.lit("."), F.lower(c)))
    out = F.when(dotted.isin(*READABLE), dotted)
    for a, b in CONVERTED:
        out = F.when(dotted == a, F.lit(b)).otherwise(out)
    return out


def result_key(version: Column, run: Column) -> Column:
    """Key of a result object."""
    return F.concat_ws("/", F.lit("results"), version, run, F.concat(run, F.lit(".mmd")))


def key_prefix(c: Column, default: str) -> Column:
    """The first two steps of an object key, with the slash; a default where there are fewer."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"^(.*?/.*?)/", 1), F.lit("")), F.lit(default))


def merge_update(base: DataFrame, update: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of ``base`` with the non-null values of ``update`` put in."""
    u = update.select(F.col(key), *[F.col(c).alias(f"_{c}") for c in columns])
    return base.join(u, key, "left").select(*[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns])
