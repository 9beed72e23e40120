"""Table access: a table is a parquet file or folder named after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.runtime import ship


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table ``name`` under ``root``; column pruning and filters reach the scan."""
    ship(spark)
    return spark.read.parquet(f"{root}/{name}.parquet")


def columns_or_null(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Exactly the columns of ``wanted`` (name to SQL type), absent ones as null, others dropped.

    Operators call it first, so that extra columns with clashing names cannot reach them.
    """
    from pyspark.sql import functions as F

    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[(F.col(f"`{have[c.lower()]}`") if c.lower() in have else F.lit(None)).cast(t).alias(c) for c, t in wanted.items()]
    )
