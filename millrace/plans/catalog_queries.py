"""Queries over the catalog and the event log (survey ids S*, Q*, D8), with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import catalog as C
from millrace.sources.tables import table
from millrace.streaming.counters import q13_daily_stream


def _latest(spark: SparkSession, root: str) -> DataFrame:
    df = table(spark, root, "data_catalog")
    return C.latest(df, ["version", "id"], F.col("modify_time"), [F.coalesce("attribute2", F.lit("")), F.coalesce("title", F.lit("")), F.coalesce("doi", F.lit("")), F.coalesce("loaded_at", F.timestamp_seconds(F.lit(0)))])


_LATEST = """(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY version, id ORDER BY coalesce(modify_time, '') DESC,
  coalesce(attribute2, '') DESC, coalesce(title, '') DESC, coalesce(doi, '') DESC, coalesce(loaded_at, TIMESTAMP '1970-01-01') DESC) AS rn FROM data_catalog) WHERE rn = 1)"""


def d8_latest_version(spark: SparkSession, root: str) -> DataFrame:
    return _latest(spark, root).select("version", "id", "modify_time", "title", "attribute2")


def s1_catalog_scan(spark: SparkSession, root: str) -> DataFrame:
    """The catalog with its JSON-derived columns, in place of paging."""
    return C.json_fields(_latest(spark, root)).select("id", "version", "doi", "path", "pdf_path", "attribute2", "file_extension", "language")


def s3_counts(spark: SparkSession, root: str) -> DataFrame:
    return _latest(spark, root).groupBy("version").agg(F.count("*").alias("n_rows"))


def s5_dynamic_filter(spark: SparkSession, root: str) -> DataFrame:
    """Count under a map of column = value conditions."""
    wanted = {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}
    df = table(spark, root, "orders")
    for column, value in wanted.items():
        df = df.filter(F.col(column) == value)
    return df.agg(F.count("*").alias("n_rows"))


def s7_latest_row(spark: SparkSession, root: str) -> DataFrame:
    """The newest row of a table, as a limit of one."""
    return table(spark, root, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(1).select("o_orderkey", "o_custkey")


def s9_merge_update(spark: SparkSession, root: str) -> DataFrame:
    """Late values of orders (the totals of their lines) put into the rows that have lines shipped late."""
    late = table(spark, root, "lineitem").filter("l_shipdate > TIMESTAMP '1998-06-01'").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    update = late.agg(F.round(F.sum("l_extendedprice"), 2).alias("o_totalprice")).withColumn("o_orderstatus", F.lit(None).cast("string"))
    return C.merge_update(table(spark, root, "orders"), update, "o_orderkey", ["o_totalprice", "o_orderstatus"]).select("o_orderkey", "o_orderstatus", "o_totalprice")


def s11_path_rule(spark: SparkSession, root: str) -> DataFrame:
    """The scheme and bucket off a stored path."""
    return table(spark, root, "data_catalog").select("id", F.regexp_replace("path", r"^[a-z0-9]+://[^/]+/", "").alias("key")).distinct()


def s12_result_key(spark: SparkSession, root: str) -> DataFrame:
    return _latest(spark, root).select("version", "id", C.result_key(F.col("version"), F.md5(F.col("id"))).alias("result_key"))


def s13_key_prefix(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "data_catalog").select("id", C.key_prefix(F.col("path"), "default/out").alias("prefix")).distinct()


def s14_extension(spark: SparkSession, root: str) -> DataFrame:
    rows = C.json_fields(_latest(spark, root))
    return rows.select("version", "id", C.normal_extension(F.col("file_extension")).alias("extension"))


def s22_base64(spark: SparkSession, root: str) -> DataFrame:
    """Text through base64 and back."""
    return table(spark, root, "tei_meta").select("doc_id", F.unbase64(F.base64(F.encode("title", "utf-8"))).cast("string").alias("title"))


def q1_batches(spark: SparkSession, root: str) -> DataFrame:
    """Q1/Q2: batches of four rows of each dataset in order of id."""
    rows = C.ranked(_latest(spark, root).select("version", "id"), "version", ["id"])
    out = C.batches(rows, "version")
    return out.select("version", "batch_no", "taken_start", "taken_end", F.array_join(F.transform("items", lambda x: x["id"]), ",").alias("ids"))


def q5_read_ahead(spark: SparkSession, root: str) -> DataFrame:
    """Q5: remaining batches of every dataset after the first hundred rows, and whether to read ahead."""
    n = s3_counts(spark, root)
    left = F.ceil(F.greatest(F.col("n_rows") - 100, F.lit(0)) / C.BATCH_ROWS)
    return n.select("version", left.cast("long").alias("remaining_batches"), (left < 300).alias("read_ahead"))


def q8_sizing(spark: SparkSession, root: str) -> DataFrame:
    n = s3_counts(spark, root)
    pods = F.ceil(F.col("n_rows") / C.POD_ROWS)
    return n.select(
        "version", (F.col("n_rows") * C.SECONDS_PER_ROW).alias("timeout_s"), pods.cast("long").alias("pods"), F.ceil(F.least(pods, F.lit(200)) / 64).cast("long").alias("waves")
    )


def q12_progress(spark: SparkSession, root: str) -> DataFrame:
    """Q12/Q14: successes and failures per user of the event log."""
    bad = F.col("event_type") == "error"
    return table(spark, root, "events").groupBy("user_id").agg(F.count_if(~bad).alias("n_success"), F.count_if(bad).alias("n_fail"))


def q13_daily(spark: SparkSession, root: str) -> DataFrame:
    bad = F.col("event_type") == "error"
    return table(spark, root, "events").groupBy(F.date_format("ts", "yyyyMMdd").alias("day")).agg(F.count_if(~bad).alias("n_success"), F.count_if(bad).alias("n_fail"))


def q21_unprocessed(spark: SparkSession, root: str) -> DataFrame:
    """Q20/Q21: catalog rows that no document refers to."""
    rows, done = _latest(spark, root).select("version", "id"), table(spark, root, "documents").select(F.col("data_id").alias("id"))
    return rows.join(done, "id", "left_anti").select("version", "id")


def q24_json_round_trip(spark: SparkSession, root: str) -> DataFrame:
    """Q24: batches as JSON text and back, as the number of items that survive."""
    text = q1_batches(spark, root).select("version", "batch_no", F.to_json(F.struct(F.split("ids", ",").alias("list"))).alias("json"))
    return text.select("version", "batch_no", F.size(F.from_json("json", "list array<string>")["list"]).cast("long").alias("n_items"))


QUERIES = {
    f.__name__: f
    for f in (
        d8_latest_version, s1_catalog_scan, s3_counts, s5_dynamic_filter, s7_latest_row, s9_merge_update, s11_path_rule, s12_result_key, s13_key_prefix, s14_extension,
        s22_base64, q1_batches, q5_read_ahead, q8_sizing, q12_progress, q13_daily, q13_daily_stream, q21_unprocessed, q24_json_round_trip,
    )
}
_JSON = "try(json_extract_string(attribute2, '$.{0}'))"
_COUNTS = f"SELECT version, count(*) AS n_rows FROM {_LATEST} GROUP BY version"
_EXT = _JSON.format("extension")
_BATCHES = f"""SELECT version, (rank - 1) // 4 AS batch_no, min(rank) - 1 AS taken_start, min(rank) + 3 AS taken_end, string_agg(id, ',' ORDER BY rank) AS ids, count(*) AS n_items
FROM (SELECT version, id, row_number() OVER (PARTITION BY version ORDER BY id) AS rank FROM {_LATEST}) GROUP BY 1, 2"""
SQL = {
    "d8_latest_version": f"SELECT version, id, modify_time, title, attribute2 FROM {_LATEST}",
    "s1_catalog_scan": f"SELECT id, version, doi, path, pdf_path, attribute2, {_EXT} AS file_extension, {_JSON.format('language')} AS language FROM {_LATEST}",
    "s3_counts": _COUNTS,
    "s5_dynamic_filter": "SELECT count(*) AS n_rows FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
    "s7_latest_row": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1",
    "s9_merge_update": """SELECT o.o_orderkey, o.o_orderstatus, coalesce(u.p, o.o_totalprice) AS o_totalprice FROM orders o LEFT JOIN
      (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS p FROM lineitem WHERE l_shipdate > TIMESTAMP '1998-06-01' GROUP BY 1) u ON u.l_orderkey = o.o_orderkey""",
    "s11_path_rule": "SELECT DISTINCT id, regexp_replace(path, '^[a-z0-9]+://[^/]+/', '') AS key FROM data_catalog",
    "s12_result_key": f"SELECT version, id, 'results/' || version || '/' || md5(id) || '/' || md5(id) || '.mmd' AS result_key FROM {_LATEST}",
    "s13_key_prefix": "SELECT DISTINCT id, coalesce(nullif(regexp_extract(path, '^(.*?/.*?)/', 1), ''), 'default/out') AS prefix FROM data_catalog",
    "s14_extension": f"""SELECT version, id, CASE WHEN e = '.azw3' THEN '.epub' WHEN e = '.djvu' THEN '.pdf' WHEN e IN {C.READABLE} THEN e END AS extension
      FROM (SELECT version, id, CASE WHEN {_EXT} IS NULL THEN '.pdf' ELSE '.' || lower({_EXT}) END AS e FROM {_LATEST})""",
    "s22_base64": "SELECT doc_id, decode(from_base64(to_base64(encode(title)))) AS title FROM tei_meta",
    "q1_batches": f"SELECT version, batch_no, taken_start, taken_end, ids FROM ({_BATCHES})",
    "q5_read_ahead": f"SELECT version, ceil(greatest(n_rows - 100, 0) / 4)::BIGINT AS remaining_batches, ceil(greatest(n_rows - 100, 0) / 4) < 300 AS read_ahead FROM ({_COUNTS})",
    "q8_sizing": f"SELECT version, n_rows * 100 AS timeout_s, ceil(n_rows / 50000)::BIGINT AS pods, ceil(least(ceil(n_rows / 50000), 200) / 64)::BIGINT AS waves FROM ({_COUNTS})",
    "q12_progress": "SELECT user_id, count(*) FILTER (event_type <> 'error') AS n_success, count(*) FILTER (event_type = 'error') AS n_fail FROM events GROUP BY 1",
    "q13_daily": "SELECT strftime(ts, '%Y%m%d') AS day, count(*) FILTER (event_type <> 'error') AS n_success, count(*) FILTER (event_type = 'error') AS n_fail FROM events GROUP BY 1",
    "q21_unprocessed": f"SELECT version, id FROM {_LATEST} c WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.data_id = c.id)",
    "q24_json_round_trip": f"SELECT version, batch_no, n_items FROM ({_BATCHES})",
}
SQL["q13_daily_stream"] = SQL["q13_daily"]
