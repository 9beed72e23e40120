"""Queries over jobs (survey ids S2, S4, S6, S8, S10, Q3, Q6, Q7, Q10, Q11, Q15 to Q17, Q20, K5, K8, C8), with their SQL.

The jobs are orders: the customer is the user, the date the start, the priority's number the cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.runtime import scratch_folder
from millrace.operators import jobs as J
from millrace.sources.files import write_results
from millrace.sources.tables import table

NOW = "1998-06-01 00:00:00"


def _now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")


def jobs(spark: SparkSession, root: str) -> DataFrame:
    o = table(spark, root, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp_ntz"))
    number = F.substring("o_orderpriority", 1, 1).cast("int")
    return o.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("job "), "o_orderkey").alias("job_name"), F.when(number != 4, F.col("o_orderpriority")).alias("job_params"),
        F.when(F.col("o_orderkey") % 11 != 0, F.concat(F.lit("/out/"), "o_orderkey")).alias("output_path"), F.col("o_custkey").cast("int").alias("task_user"),
        F.when(F.col("o_orderstatus") == "F", J.STOPPED).otherwise(J.RUNNING).alias("job_status"), (number - 1).alias("cluster_id"),
        F.when(F.col("o_orderkey") % 13 != 0, F.col("at")).alias("start_time"), (F.col("o_custkey") % 60 * 86400).cast("long").alias("timeout"),
        (number * 4).alias("total_pod_num"), F.lit(0).alias("exit_pod_num"), F.lit(None).cast("timestamp_ntz").alias("end_time"),
    )


_JOBS = f"""(SELECT o_orderkey AS id, 'job ' || o_orderkey AS job_name, CASE WHEN o_orderpriority[1] <> '4' THEN o_orderpriority END AS job_params,
  CASE WHEN o_orderkey % 11 <> 0 THEN '/out/' || o_orderkey END AS output_path, o_custkey::INT AS task_user, CASE WHEN o_orderstatus = 'F' THEN 20 ELSE 10 END AS job_status,
  o_orderpriority[1]::INT - 1 AS cluster_id, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END AS start_time, (o_custkey % 60 * 86400)::BIGINT AS timeout,
  o_orderpriority[1]::INT * 4 AS total_pod_num, 0 AS exit_pod_num, NULL::TIMESTAMP AS end_time FROM orders)"""
_LATE = f"(job_status = 10 AND start_time IS NOT NULL AND epoch(TIMESTAMP '{NOW}') - epoch(start_time) > timeout)"


def s6_jobs_of_user(spark: SparkSession, root: str) -> DataFrame:
    """Job rows by user and state."""
    return jobs(spark, root).filter((F.col("task_user") == 7) & (F.col("job_status") == J.RUNNING)).select("id", "job_name", "start_time")


def s8_added_jobs(spark: SparkSession, root: str) -> DataFrame:
    """Jobs appended to a written table in two writes, partitioned by state, and read back."""
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    rows = jobs(spark, root).select("id", "task_user", "job_status")
    for part in (rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1")):
        write_results(part, path, by="job_status")
    return spark.read.parquet(path).groupBy("job_status").agg(F.count("*").alias("n"), F.sum("id").alias("ids"), F.count_distinct("task_user").alias("n_users"))


def s2_repeated_columns(spark: SparkSession, root: str) -> DataFrame:
    """The older page of the catalog, attribute2 under three names; read in Arrow batches of the session's size."""
    rows = table(spark, root, "data_catalog").select("id", "version", *[F.col("attribute2").alias(c) for c in ("attribute2", "extension_from", "language_from")])
    return rows.distinct()


def q3_takable_jobs(spark: SparkSession, root: str) -> DataFrame:
    counts = table(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("n_rows"))
    return J.takable(jobs(spark, root), counts, "id").select("id", "job_name")


def q6_due_jobs(spark: SparkSession, root: str) -> DataFrame:
    """Q6/Q7: jobs whose interval has passed, and until when what they hold is kept."""
    df = jobs(spark, root).filter(J.due(F.col("start_time"), _now(), 30 * 86400))
    return df.select("id", (F.unix_timestamp(F.coalesce("start_time", _now())) + F.col("timeout")).alias("kept_until"))


def q10_job_faults(spark: SparkSession, root: str) -> DataFrame:
    return jobs(spark, root).select("id", J.fault(["job_name", "job_params", "output_path"]).alias("fault"))


def q11_progress(spark: SparkSession, root: str) -> DataFrame:
    """Q11: the progress of each user's jobs, from their lines."""
    done = table(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count_if(F.col("l_linestatus") == "F").alias("success_task"), F.count("*").alias("total_task"))
    return jobs(spark, root).join(done, "id", "left").select("task_user", "id", "job_status", F.coalesce("success_task", F.lit(0)).alias("success_task"), F.coalesce("total_task", F.lit(0)).alias("total_task"))


def q15_swept_jobs(spark: SparkSession, root: str) -> DataFrame:
    return J.swept(jobs(spark, root), _now()).select("id", "job_status", "exit_pod_num", "end_time", "warning")


def q16_stopped_jobs(spark: SparkSession, root: str) -> DataFrame:
    asked = table(spark, root, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return J.stopped(jobs(spark, root), asked, _now()).select("id", "changed", "job_status", "end_time")


def q17_filled_template(spark: SparkSession, root: str) -> DataFrame:
    text = F.lit("run {{.Name}} on {{.Cluster}} as {{.Name}} into {{.Path}} by {{.Other}}")
    values = {"Name": F.col("job_name"), "Cluster": F.col("cluster_id"), "Path": F.col("output_path")}
    return jobs(spark, root).select("id", J.filled(text, values).alias("text"))


def _fetched(spark: SparkSession, root: str) -> DataFrame:
    wanted = table(spark, root, "data_catalog").groupBy(F.col("id").alias("data_id")).agg(F.max("version").alias("version"), F.max("doi").alias("data_doi"), F.max("path").alias("origin_path"))
    files = table(spark, root, "documents").filter("data_id is not null").select("data_id", F.concat(F.lit("/in/"), "doc_id").alias("path"))
    return J.fetched(wanted, files, "data_id")


def k8_fetched_files(spark: SparkSession, root: str) -> DataFrame:
    """K8/Q20: catalog rows with the file of their document, and failures of those without."""
    return _fetched(spark, root).select("data_id", "version", "file", "is_success", "message")


def k5_result_rows(spark: SparkSession, root: str) -> DataFrame:
    rows = _fetched(spark, root).withColumn("result_path", F.when(F.col("is_success"), F.concat(F.lit("/result/"), "data_id", F.lit(".json"))))
    return J.result_rows(rows, "run", F.lit(NOW).cast("timestamp"))


def c8_crawl_outcome(spark: SparkSession, root: str) -> DataFrame:
    """Each site as a crawl from its first document on; a page without text has failed."""
    docs = table(spark, root, "documents").filter("site is not null").select("site", "doc_id", F.coalesce(F.trim("text") == "", F.lit(True)).alias("failed"))
    first = docs.groupBy("site").agg(F.min("doc_id").alias("first"))
    pages = docs.join(first, "site").select("site", "failed", F.when(F.col("doc_id") == F.col("first"), 0).otherwise(1).alias("depth"))
    return J.crawl_outcome(pages, "site")


QUERIES = {
    f.__name__: f
    for f in (
        s2_repeated_columns, s6_jobs_of_user, s8_added_jobs, q3_takable_jobs, q6_due_jobs, q10_job_faults, q11_progress, q15_swept_jobs, q16_stopped_jobs, q17_filled_template, k8_fetched_files,
        k5_result_rows, c8_crawl_outcome,
    )
}
_FETCHED = """(SELECT w.*, f.file FROM (SELECT id AS data_id, max(version) AS version, max(doi) AS data_doi, max(path) AS origin_path FROM data_catalog GROUP BY id) w
  LEFT JOIN (SELECT data_id, min('/in/' || doc_id) AS file FROM documents WHERE data_id IS NOT NULL GROUP BY data_id) f USING (data_id))"""
SQL = {
    "s2_repeated_columns": "SELECT DISTINCT id, version, attribute2, attribute2 AS extension_from, attribute2 AS language_from FROM data_catalog",
    "s6_jobs_of_user": f"SELECT id, job_name, start_time FROM {_JOBS} WHERE task_user = 7 AND job_status = 10",
    "s8_added_jobs": f"SELECT job_status, count(*) AS n, sum(id)::BIGINT AS ids, count(DISTINCT task_user) AS n_users FROM {_JOBS} GROUP BY 1",
    "q3_takable_jobs": f"SELECT id, job_name FROM {_JOBS} WHERE job_status = 10 AND id IN (SELECT l_orderkey FROM lineitem)",
    "q6_due_jobs": f"""SELECT id, (epoch(coalesce(start_time, TIMESTAMP '{NOW}')) + timeout)::BIGINT AS kept_until FROM {_JOBS}
      WHERE start_time IS NULL OR epoch(TIMESTAMP '{NOW}') - epoch(start_time) >= 2592000""",
    "q10_job_faults": f"""SELECT id, CASE WHEN coalesce(trim(job_name), '') = '' THEN 'job_name is empty' WHEN coalesce(trim(job_params), '') = '' THEN 'job_params is empty'
      WHEN coalesce(trim(output_path), '') = '' THEN 'output_path is empty' WHEN coalesce(task_user, 0) = 0 THEN 'task_user is empty' END AS fault FROM {_JOBS}""",
    "q11_progress": f"""SELECT task_user, id, job_status, coalesce(success_task, 0) AS success_task, coalesce(total_task, 0) AS total_task FROM {_JOBS} LEFT JOIN
      (SELECT l_orderkey AS id, count(*) FILTER (l_linestatus = 'F') AS success_task, count(*) AS total_task FROM lineitem GROUP BY 1) USING (id)""",
    "q15_swept_jobs": f"""SELECT id, CASE WHEN {_LATE} THEN 20 ELSE job_status END AS job_status, CASE WHEN {_LATE} THEN total_pod_num ELSE exit_pod_num END AS exit_pod_num,
      CASE WHEN {_LATE} THEN TIMESTAMP '{NOW}' ELSE end_time END AS end_time, CASE WHEN job_status = 10 AND start_time IS NULL THEN 'no start time' END AS warning FROM {_JOBS}""",
    "q16_stopped_jobs": f"""SELECT id, c AS changed, CASE WHEN c THEN 20 ELSE job_status END AS job_status, CASE WHEN c THEN TIMESTAMP '{NOW}' ELSE end_time END AS end_time
      FROM (SELECT *, id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AND job_status <> 20 AND cluster_id > 0 AS c FROM {_JOBS})""",
    "q17_filled_template": f"""SELECT id, 'run ' || job_name || ' on ' || cluster_id || ' as ' || job_name || ' into ' || coalesce(output_path, '') || ' by {{{{.Other}}}}' AS text FROM {_JOBS}""",
    "k8_fetched_files": f"SELECT data_id, version, file, file IS NOT NULL AS is_success, CASE WHEN file IS NULL THEN 'data not ready' END AS message FROM {_FETCHED}",
    "k5_result_rows": f"""SELECT 'run' AS id, version, data_id, data_doi, CASE WHEN file IS NULL THEN 'data not ready' ELSE '' END AS attribute1, NULL::VARCHAR AS attribute2,
      CASE WHEN file IS NOT NULL THEN '/result/' || data_id || '.json' END AS result_path, origin_path, '896659200000' AS create_date, '896659200000' AS modify_time, file IS NOT NULL AS is_success,
      NULL::VARCHAR AS parse_type, NULL::VARCHAR AS tag_type, NULL::VARCHAR AS clean_type FROM {_FETCHED}""",
    "c8_crawl_outcome": """SELECT site, bool_or(failed AND doc_id = first) AS job_failed, count(*) FILTER (failed AND doc_id <> first) AS n_skipped, count(*) FILTER (NOT failed) AS n_kept
      FROM (SELECT site, doc_id, coalesce(trim(text) = '', true) AS failed, min(doc_id) OVER (PARTITION BY site) AS first FROM documents WHERE site IS NOT NULL) GROUP BY site""",
}
