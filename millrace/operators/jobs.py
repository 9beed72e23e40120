"""Jobs as rows: checks, due and overdue jobs, state changes, progress, templates, result rows.

All are expressions or filters over a table of jobs; times are given by the caller, so that a run can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# States of a job.
RUNNING, STOPPED = 10, 20
#: The columns of a result row.
RESULT = (
    "id", "version", "data_id", "data_doi", "attribute1", "attribute2", "result_path", "origin_path", "create_date", "modify_time", "is_success", "parse_type", "tag_type", "clean_type",
)


def takable(jobs: DataFrame, counts: DataFrame, key: str = "version") -> DataFrame:
    """Q3: jobs that run and whose dataset has rows; ``counts`` holds n_rows per dataset."""
    return jobs.filter(F.col("job_status") == RUNNING).join(counts.filter("n_rows > 0").select(key), key, "left_semi")


def due(last_run: Column, now: Column, interval: int = 300) -> Column:
    """Q6: whether a job's interval (seconds) has passed since its last run; a job that never ran is due."""
    return F.coalesce(F.unix_timestamp(now) - F.unix_timestamp(last_run) >= interval, F.lit(True))


def fault(required: list[str], user: str = "task_user") -> Column:
    """Q10: the first fault of a new job: a required field that is null or blank, or no user (0 or null); null if it is valid."""
    checks = [F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", f"{c} is empty") for c in required]
    return F.coalesce(*checks, F.when(F.coalesce(F.col(user), F.lit(0)) == 0, f"{user} is empty"))


def overdue(now: Column) -> Column:
    """Q15: running for strictly longer than its timeout (seconds); a job without a start is not."""
    return (F.col("job_status") == RUNNING) & F.coalesce(F.unix_timestamp(now) - F.unix_timestamp("start_time") > F.col("timeout"), F.lit(False))


def swept(jobs: DataFrame, now: Column) -> DataFrame:
    """Q15: overdue jobs stopped, with all their workers counted as gone; running jobs without a start are marked."""
    late = overdue(now)
    return jobs.withColumns(
        {
            "job_status": F.when(late, STOPPED).otherwise(F.col("job_status")),
            "exit_pod_num": F.when(late, F.col("total_pod_num")).otherwise(F.col("exit_pod_num")),
            "end_time": F.when(late, now).otherwise(F.col("end_time")),
            "warning": F.when((F.col("job_status") == RUNNING) & F.col("start_time").isNull(), "no start time"),
        }
    )


def stopped(jobs: DataFrame, asked: DataFrame, now: Column) -> DataFrame:
    """Q16: the jobs asked for (id) are stopped if they are not yet and have a cluster; ``changed`` tells which."""
    rows = jobs.join(asked.select("id", F.lit(True).alias("asked")).distinct(), "id", "left")
    change = F.coalesce("asked", F.lit(False)) & (F.col("job_status") != STOPPED) & (F.coalesce("cluster_id", F.lit(0)) > 0)
    return rows.withColumns(
        {"changed": change, "job_status": F.when(change, STOPPED).otherwise(F.col("job_status")), "end_time": F.when(change, now).otherwise(F.col("end_time"))}
    ).drop("asked")


def filled(template: Column, values: dict[str, Column]) -> Column:
    """Q17: each {{.Key}} of a template replaced; a null value as nothing, an unknown key stays."""
    for key, value in values.items():
        template = F.replace(template, F.lit("{{." + key + "}}"), F.coalesce(value.cast("string"), F.lit("")))
    return template


def fetched(wanted: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """K8/Q20: wanted rows with the path of their file; one without a file gets a failure message."""
    got = wanted.join(files.groupBy(key).agg(F.min("path").alias("file")), key, "left")
    return got.withColumns({"is_success": F.col("file").isNotNull(), "message": F.when(F.col("file").isNull(), "data not ready")})


def result_rows(df: DataFrame, run: str, now: Column) -> DataFrame:
    """K5: processed rows in the shape of the result table; ``message`` stands in attribute1, times in milliseconds."""
    at = F.unix_millis(now).cast("string")
    have = {"id": F.lit(run), "attribute1": F.coalesce("message", F.lit("")), "create_date": at, "modify_time": at}
    known = set(df.columns)
    return df.select(*[have[c].alias(c) if c in have else (F.col(c) if c in known else F.lit(None).cast("string")).alias(c) for c in RESULT])


def crawl_outcome(pages: DataFrame, job: str) -> DataFrame:
    """A crawl fails if its start page (depth 0) failed; other failed pages are left out and counted."""
    return pages.groupBy(job).agg(
        (F.count_if((F.col("depth") == 0) & F.col("failed")) > 0).alias("job_failed"), F.count_if((F.col("depth") > 0) & F.col("failed")).alias("n_skipped"), F.count_if(~F.col("failed")).alias("n_kept")
    )
