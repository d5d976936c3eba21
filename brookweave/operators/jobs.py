"""Job-dependency queries over two tables: ``job_dependency(job_name, job_grp, job_dependency)``, the dependency being
``system.job``, and ``job_sts_log(status, system_type, job_name, cob_dt, ...)``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookweave.operators.dedupe import top_one
from brookweave.operators.merge import keyed_replace


def available_jobs(dependency: DataFrame, log: DataFrame, group: str, date: str, own_system: str | None = None, status_column: str | None = None) -> DataFrame:
    """Jobs of a group whose every dependency is done (status 1) on the date and that have no log row on it.

    A null dependency is never done. ``own_system``: only log rows of that system count as started; ``status_column``:
    only waiting rows marked Y take part (the waiting-list variant).
    """
    day = F.lit(date).cast("date")
    wanted = dependency.where(F.col("job_grp") == group)
    if status_column:
        wanted = wanted.where(F.col(status_column) == "Y")
    of_day = log.where(F.col("cob_dt").cast("date") == day)
    done = of_day.where("status = 1").select(F.col("system_type").alias("_sys"), F.col("job_name").alias("_job"))
    started = of_day.where(F.col("system_type") == own_system) if own_system else of_day
    parts = wanted.withColumns(
        {"_s": F.split_part("job_dependency", F.lit("."), F.lit(1)), "_j": F.split_part("job_dependency", F.lit("."), F.lit(2))}
    )
    met = parts.join(done, (F.col("_s") == F.col("_sys")) & (F.col("_j") == F.col("_job")), "left")
    return (
        met.join(started.select("job_name"), "job_name", "left_anti")
        .groupBy("job_name").agg(F.count("job_name").alias("_all"), F.count("_job").alias("_met"))
        .where("_all = _met").select("job_name")
    )


def unfinished_jobs(dependency: DataFrame, log: DataFrame, group: str, date: str) -> DataFrame:
    """One row ``n_unfinished``: jobs of the group not logged as done on the date (0: the group is done)."""
    done = log.where((F.col("cob_dt").cast("date") == F.lit(date).cast("date")) & (F.col("status") == 1)).select(F.col("job_name").alias("_job"))
    counts = (
        dependency.where(F.col("job_grp") == group).join(done, F.col("job_name") == F.col("_job"), "left")
        .groupBy("job_name").agg(F.count("job_name").alias("_all"), F.count("_job").alias("_done")).where("_all <> _done")
    )
    return counts.agg(F.count(F.lit(1)).alias("n_unfinished"))


def job_status(log: DataFrame, job: str, date: str) -> DataFrame:
    rows = log.where((F.col("job_name") == job) & (F.col("cob_dt").cast("date") == F.lit(date).cast("date")))
    return rows.select("job_name", F.when(F.col("status") == 1, "COMPLETED").otherwise("FAIL").alias("job_status"))


def log_start(log: DataFrame, jobs: DataFrame, date: str, system: str) -> DataFrame:
    rows = jobs.select(F.lit(0).alias("status"), F.lit(system).alias("system_type"), "job_name", F.lit(date).cast("date").alias("cob_dt"))
    return log.unionByName(rows, allowMissingColumns=True)


def log_finish(log: DataFrame, finished: DataFrame) -> DataFrame:
    """Rows of (job, date) replaced by their final ones in one result."""
    return keyed_replace(log, finished, ["job_name", "cob_dt"])


def latest_runs(log: DataFrame, order: str, skipped: str = "SKIPPED", status: str = "status", since: str | None = None) -> DataFrame:
    """The latest run of every job that was not skipped, within the window."""
    rows = log.where(F.col(status).cast("string") != skipped)
    if since:
        rows = rows.where(F.col(order) >= F.lit(since).cast("timestamp"))
    return top_one(rows, ["job_name"], [F.col(order).desc_nulls_last()])


def all_succeeded(log: DataFrame, jobs: Sequence[str], order: str, status: str = "status", done: str = "SUCCEEDED", since: str | None = None) -> DataFrame:
    """One row: ``n_succeeded``, ``all_succeeded`` and ``lock``, a hash of the sorted jobs and times used to run once."""
    runs = latest_runs(log, order, status=status, since=since).where(F.col("job_name").isin(list(jobs)))
    good = F.col(status).cast("string") == done
    names = F.array_sort(F.collect_list(F.when(good, F.concat_ws("@", "job_name", F.col(order).cast("string")))))
    return runs.agg(
        F.count(F.when(good, True)).alias("n_succeeded"),
        (F.count(F.when(good, True)) == len(set(jobs))).alias("all_succeeded"),
        F.sha2(F.concat_ws(",", names), 256).alias("lock"),
    )


def last_run_succeeded(log: DataFrame, jobs: DataFrame, order: str, status: str = "status", done: str = "SUCCEEDED") -> DataFrame:
    """Per job: whether its latest run is absent or succeeded."""
    runs = latest_runs(log, order, status=status).select("job_name", F.col(status).cast("string").alias("_s"))
    return jobs.select("job_name").distinct().join(runs, "job_name", "left").select("job_name", (F.col("_s").isNull() | (F.col("_s") == done)).alias("ok"))


def run_conditions(conditions: Sequence[tuple[str, bool, Callable[[], bool]]]) -> tuple[bool, str | None]:
    """All enabled conditions in order, stopping at the first that fails; its name is returned."""
    for name, enabled, test in conditions:
        if enabled and not test():
            return False, name
    return True, None


def all_succeeded_on(log: DataFrame, jobs: Sequence[str], cob_jobs: Sequence[str], workday: bool, order: str, **kwargs) -> DataFrame:
    """:func:`all_succeeded`, with the close-of-business jobs required too on a workday."""
    return all_succeeded(log, [*jobs, *cob_jobs] if workday else jobs, order, **kwargs)
