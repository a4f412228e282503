"""Job queue transitions and health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: errors of fetches that no retry mends, errors that are tried again, and what is queued anew or never is
PERMANENT_HTTP = r"^HTTP (403|404|410|520|521|523|525|526|530)$"
PERMANENT_PREFIX = "Non-HTML content:"
NOT_FOUND = r"(?i)(getaddrinfo|dns).*ENOTFOUND|\bENOTFOUND\b"
RETRY_HTTP = r"^HTTP 5[0-9]{2}$"
RETRY_TEXTS = ("fetch failed", "This operation was aborted")
REQUEUE_LIKE = ("%fetch failed%", "%this operation was aborted%", "%timeout%", "http 5%", "%econnreset%", "%etimedout%")
REQUEUE_NOT_LIKE = ("http 403%", "cached error: http 403%", "http 404%", "cached error: http 404%", "http 410%", "cached error: http 410%")


def claim_order(rows: DataFrame) -> list[Column]:
    """Never-failed scrapes first, then priority, age and id."""
    fresh = (F.col("job_type") == "scrape") & F.col("last_error").isNull()
    return [F.when(fresh, 0).otherwise(1), F.desc("priority"), F.col("created_at"), F.col("id")]


def claimable(jobs: DataFrame, n: int, by: list[str]) -> DataFrame:
    """T1 claim: the first `n` pending jobs of each group, as they are once claimed."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*claim_order(jobs)))
    return jobs.where("status = 'pending' and attempts < max_attempts").withColumn("rank", rank).where(F.col("rank") <= n).withColumn("status", F.lit("processing")).withColumn("attempts", F.col("attempts") + 1)


def failed(jobs: DataFrame, error: str) -> DataFrame:
    """T1 fail: processing jobs go back to pending until their attempts are used up."""
    return jobs.where("status = 'processing'").withColumn("status", F.when(F.col("attempts") < F.col("max_attempts"), "pending").otherwise("failed")).withColumn("worker_id", F.lit(None).cast("string")).withColumn("last_error", F.lit(error))


def orphaned(jobs: DataFrame, workers: DataFrame, as_of: str, minutes: int = 10) -> DataFrame:
    """Processing jobs older than `minutes` whose worker works on something else; menu jobs fail, others wait again."""
    late = F.col("created_at") < F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    w = workers.select("worker_id", F.col("status").alias("w_status"), F.col("current_job_id").alias("w_job"))
    rows = jobs.where((F.col("status") == "processing") & late).join(w, "worker_id", "left")
    detached = ~F.coalesce((F.col("w_status") == "working") & (F.col("w_job") == F.col("id")), F.lit(False))
    return rows.where(detached).withColumn("next_status", F.when(F.col("job_type") == "menu_parse", "failed").otherwise("pending"))


def priority_group(priority: Column) -> Column:
    """A4: the coarse groups of queue reports."""
    return F.when(priority >= 100, "michigan").when(priority >= 95, "major_us").when(priority >= 80, "other_us").when(priority >= 50, "international").otherwise("rest")


def progress(jobs: DataFrame, by: list[str]) -> DataFrame:
    """Counts and the rounded share that is done."""
    done = F.count_if(F.col("status").isin("completed", "failed"))
    return jobs.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(F.col("status") == "failed").alias("failed"), (F.count("*") - done).alias("pending"), F.floor(done * 100.0 / F.count("*") + 0.5).cast("long").alias("percentage"))


def latest_workers(beats: DataFrame) -> DataFrame:
    """The last heartbeat of each worker with what it then did."""
    return beats.groupBy("worker_id").agg(F.max(F.struct("last_heartbeat", "current_job_id", "status")).alias("m")).select("worker_id", "m.*")


def backlog_state(missing: Column, pending: Column, processing: Column, retryable: Column, exhausted: Column) -> Column:
    """A9."""
    return F.when(missing > 0, "unfed").when(pending + processing > 0, "queued").when(retryable > 0, "partial_retry_pending").when(exhausted > 0, "manual_review").otherwise("clear")


def backlog_hours(candidates: Column, completed: Column, hours: float) -> Column:
    """Hours to clear the backlog at the window's rate; 0 if none is left, null without a rate."""
    return F.when(candidates <= 0, 0.0).when(completed > 0, candidates * F.lit(float(hours)) / completed)


def permanent_error(message: Column) -> Column:
    """errors that no retry can mend."""
    return F.coalesce(message.rlike(PERMANENT_HTTP) | message.startswith(PERMANENT_PREFIX) | message.rlike(NOT_FOUND), F.lit(False))


def retryable_error(message: Column) -> Column:
    """errors that are tried again at once; some are permanent too, many are neither."""
    return F.coalesce(message.rlike(RETRY_HTTP) | message.isin(*RETRY_TEXTS), F.lit(False))


def unclaimable(jobs: DataFrame) -> DataFrame:
    """Pending scrapes without attempts left, as they are once failed."""
    return jobs.where("job_type = 'scrape' and status = 'pending' and attempts >= max_attempts").withColumn("status", F.lit("failed"))


def requeued(jobs: DataFrame, stamp: str, batch: int = 100, most_pending: int = 200) -> DataFrame:
    """The first `batch` failed scrapes with a passing error, as they wait again; none while more than `most_pending` wait."""
    low = F.lower("last_error")
    passing, never = F.lit(False), F.lit(False)
    for x in REQUEUE_LIKE:
        passing = passing | low.like(x)
    for x in REQUEUE_NOT_LIKE:
        never = never | low.like(x)
    scrapes = jobs.where("job_type = 'scrape'")
    waiting = scrapes.agg(F.count_if(F.col("status") == "pending").alias("waiting"))
    rows = scrapes.where((F.col("status") == "failed") & passing & ~never).orderBy("id").limit(batch)
    rows = rows.crossJoin(F.broadcast(waiting)).where(F.col("waiting") <= most_pending).drop("waiting")  # one row
    note = F.concat(F.lit(f"requeued {stamp} (was: "), F.left("last_error", F.lit(120)), F.lit(")"))
    return rows.withColumns({"status": F.lit("pending"), "worker_id": F.lit(None).cast("string"), "attempts": F.lit(0), "last_error": note})


def due(last_success: Column, cadence_hours: Column, as_of: Column) -> Column:
    """never run, or the last success lies a cadence back."""
    late = F.unix_millis(as_of) - F.unix_millis(last_success) >= cadence_hours * F.lit(3600000).cast("long")
    return last_success.isNull() | late


def cadence(source: Column, has_backlog: Column, resume_hours: Column, hours: Column, resuming=("fsq_os_places",)) -> Column:
    """a source that resumes pages runs more often while it has a backlog (an hour if none is configured)."""
    return F.when(source.isin(*resuming) & has_backlog, F.coalesce(F.when(resume_hours != 0, resume_hours), F.lit(1))).otherwise(hours)


def boosted(jobs: DataFrame, priority: Column) -> DataFrame:
    """Pending jobs rise to a higher priority, never fall."""
    return jobs.withColumn("priority", F.when((F.col("status") == "pending") & (F.col("priority") < priority), priority).otherwise(F.col("priority")))


def cooldown_minutes(attempts: Column, base: float = 15.0, most: float = 360.0) -> Column:
    """Exponential wait, at most six hours."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), F.greatest(attempts - 1, F.lit(0))))


def scheduled(jobs: DataFrame, as_of: str) -> DataFrame:
    """What may run now, failed ones first, then by age: waiting jobs, and failed ones whose cooldown is over."""
    age = F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("created_at"))
    rows = jobs.where(F.col("status").isin("failed", "pending") & ~((F.col("attempts") > 0) & (age < cooldown_minutes(F.col("attempts")) * 60000000.0)))
    return rows.orderBy(F.when(F.col("status") == "failed", 0).otherwise(1), "created_at", "id")


def backlog(candidates: DataFrame, last: DataFrame, by: list[str]) -> DataFrame:
    """Candidates with their last job (id, status, retries) in eight states."""
    rows = candidates.join(last.select("id", F.col("status").alias("job_status"), "retries"), "id", "left")
    s, retries = F.col("job_status"), F.coalesce("retries", F.lit(0))
    known = ("pending", "processing", "failed", "completed")
    return rows.groupBy(*by).agg(
        F.count("*").alias("candidates"), F.count_if(s.isNull()).alias("missing_job"), *(F.count_if(s == x).alias(x) for x in known[:3]),
        F.count_if((s == "completed") & (retries < 1)).alias("retryable_partial"), F.count_if((s == "completed") & (retries >= 1)).alias("exhausted_partial"), F.count_if(~s.isin(*known)).alias("other"),
    )


def window_health(jobs: DataFrame, as_of: str, hours: int, job_type: str = "classify") -> DataFrame:
    """By kind of place the jobs in each state and those completed and failed within the last hours; jobs: completed_at."""
    fresh = F.col("completed_at") >= F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS")
    of = lambda s: F.count_if(F.col("status") == s)
    return jobs.where(F.col("job_type") == job_type).groupBy("place_type").agg(
        *(of(s).alias(s) for s in ("pending", "processing", "completed", "failed")),
        *(F.count_if((F.col("status") == s) & F.coalesce(fresh, F.lit(False))).alias(f"recent_{s}") for s in ("completed", "failed")),
    )


def merged_json(old: Column, new: Column) -> Column:
    """The fields of two JSON objects, the second's first; a broken first one counts as empty."""
    fields = lambda x: F.coalesce(F.from_json(x, "map<string,string>"), F.create_map().cast("map<string,string>"))
    fresh = fields(new)
    kept = F.map_filter(fields(old), lambda k, _: ~F.map_contains_key(fresh, k))
    return F.to_json(F.map_from_entries(F.array_sort(F.concat(F.map_entries(kept), F.map_entries(fresh)))))


def completed(jobs: DataFrame, output: Column, as_of: str) -> DataFrame:
    """T1 complete: processing jobs with their output merged into what they hold."""
    data = F.when(output.isNotNull(), merged_json(F.col("data"), output)).otherwise(F.col("data"))
    return jobs.where("status = 'processing'").withColumns({"status": F.lit("completed"), "completed_at": F.lit(as_of).cast("timestamp"), "data": data})


def retried(jobs: DataFrame) -> DataFrame:
    """T1 retry: processing jobs wait again and get their attempt back."""
    return jobs.where("status = 'processing'").withColumns({"status": F.lit("pending"), "worker_id": F.lit(None).cast("string"), "attempts": F.greatest(F.col("attempts") - 1, F.lit(0))})


def added(jobs: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """T1 add: of new jobs, the first of each key that is not queued yet, as it then waits."""
    first = new.groupBy(*keys).agg(F.min("id").alias("id"))
    fresh = new.join(first, [*keys, "id"], "left_semi").join(jobs.select(*keys).distinct(), keys, "left_anti")
    return fresh.withColumns({"status": F.lit("pending"), "attempts": F.lit(0)})


def reopened(jobs: DataFrame, error: str, most: int = 1) -> DataFrame:
    """T1 requeue-completed: completed jobs wait again, at most `most` times each; the count stands in their data."""
    times = F.coalesce(F.get_json_object("data", "$.partial_reprocess_count").cast("int"), F.lit(0))
    count = F.to_json(F.struct((times + 1).cast("string").alias("partial_reprocess_count")))
    rows = jobs.where((F.col("status") == "completed") & (times < most))
    return rows.withColumns({"status": F.lit("pending"), "worker_id": F.lit(None).cast("string"), "completed_at": F.lit(None).cast("timestamp"), "last_error": F.lit(error), "data": merged_json(F.col("data"), count)})


def minutes_since(at: Column, as_of: str) -> Column:
    """Minutes, to one decimal."""
    return F.round((F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(at)) / 60000000.0, 1)


def stale_jobs(jobs: DataFrame, as_of: str, minutes: int, job_type: str = "classify") -> DataFrame:
    """Jobs that have been processing for more than `minutes`, oldest first; jobs: started_at."""
    late = F.col("started_at") < F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return jobs.where((F.col("job_type") == job_type) & (F.col("status") == "processing") & late).withColumn("minutes_processing", minutes_since(F.col("started_at"), as_of)).orderBy("started_at")


def stale_workers(workers: DataFrame, as_of: str, minutes: int) -> DataFrame:
    """Workers that are not idle (or hold a job) and have been silent for more than `minutes`."""
    late = F.col("last_heartbeat") < F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    busy = (F.col("status") != "idle") | F.col("current_job_id").isNotNull()
    return workers.where(late & busy).withColumn("minutes_since_heartbeat", minutes_since(F.col("last_heartbeat"), as_of)).orderBy("last_heartbeat")


def runnable(jobs: DataFrame, control: DataFrame) -> DataFrame:
    """Jobs of types that are not paused; control: key, value, with `true` at pause_<type>."""
    paused = control.where("value = 'true' and key like 'pause!_%' escape '!'").select(F.expr("substring(key, 7)").alias("job_type"))
    return jobs.join(F.broadcast(paused), "job_type", "left_anti")  # one row for each job type
