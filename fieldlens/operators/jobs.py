"""Job and batch states as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


QUEUED_SECONDS, RUNNING_SECONDS, MOST_ATTEMPTS, STALE_LISTED = 120, 600, 3, 100


def _before(as_of: Column, seconds: int) -> Column:
    return as_of - F.make_interval(secs=F.lit(seconds))


def _stale_running(as_of: Column, seconds: int, attempts: int) -> Column:
    return (F.col("status") == "running") & (F.col("started_at") < _before(as_of, seconds)) & (F.col("attempts") < attempts)


def stale(jobs: DataFrame, as_of: Column, queued: int = QUEUED_SECONDS, running: int = RUNNING_SECONDS, attempts: int = MOST_ATTEMPTS, limit: int | None = STALE_LISTED) -> DataFrame:
    """Jobs to dispatch again: queued or running for too long, with attempts left; the oldest ``limit`` of either kind."""
    waiting = jobs.where((F.col("status") == "queued") & (F.col("created_at") < _before(as_of, queued)) & (F.col("attempts") < attempts))
    hung = jobs.where(_stale_running(as_of, running, attempts))
    if limit is not None:
        waiting, hung = waiting.orderBy("created_at", "job_id").limit(limit), hung.orderBy("started_at", "job_id").limit(limit)
    return waiting.unionByName(hung)


def requeued(jobs: DataFrame, as_of: Column, running: int = RUNNING_SECONDS, attempts: int = MOST_ATTEMPTS) -> DataFrame:
    """Jobs whose worker was lost are queued again, so that a claim can take them; those without attempts left stay as they are."""
    late = F.coalesce(_stale_running(as_of, running, attempts), F.lit(False))
    return jobs.withColumns({"status": F.when(late, "queued").otherwise(F.col("status")), "started_at": F.when(~late, F.col("started_at")), "updated_at": F.when(late, as_of).otherwise(F.col("updated_at"))})


def unexpired(jobs: DataFrame, as_of: Column) -> DataFrame:
    """Without jobs past ``expires_at``, whatever their state; a job without that time stays."""
    return jobs.where(F.coalesce(F.col("expires_at") >= as_of, F.lit(True)))


def swept(jobs: DataFrame, as_of: Column, running: int = RUNNING_SECONDS, attempts: int = MOST_ATTEMPTS) -> DataFrame:
    """Expired jobs deleted, lost ones queued again."""
    return requeued(unexpired(jobs, as_of), as_of, running, attempts)


def claim(jobs: DataFrame, job_id: Column | int, as_of: Column | None = None, expected: str = "queued", to: str = "running") -> DataFrame:
    """Compare and set: only a job in the expected state changes; with a time, it starts then and counts an attempt."""
    taken = (F.col("job_id") == job_id) & (F.col("status") == expected)
    out = {"status": F.when(taken, to).otherwise(F.col("status"))}
    if as_of is not None:
        out |= {"started_at": F.when(taken, as_of).otherwise(F.col("started_at")), "updated_at": F.when(taken, as_of).otherwise(F.col("updated_at")), "attempts": F.col("attempts") + F.when(taken, 1).otherwise(0)}
    return jobs.withColumns(out)


def finished(jobs: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """Jobs with their outcomes(job_id, result, error): failed where there is an error, else succeeded; a success clears an earlier error."""
    told = outcomes.select("job_id", F.col("result").alias("__result"), F.col("error").alias("__error"), F.lit(True).alias("__told"))
    both = jobs.join(told, "job_id", "left")
    new = lambda value, old: F.when(F.col("__told"), value).otherwise(F.col(old)).alias(old)
    failed = F.col("__error").isNotNull()
    changed = {"status": new(F.when(failed, "failed").otherwise("succeeded"), "status"), "result": new(F.when(failed, F.col("result")).otherwise(F.col("__result")), "result"), "error": new(F.col("__error"), "error"), "finished_at": new(as_of, "finished_at"), "updated_at": new(as_of, "updated_at")}
    return both.select(*(changed.get(c, F.col(c)) for c in jobs.columns))


def consumed(jobs: DataFrame, job_id: Column | int, service: str | None = None) -> tuple[DataFrame, DataFrame]:
    """An ended job of one's own service, and the table without it."""
    mine = (F.col("job_id") == job_id) & F.col("status").isin("succeeded", "failed")
    mine = mine if service is None else mine & (F.col("service") == service)
    return jobs.where(mine), jobs.where(~F.coalesce(mine, F.lit(False)))


STAGE_ORDER = ["content", "facts", "knowledge", "summary"]


def batch_buckets(batches: DataFrame, as_of: Column, stale_minutes: int = 30) -> DataFrame:
    """What is to be done with each batch, and its next stage."""
    state = (
        F.when((F.col("status") == "creating") & (F.col("updated_at") < as_of - F.make_interval(mins=F.lit(stale_minutes))), "stale")
        .when(F.col("status").isin("pending", "creating"), "pending")
        .when(F.col("status") == "processing", "active")
        .when((F.col("status") == "failed") & (F.col("retry_count") < F.col("max_retries")), "retry")
        .otherwise("done")
    )
    steps = F.array(*map(F.lit, STAGE_ORDER))
    following = F.get(steps, F.array_position(steps, F.col("stage")).cast("int"))
    return batches.withColumn("bucket", state).withColumn("next_stage", F.when(F.col("status") == "completed", following))


def given_up(failures: DataFrame, most: int) -> DataFrame:
    """Articles that failed a stage as often as allowed."""
    return failures.groupBy("stage", "article_id").agg(F.count("*").alias("attempts")).where(F.col("attempts") >= most)


def progress(done: Column, total: Column, seconds: Column) -> tuple[Column, Column, Column]:
    """Share done, items a second, seconds left."""
    rate = F.try_divide(done.cast("double"), seconds)
    return F.try_divide(done.cast("double"), total), rate, F.try_divide(total - done, rate)


def stage_completion(checkpoint: DataFrame, articles: DataFrame, stage: str) -> DataFrame:
    """Articles that a stage has not done yet, by the checkpoint table."""
    return articles.join(checkpoint.where(F.col("stage") == stage).select("article_id"), "article_id", "left_anti")


def stages_left(checkpoint: DataFrame, articles: DataFrame, stages: list[str]) -> DataFrame:
    """For each article, the first stage it has not done."""
    done = checkpoint.groupBy("article_id").agg(F.collect_set("stage").alias("done"))
    left = F.get(F.array_except(F.array(*map(F.lit, stages)), F.coalesce("done", F.expr("cast(array() as array<string>)"))), F.lit(0))
    return articles.join(done, "article_id", "left").select("article_id", left.alias("next_stage"))
