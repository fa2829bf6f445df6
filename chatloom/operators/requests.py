"""Planning generation requests: sizes, prompts and payload rows.

No request is sent from here. A plan assumes every response is accepted in
full. Afterwards ``responses.pending_requests`` finds the requests to send again, and
``followup_requests`` asks for what accepted responses fell short of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.fixed_values import (
    BATCH_TOKEN_CAP,
    GENERATION_SYSTEM_PROMPT,
    GENERATION_UNIT_SCHEMA,
    GENERATION_USER_PROMPT,
)
from chatloom.functions.batching import max_output_tokens, safe_batch
from chatloom.functions.templates import fill_template, message
from chatloom.operators.indexing import refuse_reserved

REQUESTS_PER_CHUNK = 65536


def plan_requests(
    jobs: DataFrame,
    job: str = "job_id",
    total: str = "total",
    batch_size: str = "batch_size",
    tokens: str = "tokens",
    cap: int = BATCH_TOKEN_CAP,
    first_batch: str | None = None,
) -> DataFrame:
    """Expand every job into its request rows at once.

    All requests but the last ask for ``safe_batch(batch_size)`` items, so the
    i-th request starts with ``total - i * step`` items missing and needs no
    loop. ``shrunk`` says that the cap made the request smaller than wanted; a
    cap hit that returns the wanted size is not shrunk. Jobs without items, or
    with a batch size below 1 (which could never finish), have no requests. Batch
    ids start at the column ``first_batch``, or at 0.

    Rows are produced in two steps with a shuffle of small chunk rows between,
    so one huge job is spread over tasks and never sits in one array. They come
    ordered by size within a task.
    """
    spec = jobs.select(
        F.col(job).alias(job),
        F.col(total).cast("bigint").alias("total"),
        F.col(batch_size).cast("bigint").alias("batch_size"),
        F.col(tokens).cast("bigint").alias("tokens"),
        (F.col(first_batch) if first_batch else F.lit(0)).cast("bigint").alias("first_batch"),
    ).where((F.col("total") > 0) & (F.col("batch_size") > 0))
    step = safe_batch("batch_size", "tokens", cap)
    sized = spec.withColumn("step", step).withColumn(
        "n_requests", F.expr("(total + step - 1) div step")
    )
    size = REQUESTS_PER_CHUNK
    starts = F.sequence(
        F.lit(0).cast("bigint"), F.col("n_requests") - 1, F.lit(size).cast("bigint")
    )
    # A fixed number of partitions: chunk rows are tiny, and the adaptive planner
    # would merge them into one task before they expand. Requests of equal sizes have
    # equal prompts, so they stand together, where files compress them best; job and
    # chunk split a size that very many requests share.
    tasks = int(jobs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["tokens", "step", job, "first"]
    chunks = sized.withColumn("first", F.explode(starts))
    chunks = chunks.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    last = F.least(F.col("first") + (size - 1), F.col("n_requests") - 1)
    rows = chunks.withColumn("number", F.explode(F.sequence("first", last)))
    remaining = F.col("total") - F.col("number") * F.col("step")
    return (
        rows.withColumn("remaining_before", remaining)
        .withColumn("want", F.least(F.col("batch_size"), F.col("remaining_before")))
        .withColumn("count", safe_batch("want", "tokens", cap))
        .withColumn("batch_id", F.col("first_batch") + F.col("number"))
        .select(
            job,
            "batch_id",
            "tokens",
            "want",
            "count",
            "remaining_before",
            (F.col("count") < F.col("want")).alias("shrunk"),
            max_output_tokens("count", "tokens").alias("max_output_tokens"),
        )
    )


def followup_requests(
    jobs: DataFrame,
    requests: DataFrame,
    accepted: DataFrame,
    job: str = "job_id",
    batch: str = "batch_id",
    **plan: str,
) -> DataFrame:
    """The next round's new requests, for what accepted responses fell short of.

    ``requests`` has the ``count`` of every batch asked for so far, ``accepted`` the
    items of every batch with a usable response (``responses.first_usable``). A batch
    without one is still to be answered under its own id and counts in full. What
    is then missing to a job's ``total`` is planned anew, with ids after the last.
    """
    name = plan.get("total", "total")
    done = accepted.select(job, batch, F.col("accepted").alias("__cl_accepted"))
    state = (
        requests.select(job, batch, "count")
        .join(done, [job, batch], "left")
        .groupBy(job)
        .agg(
            F.sum(F.coalesce("__cl_accepted", "count")).alias("__cl_covered"),
            (F.max(batch) + 1).alias("__cl_next"),
        )
    )
    short = (
        jobs.join(state, job, "left")
        .withColumn(name, F.col(name) - F.coalesce("__cl_covered", F.lit(0)))
        .withColumn("__cl_next", F.coalesce("__cl_next", F.lit(0)))
    )
    return plan_requests(short, job, first_batch="__cl_next", **plan)


def render_requests(plan: DataFrame, seed: int | None = None) -> DataFrame:
    """Add the ``system`` and ``user`` prompt of every request.

    With a seed the user prompt ends in ``SEED: seed + batch_id``, so a request
    sent again carries the same seed.
    """
    refuse_reserved(plan, "system", "user")
    user = fill_template(
        GENERATION_USER_PROMPT, count="count", unit_schema=F.lit(GENERATION_UNIT_SCHEMA)
    )
    if seed is not None:
        user = F.concat(user, F.lit("\nSEED: "), (F.lit(seed) + F.col("batch_id")).cast("string"))
    return plan.withColumn(
        "system", fill_template(GENERATION_SYSTEM_PROMPT, target_tokens="tokens")
    ).withColumn("user", user)


def request_payload(
    df: DataFrame, model: str, system_role: str = "assistant", effort: str = "low"
) -> DataFrame:
    """Add the request body as JSON text in ``payload``.

    The system prompt goes out under ``system_role``; existing runs send it as
    ``assistant``.
    """
    refuse_reserved(df, "payload")
    body = F.struct(
        F.lit(model).alias("model"),
        F.array(message(system_role, F.col("system")), message("user", F.col("user"))).alias(
            "input"
        ),
        F.col("max_output_tokens").alias("max_output_tokens"),
        F.struct(F.lit(effort).alias("effort")).alias("reasoning"),
    )
    return df.withColumn("payload", F.to_json(body))
