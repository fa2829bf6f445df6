"""One round of synthetic-data generation, around the calls themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions.jsonfmt import repeated_keys
from chatloom.operators.requests import (
    followup_requests,
    plan_requests,
    render_requests,
    request_payload,
)
from chatloom.operators.responses import (
    count_accepted,
    explode_items,
    first_usable,
    parse_responses,
    pending_requests,
    validate_annotations,
)


def request_rows(jobs: DataFrame, model: str, seed: int | None = None) -> DataFrame:
    """Jobs -> every request with prompts and payload."""
    return request_payload(render_requests(plan_requests(jobs), seed), model)


def next_round(
    jobs: DataFrame, requests: DataFrame, responses: DataFrame, model: str, seed: int | None = None
) -> DataFrame:
    """All that has to be sent after a round, with prompts and payload, in one table.

    ``requests`` is every request planned so far (:func:`request_rows` or the rounds
    before), ``responses`` all attempts. ``kind`` is ``retry`` for a batch without a
    usable response, sent again as it was under its own id and so with its own seed, and
    ``followup`` for what accepted responses fell short of. A job that is complete has no
    row, and an empty table means that the loop is over. Responses are parsed once: a
    usable attempt's count decides both kinds.
    """
    # Both kinds read the same responses, so Spark makes that part of the plan anew.
    with repeated_keys(jobs.sparkSession):
        accepted = first_usable(count_accepted(parse_responses(responses)))
        planned = requests.drop("system", "user", "payload")
        retries = pending_requests(planned, accepted).withColumn("kind", F.lit("retry"))
        followups = followup_requests(jobs, planned, accepted).withColumn("kind", F.lit("followup"))
        return request_payload(render_requests(retries.unionByName(followups), seed), model)


def accepted_annotations(responses: DataFrame, *ids: str) -> DataFrame:
    """Responses -> valid annotations ``(ids, item_pos, text, entities)``."""
    items = explode_items(parse_responses(responses), *ids)
    return (
        validate_annotations(items)
        .where(F.col("valid"))
        .select(*ids, "item_pos", "text", "entities")
    )


def rejected_items(responses: DataFrame, *ids: str) -> DataFrame:
    """Items of usable responses that break the record shape, with the reasons."""
    items = explode_items(parse_responses(responses), *ids)
    return (
        validate_annotations(items)
        .where(~F.col("valid"))
        .select(*ids, "item_pos", "errors", F.to_json("item").alias("item"))
    )
