"""No operator replaces or drops a column the table has already."""

import json

import pytest
from pyspark.sql import functions as F

from chatloom.operators import lengths, mixing, quality, requests, responses

ENTITY = "ARRAY<STRUCT<mention: STRING, type: STRING, assertion: STRING, context_window: STRING>>"


def notes(spark):
    return spark.createDataFrame([(1, "a note", [("note", "Symptom", "Positive", "a note")])], f"id INT, text STRING, entities {ENTITY}")


def answers(spark):
    raw = json.dumps({"items": [{"text": "t", "entities": [{"mention": "m", "type": "x", "assertion": "y"}]}]})
    return spark.createDataFrame([(1, raw, 1)], "id INT, raw STRING, expected INT")


def parsed(spark):
    return responses.parse_responses(answers(spark))


def items(spark):
    return responses.explode_items(parsed(spark), "id")


def planned(spark):
    jobs = spark.createDataFrame([("j", 3, 2, 100)], "job_id STRING, total INT, batch_size INT, tokens INT")
    return requests.plan_requests(jobs)


OPERATORS = {
    "check_enums": (notes, quality.check_enums),
    "check_grounding": (notes, quality.check_grounding),
    "check_context_copied": (notes, quality.check_context_copied),
    "check_context_shape": (notes, quality.check_context_shape),
    "check_note_length": (notes, lambda df: quality.check_note_length(df, 10)),
    "check_extra_keys": (parsed, quality.check_extra_keys),
    "parse_responses": (answers, responses.parse_responses),
    "validate_annotations": (items, responses.validate_annotations),
    "count_accepted": (parsed, responses.count_accepted),
    "render_requests": (planned, requests.render_requests),
    "request_payload": (lambda s: requests.render_requests(planned(s)), lambda df: requests.request_payload(df, "m")),
    "truncate": (notes, lengths.truncate),
    "pack": (lambda s: notes(s).withColumn("n", F.lit(3)), lambda df: lengths.pack(df, "n")),
    "split_train_eval": (notes, mixing.split_train_eval),
    "split_by_hash": (notes, mixing.split_by_hash),
    "shuffle": (notes, lambda df: mixing.shuffle(df, 1)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_added_columns_are_refused(spark, name):
    table, operator = OPERATORS[name]
    df = table(spark)
    added = [c for c in operator(df).columns if c not in df.columns]
    assert added
    for column in added:
        with pytest.raises(ValueError, match=column):
            operator(df.withColumn(column, F.lit("own")))


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_are_kept(spark, name):
    table, operator = OPERATORS[name]
    df = table(spark)
    mine = {c: F.lit(f"own {c}") for c in ("_doc", "_items", "_entities", "_once", "_pos", "_accepted", "_next", "e")}
    out = operator(df.withColumns(mine)).select(*mine).collect()
    assert out and all(r[c] == f"own {c}" for r in out for c in mine)


def test_reports_read_tables_with_working_names(spark):
    df = notes(spark).withColumns({"_pos": F.lit(7), "e": F.lit(8), "type": F.lit("own")})
    assert {(r.type, r.assertion) for r in quality.label_balance(df).where("level = 0").collect()} == {("Symptom", "Positive")}
