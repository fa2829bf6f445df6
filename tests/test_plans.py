"""What the plans of the registered queries may and may not contain."""

import re

import pytest

import __spark_entry__ as entry_points
from checks.queries import QUERIES

# Windows without partitions that run over one row per bucket, never per row.
BUCKET_WINDOW = re.compile(r"Window \[.*_total#")
NO_PYTHON = set(QUERIES) - {"map_batches"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_guards(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    if name in NO_PYTHON:
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line):
            # "Window [functions], [partition columns], [order]": none means one task.
            partitioned = re.search(r"\], \[[^\]]+\], \[", line)
            assert partitioned or BUCKET_WINDOW.search(line), line


NARROW = [
    "normalize_text", "normalize_entities_dict", "annotation_messages", "prompt_messages",
    "render_generation_prompt", "fill_template", "entities_json", "truncate_examples",
    "train_eval_split_by_hash", "check_enums", "check_grounding", "check_context_copied",
    "check_context_shape", "check_note_length", "annotation_training_rows", "safe_batch",
]


@pytest.mark.parametrize("name", NARROW)
def test_row_local_work_never_shuffles(spark, small, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, small))


def test_scans_read_only_what_is_used(spark, small):
    plan = plan_of(QUERIES["train_eval_split_by_hash"](spark, small))
    assert "ReadSchema: struct<doc_id:bigint>" in plan
    plan = plan_of(QUERIES["sample_to_share"](spark, small))
    assert "EqualTo(lang,en)" in plan


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["conv_id", "text"] and df.count() > 0
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())
