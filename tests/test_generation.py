import json

import pytest
from pyspark.sql import functions as F

from chatloom.fixed_values import GENERATION_UNIT_SCHEMA
from chatloom.functions.batching import max_output_tokens, safe_batch
from chatloom.operators import requests as req
from chatloom.operators import responses as resp
from chatloom.plans.generation import accepted_annotations, rejected_items, request_rows

GOLDEN = [
    (10, 200, 10, 4000), (10, 1334, 10, 20000), (10, 2000, 6, 20000), (100, 200, 66, 20000),
    (66, 200, 66, 20000), (67, 200, 66, 20000), (5, 20000, 1, 20000), (10, 0, 10, 0),
    (0, 200, 0, 0), (13334, 1, 16000, 20000),
]


def test_safe_batch_golden(spark):
    df = spark.createDataFrame([g[:2] for g in GOLDEN], "c INT, t INT")
    df = df.withColumn("b", safe_batch("c", "t")).withColumn("m", max_output_tokens("b", "t"))
    assert sorted(tuple(r) for r in df.collect()) == sorted(GOLDEN)


PLANS = {
    # total, batch size, tokens: wanted and asked for per request
    (23, 10, 200): [(10, 10), (10, 10), (3, 3)],
    (9, 10, 2000): [(9, 6), (3, 3)],
    (100, 100, 200): [(100, 66), (34, 34)],
    (3, 2, 20000): [(2, 1), (2, 1), (1, 1)],
    (40000, 13334, 1): [(13334, 16000), (13334, 16000), (8000, 8000)],
    (0, 10, 200): [],
    (-5, 10, 200): [],
    (7, 0, 200): [],
}


@pytest.mark.parametrize("chunk", [65536, 7])
def test_plans(spark, monkeypatch, chunk):
    monkeypatch.setattr(req, "REQUESTS_PER_CHUNK", chunk)
    jobs = list(PLANS) + [(t, b, k) for t in (1, 10, 500) for b in (1, 7, 64, 20000) for k in (0, 1, 200, 1334, 9000)]
    df = spark.createDataFrame([(j, *job) for j, job in enumerate(jobs)], "job_id BIGINT, total BIGINT, batch_size BIGINT, tokens BIGINT")
    rows = {}
    for r in req.plan_requests(df).orderBy("job_id", "batch_id").collect():
        rows.setdefault(r.job_id, []).append(r)
    for j, (total, batch, tokens) in enumerate(jobs):
        plan = rows.get(j, [])
        if (total, batch, tokens) in PLANS:
            assert [(r.want, r["count"]) for r in plan] == PLANS[total, batch, tokens]
            continue
        assert [r.batch_id for r in plan] == list(range(len(plan)))
        assert plan[0].remaining_before == total
        falls = [a.remaining_before - b.remaining_before for a, b in zip(plan, plan[1:])]
        assert falls == [r["count"] for r in plan[:-1]]
        assert plan[-1].remaining_before <= plan[-1]["count"]
        assert all(r.want == min(batch, r.remaining_before) for r in plan)
        assert all(r.shrunk == (r["count"] < r.want) and r.max_output_tokens <= 20000 for r in plan)


def test_requests_of_equal_sizes_stand_together(spark):
    jobs = [(j, 100, 5 + j % 2, 100 + j % 3) for j in range(300)]
    df = spark.createDataFrame(jobs, "job_id BIGINT, total BIGINT, batch_size BIGINT, tokens BIGINT")
    spread = req.plan_requests(df).select(F.spark_partition_id().alias("p"), "tokens", "want").where("want > 4")
    kinds = spread.distinct().groupBy("p").count().collect()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 1 < len(kinds) <= tasks
    # Six sizes in one order: a task's first may be the last of the task before.
    assert sum(k["count"] for k in kinds) <= len(kinds) + 6 - 1


def test_batch_ids_can_continue(spark):
    df = spark.createDataFrame([(1, 25, 10, 200, 7)], "job_id BIGINT, total BIGINT, batch_size BIGINT, tokens BIGINT, f BIGINT")
    assert [r.batch_id for r in req.plan_requests(df, first_batch="f").orderBy("batch_id").collect()] == [7, 8, 9]


def test_prompts_and_payload(spark):
    jobs = spark.createDataFrame([(1, 12, 10, 200)], "job_id INT, total INT, batch_size INT, tokens INT")
    rows = request_rows(jobs, "m", seed=40).orderBy("batch_id").collect()
    assert [r["count"] for r in rows] == [10, 2]
    assert rows[0].user.startswith("Generate 10 clinical annotations.")
    assert "(array of 10 objects)." in rows[0].user and GENERATION_UNIT_SCHEMA in rows[0].user
    assert rows[1].user.endswith("\nSEED: 41")
    assert "Aim ~200 tokens" in rows[0].system
    body = json.loads(rows[1].payload)
    assert body["model"] == "m" and body["reasoning"] == {"effort": "low"}
    assert [m["role"] for m in body["input"]] == ["assistant", "user"]
    assert body["input"][1]["content"] == rows[1].user
    assert body["max_output_tokens"] == 800
    unseeded = req.render_requests(req.plan_requests(jobs)).first()
    assert "SEED" not in unseeded.user


GOOD = {"mention": "m", "type": "T", "assertion": "P", "context_window": "c"}
RAW = {
    1: json.dumps({"items": [{"text": "a", "entities": [GOOD]}, {"text": "b"}]}),
    2: "no json",
    3: json.dumps([{"text": "a"}]),
    4: json.dumps({"other": []}),
    5: json.dumps({"items": 3}),
    6: json.dumps({"items": None}),
    7: json.dumps({"items": []}),
    8: json.dumps({"items": [{"text": "a"}, {"text": "b"}]}) + " thanks",
    9: None,
    10: " \n" + json.dumps({"items": [{"text": "ä \" \\ 漢"}, {"text": "b"}], "items2": 1}),
    11: '{"items": {"text": "a"}}',
    12: '"items"',
}


@pytest.fixture
def responses(spark):
    rows = [(1, n, 1, raw, 2) for n, raw in RAW.items()]
    return spark.createDataFrame(
        rows, "job_id BIGINT, batch_id BIGINT, attempt BIGINT, raw STRING, expected BIGINT"
    )


def test_response_gates(responses):
    got = {r.batch_id: (r.status, r.n_items, r.count_mismatch) for r in resp.parse_responses(responses).collect()}
    assert got == {
        1: ("ok", 2, False), 2: ("not_json", None, False), 3: ("no_items", None, False),
        4: ("no_items", None, False), 5: ("items_not_list", None, False),
        6: ("items_not_list", None, False), 7: ("ok", 0, True), 8: ("not_json", None, False),
        9: ("not_json", None, False), 10: ("ok", 2, False), 11: ("items_not_list", None, False),
        12: ("no_items", None, False),
    }


def test_quarantine_and_retry(spark, responses):
    parsed = resp.parse_responses(responses)
    assert sum(r.accepted for r in resp.count_accepted(parsed).collect()) == 4
    bad = {r.batch_id: (r.reason, r.raw_preview) for r in resp.quarantine(parsed, "batch_id").collect()}
    assert set(bad) == {2, 3, 4, 5, 6, 8, 9, 11, 12} and bad[2] == ("not_json", "no json")
    wanted = spark.createDataFrame([(1, b) for b in range(1, 15)], "job_id BIGINT, batch_id BIGINT")
    open_ = resp.pending_requests(wanted, parsed.where("status = 'ok'"))
    assert sorted(r.batch_id for r in open_.collect()) == [2, 3, 4, 5, 6, 8, 9, 11, 12, 13, 14]


ITEMS = {
    0: ({"text": "t", "entities": [GOOD, {**GOOD, "extra": 1}], "more": 2}, []),
    1: ({"text": "t"}, []),
    2: ({"entities": []}, ["text_not_string"]),
    3: ({"text": 5, "entities": None}, ["text_not_string", "entities_not_list"]),
    4: ({"text": "t", "entities": "none"}, ["entities_not_list"]),
    5: ({"text": "t", "entities": [3]}, ["entity_not_object"]),
    6: ({"text": "t", "entities": [{"mention": "m"}]}, ["type_not_string", "assertion_not_string"]),
    7: ({"text": "t", "entities": [{**GOOD, "mention": 1, "context_window": None}]},
        ["mention_not_string", "context_window_not_string"]),
    8: ("bare", ["item_not_object"]),
    9: (None, ["item_not_object"]),
    10: ({"text": "t", "entities": [{k: GOOD[k] for k in ("mention", "type", "assertion")}]}, []),
    11: ([], ["item_not_object"]),
}


def test_validation(spark):
    raw = json.dumps({"items": [item for item, _ in ITEMS.values()]})
    df = spark.createDataFrame([(1, raw, 12)], "batch_id INT, raw STRING, expected INT")
    rows = resp.validate_annotations(resp.explode_items(resp.parse_responses(df), "batch_id")).collect()
    assert {r.item_pos: r.errors for r in rows} == {i: e for i, (_, e) in ITEMS.items()}
    clean = {r.item_pos: r for r in rows if r.valid}
    assert [tuple(e) for e in clean[0].entities] == [("m", "T", "P", "c")] * 2
    assert clean[1].entities == [] and tuple(clean[10].entities[0]) == ("m", "T", "P", "")
    assert all(r.text is None and r.entities is None for r in rows if not r.valid)
    assert accepted_annotations(df, "batch_id").count() == 3
    assert resp.count_accepted(resp.parse_responses(df)).first().accepted == 3
    assert rejected_items(df, "batch_id").count() == 9


def test_progress_of_a_hot_job(spark, monkeypatch):
    monkeypatch.setattr(resp, "BATCHES_PER_BUCKET", 16)
    rows = [(1, b, b % 4, 700) for b in range(500)] + [(2, b, 3, 5) for b in range(3)]
    df = spark.createDataFrame(rows, "job_id BIGINT, batch_id BIGINT, accepted BIGINT, total BIGINT")
    got = {(r.job_id, r.batch_id): (r.accepted_so_far, r.remaining) for r in resp.progress(df.repartition(7)).collect()}
    acc = {}
    for j, b, a, t in rows:
        acc[j] = acc.get(j, 0) + a
        assert got[j, b] == (acc[j], t - acc[j])


def test_retries_count_once(spark):
    rows = [
        (1, 0, 1, "not_json", 0), (1, 0, 2, "ok", 7), (1, 0, 3, "ok", 10),
        (1, 1, 1, "ok", 20), (1, 1, 2, "ok", 30), (1, 2, 1, "no_items", 0), (2, 0, 1, "ok", 0),
    ]
    df = spark.createDataFrame(rows, "job_id BIGINT, batch_id BIGINT, attempt BIGINT, status STRING, accepted BIGINT")
    once = resp.first_usable(df.repartition(5)).withColumn("total", F.lit(30))
    assert sorted((r.job_id, r.batch_id, r.accepted) for r in once.collect()) == [(1, 0, 7), (1, 1, 20), (2, 0, 0)]
    got = {(r.job_id, r.batch_id): (r.accepted_so_far, r.remaining) for r in resp.progress(once).collect()}
    assert got == {(1, 0): (7, 23), (1, 1): (27, 3), (2, 0): (0, 30)}


def test_followups_ask_for_what_is_short(spark):
    jobs = spark.createDataFrame(
        [(1, 25, 10, 200), (2, 10, 10, 200), (3, 10, 10, 200), (4, 0, 10, 200), (5, 3, 10, 200)],
        "job_id BIGINT, total BIGINT, batch_size BIGINT, tokens BIGINT",
    )
    asked = req.plan_requests(jobs.where("job_id <> 5"))
    # Job 1: 2 of 10, nothing of 10, and 5 not answered yet. Job 2: all. Job 3: not answered.
    accepted = spark.createDataFrame([(1, 0, 2), (1, 1, 0), (2, 0, 12)], "job_id BIGINT, batch_id BIGINT, accepted BIGINT")
    rows = req.followup_requests(jobs, asked, accepted).orderBy("job_id", "batch_id").collect()
    assert [(r.job_id, r.batch_id, r["count"]) for r in rows] == [(1, 3, 10), (1, 4, 8), (5, 0, 3)]


def test_accepted_json_is_what_json_loads_accepts(spark):
    texts = [
        '{"items": [{"text": "a", "text": "b"}]}', '{"items": [], "items": [{"text": "x"}]}',
        '{"items": [{"text": NaN}, {"text": "NaN, -Infinity"}, {"score": -Infinity, "text": "t"}]}',
        '{"items": [NaN], "x": "a \\" NaN"}', '{"items": [NaN}', '{"items": [NotANumber]}',
    ]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "batch_id INT, raw STRING, expected INT")
    parsed = resp.parse_responses(df)
    status = {r.batch_id: r.status for r in parsed.collect()}
    for i, text in enumerate(texts):
        try:
            json.loads(text)
            assert status[i] == "ok"
        except ValueError:
            assert status[i] == "not_json"
    rows = resp.validate_annotations(resp.explode_items(parsed, "batch_id")).orderBy("batch_id", "item_pos").collect()
    assert [r.text for r in rows if r.valid] == ["b", "x", "NaN, -Infinity", "t"]
    assert rows[2].errors == ["text_not_string"]


def test_responses_are_read_once_for_progress(spark, small):
    from checks.queries import QUERIES

    plan = QUERIES["generation_progress"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in plan.splitlines() if "FileScan" in line]) == 1


def test_many_answers_to_one_request_collapse_early(spark):
    wanted = spark.range(3).select(F.lit(1).alias("job_id"), F.col("id").alias("batch_id"))
    answers = spark.range(3000).select(F.lit(1).alias("job_id"), F.lit(0).cast("bigint").alias("batch_id"))
    out = resp.pending_requests(wanted, answers)
    assert sorted(r.batch_id for r in out.collect()) == [1, 2]
    assert "HashAggregate" in out._jdf.queryExecution().executedPlan().toString()
