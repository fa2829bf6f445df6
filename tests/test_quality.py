import json

from chatloom.operators import quality
from chatloom.operators.responses import parse_responses

SCHEMA = (
    "id INT, text STRING, entities ARRAY<STRUCT<mention: STRING, type: STRING, "
    "assertion: STRING, context_window: STRING>>"
)
ROWS = [
    (1, "Patient denies chest pain today after exercise.", [
        ("chest pain", "Symptom", "Negated", "Patient denies chest pain today"),
        ("Chest Pain", "Symptom", "Positive", "patient DENIES chest pain"),
        ("ataxia", "Finding", "Possible", ""),
    ]),
    (2, "Short note", []),
    (3, "one two", [("two", "Diagnosis", "Maybe", "one two")]),
]


def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def values(df, *columns):
    return {r.id: tuple(r[c] for c in columns) for r in df.collect()}


def test_note_rules(spark):
    df = table(spark)
    assert values(quality.check_enums(df), "n_entities", "n_bad_type", "n_bad_assertion") == {
        1: (3, 1, 0), 2: (0, 0, 0), 3: (1, 0, 1),
    }
    assert values(quality.check_grounding(df), "n_ungrounded", "n_ungrounded_nocase") == {
        1: (2, 1), 2: (0, 0), 3: (0, 0),
    }
    assert values(quality.check_context_copied(df), "n_not_copied", "n_not_copied_nocase") == {
        1: (2, 1), 2: (0, 0), 3: (0, 0),
    }
    assert values(quality.check_context_shape(df), "n_bad_size", "n_without_mention") == {
        1: (2, 1), 2: (0, 0), 3: (1, 0),
    }
    assert values(quality.check_note_length(df, 8), "n_words", "in_range") == {
        1: (7, True), 2: (2, False), 3: (2, False),
    }


def test_missing_fields_fail(spark):
    rows = [(1, "a note", [(None, None, None, None), ("", "", "", "")]), (2, None, [("m", "Symptom", "Positive", "a")])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert values(quality.check_enums(df), "n_bad_type", "n_bad_assertion", "n_missing") == {1: (2, 2, 2), 2: (0, 0, 0)}
    assert values(quality.check_grounding(df), "n_ungrounded", "n_ungrounded_nocase", "n_missing") == {1: (2, 2, 2), 2: (1, 1, 0)}
    assert values(quality.check_context_copied(df), "n_not_copied", "n_missing") == {1: (2, 2), 2: (1, 0)}
    assert values(quality.check_context_shape(df), "n_bad_size", "n_without_mention") == {1: (2, 2), 2: (1, 1)}


def test_label_balance(spark):
    rows = {(r.type, r.assertion, r.level): (r.n, r.share) for r in quality.label_balance(table(spark)).collect()}
    assert rows[None, None, 3] == (4, 1.0)
    assert rows["Symptom", None, 1] == (2, 0.5)
    assert rows["Symptom", "Negated", 0] == (1, 0.25)
    assert len(rows) == 4 + 3 + 1


def test_batch_coverage(spark):
    df = table(spark).selectExpr("*", "id % 2 AS batch_id")
    got = {r.batch_id: tuple(r)[1:] for r in quality.batch_label_coverage(df).collect()}
    assert got == {1: (2, True, True), 0: (1, False, False)}


def test_extra_keys(spark):
    raw = json.dumps({"items": [
        {"text": "a", "entities": [{"mention": "m", "span": 1}, {"mention": "m", "b": 2, "span": 3}]},
        {"text": "b", "note": 1},
        {"text": "c", "entities": "none"},
        7,
    ]})
    df = spark.createDataFrame([(raw, 4), ('{"items": []}', 0), ("bad", 1)], "raw STRING, expected INT")
    rows = quality.check_extra_keys(parse_responses(df)).collect()
    assert sorted((r.n_items_extra, r.n_entities_extra, r.extra_keys) for r in rows) == [
        (0, 0, []), (1, 2, ["b", "note", "span"]),
    ]


def test_rules_stay_narrow(spark):
    df = table(spark)
    for check in (
        quality.check_enums, quality.check_grounding, quality.check_context_copied,
        quality.check_context_shape,
    ):
        plan = check(df)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Generate" not in plan
