import pytest

from chatloom.operators.normalize import (
    as_text,
    keep_only,
    malformed_lines,
    normalize_annotations,
    normalize_records,
)

LINES = [
    '{"text":"a","entities":[{"mention":"m","type":"T","assertion":"P","context_window":"c","x":1}]}',
    '{"text":"b","entities":{"mention":"m2","type":"T"}}',
    '{"text":null,"entities":null}',
    '{"entities":[]}',
    "not json",
    "[1,2]",
    '{"text":5,"entities":[{"mention":7,"type":true,"assertion":null}]}',
    "",
    '{"text":"t"} trailing',
    '{"text":"t","entities":[1]}',
    '{"text":"t","entities":"none"}',
    '{"text":{"k": [1]},"other":2}',
    "null",
]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(list(enumerate(LINES, 1)), "n INT, value STRING")


def test_normalize_golden(lines):
    got = {
        r.n: (r.text, [tuple(e) for e in r.entities])
        for r in normalize_annotations(lines, bad_lines="skip").collect()
    }
    assert got == {
        1: ("a", [("m", "T", "P", "c")]),
        2: ("b", [("m2", "T", "", "")]),
        3: ("", []),
        4: ("", []),
        7: ("5", [("7", "true", "", "")]),
        12: ('{"k":[1]}', []),
    }


def test_malformed_lines_are_kept_apart(lines):
    got = {r.n: (r.defect, r.value) for r in malformed_lines(lines).collect()}
    assert {n: d for n, (d, _) in got.items()} == {
        5: "not_json", 6: "not_object", 8: "not_json", 9: "not_json",
        10: "bad_entities", 11: "bad_entities", 13: "not_object",
    }
    assert all(value == LINES[n - 1] for n, (_, value) in got.items())


def test_bad_lines_fail_by_default(lines):
    with pytest.raises(Exception, match="malformed annotation line"):
        normalize_annotations(lines).collect()
    good = lines.where("n <= 4")
    assert normalize_annotations(good).count() == 4
    with pytest.raises(ValueError):
        normalize_annotations(lines, bad_lines="other")


def test_records_and_projection(spark):
    schema = (
        "id INT, text STRING, entities ARRAY<STRUCT<mention: STRING, type: STRING, "
        "assertion: STRING, context_window: STRING>>"
    )
    df = spark.createDataFrame([(1, None, None), (2, "t", [("m", None, "P", None)])], schema)
    rows = normalize_records(df).orderBy("id").collect()
    assert (rows[0].text, rows[0].entities) == ("", [])
    assert tuple(rows[1].entities[0]) == ("m", "", "P", "")
    assert keep_only(df, "text").columns == ["text"]
    assert as_text(df.withColumnRenamed("text", "0"), "0", "id").columns == ["id", "text"]
