import json
import random
import string

from pyspark.sql import functions as F

from chatloom.functions import text as tx
from chatloom.functions.jsonfmt import entities_json, json_string, parse_json_object, parse_json_text
from chatloom.schemas import ENTITY_FIELDS

ALPHABET = string.printable + "".join(map(chr, range(0x20))) + '\x7f"\\\\/äß€漢😀  '


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 30))) for _ in range(n)]


def test_json_string_is_byte_exact(spark):
    texts = [*random_texts(400, 1), "", "\\u001F", "a\\u000b", *[chr(i) for i in range(0x20)]]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    for row in df.select("t", json_string("t").alias("q")).collect():
        assert row.q == json.dumps(row.t, ensure_ascii=False)


def test_entities_json_is_byte_exact(spark):
    words = random_texts(200, 2)
    rows = [
        ([dict(zip(ENTITY_FIELDS, words[i : i + 4])), dict(zip(ENTITY_FIELDS, words[i + 1 : i + 5]))],)
        for i in range(0, 150, 3)
    ]
    rows.append(([],))
    schema = "e ARRAY<STRUCT<mention: STRING, type: STRING, assertion: STRING, context_window: STRING>>"
    df = spark.createDataFrame(rows, schema).select("e", entities_json("e").alias("j"))
    for row in df.collect():
        want = {"entities": [e.asDict() for e in row.e]}
        assert row.j == json.dumps(want, ensure_ascii=False)
    missing = spark.createDataFrame([(None,)], schema).select(entities_json("e").alias("j"))
    assert missing.first().j == '{"entities": []}'


def test_json_text_has_to_be_one_document(spark):
    cases = {
        '{"a": 1}': True,
        ' {"a": [1, 2]}\n': True,
        "[1, 2]": True,
        "null": True,
        "5": True,
        '{"a": 1} x': False,
        '{"a": 1}{"a": 2}': False,
        '{"a": 1}]': False,
        '{"a": 1}, 7]': False,
        '1],[2': False,
        "": False,
        " ": False,
        "NaN": True,
        '{"a": }': False,
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "raw STRING")
    got = {
        r.raw: r.ok
        for r in df.select("raw", parse_json_text("raw").isNotNull().alias("ok")).collect()
    }
    assert got == {**cases, None: False}


def test_json_object_struct(spark):
    cases = ['{"a": 1, "b": [1, 2]}', "[1]", "null", '{"a": 1} x', '{"a": 1}, {"~mark": 1}]', "7", "{}"]
    df = spark.createDataFrame([(c,) for c in cases], "raw STRING")
    got = [r.o for r in df.select(parse_json_object("raw", "a: STRING, b: STRING").alias("o")).collect()]
    assert [None if o is None else (o.a, o.b) for o in got] == [
        ("1", "[1,2]"), None, None, None, None, None, (None, None),
    ]


def test_strip_words_and_prefix(spark):
    texts = ["", "   ", "a", " a  b\n", "\t\n x y z ", "　wide　", *random_texts(150, 3)]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").select(
        "t",
        tx.strip("t").alias("s"),
        tx.remove_prefix("t", " a").alias("p"),
        tx.preview("t", 3).alias("v"),
        tx.quarter_chars("t").alias("q"),
    )
    for r in df.collect():
        assert r.s == r.t.strip()
        assert r.p == r.t.removeprefix(" a")
        assert r.v == r.t[:3]
        assert r.q == -(-len(r.t) // 4)
    twice = spark.createDataFrame([("<bos><bos>x",), (".+x",)], "t STRING")
    assert [r.p for r in twice.select(tx.remove_prefix("t", "<bos>").alias("p")).collect()] == [
        "<bos>x", ".+x",
    ]


def test_word_count_and_first_words(spark):
    texts = ["", " ", "one", " one two\n\nthree  four ", "a b c d", "x\ty\nz w"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t STRING").select(
        "t", tx.word_count("t").alias("n"), tx.first_words("t", 2).alias("f")
    )
    for r in df.collect():
        assert r.n == len((r.t or "").split())
        if r.n > 2:
            assert r.f.split() == r.t.split()[:2]
            assert r.t.startswith(r.f)


def test_let_binds_once(spark):
    df = spark.range(3).select(tx.let(F.col("id") + 1, lambda v: v * v).alias("sq"))
    assert [r.sq for r in df.collect()] == [1, 4, 9]
