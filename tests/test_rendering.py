import pytest
from pyspark.sql import functions as F

from chatloom.functions.templates import CHATML, GEMMA, LLAMA, TemplateSpec, fill_template, render_chat
from chatloom.operators.masking import mask_stats, response_spans
from chatloom.operators.messages import (
    assemble_conversations,
    prompt_messages,
    standardize_sharegpt,
)
from chatloom.operators.rendering import map_batches, render_conversations

CONVERSATION = "c ARRAY<STRUCT<role: STRING, content: STRING>>"


def render(spark, turns, spec, **options):
    df = spark.createDataFrame([(turns,)], CONVERSATION)
    return df.select(render_chat("c", spec, **options).alias("t")).first().t


def test_llama(spark):
    turns = [("system", " S "), ("user", "U"), ("assistant", "A\n")]
    assert render(spark, turns, LLAMA) == (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nS<|eot_id|>"
        "<|start_header_id|>user<|end_header_id|>\n\nU<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\nA<|eot_id|>"
    )


def test_gemma_folds_system(spark):
    turns = [("system", "S"), ("user", "U"), ("assistant", "A"), ("user", "V")]
    assert render(spark, turns, GEMMA, add_generation_prompt=True) == (
        "<bos><start_of_turn>user\nS\n\nU<end_of_turn>\n<start_of_turn>model\nA<end_of_turn>\n"
        "<start_of_turn>user\nV<end_of_turn>\n<start_of_turn>model\n"
    )
    assert render(spark, [("system", "S"), ("assistant", "A")], GEMMA) == (
        "<bos><start_of_turn>user\nS<end_of_turn>\n<start_of_turn>model\nA<end_of_turn>\n"
    )
    assert render(spark, [("user", "U")], GEMMA) == "<bos><start_of_turn>user\nU<end_of_turn>\n"


def test_chatml_and_policies(spark):
    turns = [("system", "S"), ("user", " U "), ("assistant", None)]
    assert render(spark, turns, CHATML) == (
        "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\n U <|im_end|>\n"
        "<|im_start|>assistant\n<|im_end|>\n"
    )
    bare = TemplateSpec("bare", "[", "]", ";", system_policy="drop")
    assert render(spark, turns, bare) == "[user] U ;[assistant];"
    assert render(spark, [], bare) == ""
    with pytest.raises(ValueError):
        render(spark, turns, TemplateSpec("odd", "", "", "", system_policy="other"))


def test_fill_template_never_rescans_values(spark):
    df = spark.createDataFrame([("{count} {x}", 3), (None, 4)], "note STRING, count INT")
    got = df.select(fill_template("{{k}} {count}: {note} / {count}", note="note", count="count").alias("t"))
    assert [r.t for r in got.collect()] == ["{k} 3: {count} {x} / 3", "{k} 4:  / 4"]
    with pytest.raises(KeyError):
        fill_template("{missing}", note="note")


def test_prompt_messages_system_is_optional(spark):
    df = spark.createDataFrame([("n",)], "text STRING")
    assert [m.role for m in prompt_messages(df).first().conversations] == ["user"]
    both = prompt_messages(df, system="S", user_template="<{note}>").first().conversations
    assert [(m.role, m.content) for m in both] == [("system", "S"), ("user", "<n>")]


def test_sharegpt_aliases_and_unknown_roles(spark):
    rows = [([("human", "h"), ("gpt", "g"), ("tool", "t"), (None, "n"), ("user", "u")],)]
    df = spark.createDataFrame(rows, "conversations ARRAY<STRUCT<`from`: STRING, value: STRING>>")
    row = standardize_sharegpt(df, unknown="n_unknown").first()
    assert [m.role for m in row.conversations] == ["user", "assistant", "tool", None, "user"]
    assert row.n_unknown == 2


def test_assembly_sorts_by_turn_whatever_the_partitioning(spark):
    turns = [(c, t, "user", f"{c}-{t}") for c in range(5) for t in range(12)]
    df = spark.createDataFrame(turns, "conv_id INT, turn INT, role STRING, text STRING")
    for n in (1, 7, 32):
        shuffled = df.repartition(n, F.rand(n))
        for r in assemble_conversations(shuffled).collect():
            assert [m.content for m in r.conversations] == [f"{r.conv_id}-{t}" for t in range(12)]
        parts = assemble_conversations(shuffled, turns_per_row=5).collect()
        assert sorted((r.conv_id, r.part, len(r.conversations)) for r in parts) == [
            (c, p, n) for c in range(5) for p, n in ((0, 5), (1, 5), (2, 2))
        ]


def test_mask_edges(spark):
    u, a = LLAMA.instruction_part, LLAMA.response_part
    texts = {
        "none": "plain",
        "no_reply": u + "q<|eot_id|>",
        "one": u + "q" + a + "answer",
        "empty": u + "q" + a,
        "adjacent": a + a + "x",
        "reply_first": a + "hi" + u + "q" + a + "yo",
        "two": u + a + "r1" + u + u + a + "r2",
        "umlaut": u + "ä" + a + "öé😀",
    }
    df = spark.createDataFrame(list(texts.items()), "id STRING, text STRING")
    spans = {}
    for r in response_spans(df, "id", spec=LLAMA).orderBy("id", "seq").collect():
        spans.setdefault(r.id, []).append(r.text)
        # Offsets count UTF-16-free characters, as Python does.
        assert texts[r.id][r.start : r.end] == r.text
    assert spans == {
        "one": ["answer"],
        "empty": [""],
        "adjacent": [a + "x"],
        "reply_first": ["hi", "yo"],
        "two": ["r1", "r2"],
        "umlaut": ["öé😀"],
    }
    for r in mask_stats(df, "id", spec=LLAMA).collect():
        assert r.trained_chars == sum(map(len, spans.get(r.id, [])))
        assert r.total_chars == len(texts[r.id])


def test_one_span_per_assistant_turn(spark, small):
    turns = spark.read.parquet(f"{small}/conversations.parquet")
    rendered = render_conversations(assemble_conversations(turns), LLAMA)
    n = response_spans(rendered, "conv_id", spec=LLAMA).count()
    assert n == turns.where("role = 'assistant'").count()


def test_map_batches(spark):
    df = spark.range(10).withColumn("t", F.lit("a"))
    out = map_batches(df, lambda pdf: pdf.assign(t=pdf["t"] * 2), "id BIGINT, t STRING")
    assert {r.t for r in out.collect()} == {"aa"} and out.count() == 10


def test_one_conversation_with_a_third_of_all_turns(spark):
    n = 60_000
    hot = spark.range(n).select(F.lit(0).alias("conv_id"), F.col("id").alias("turn"))
    cold = spark.range(2 * n).select((F.col("id") % 5000 + 1).cast("int").alias("conv_id"), "id")
    turns = hot.union(cold).select(
        "conv_id",
        "turn",
        F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), F.col("turn").cast("string")).alias("text"),
    )
    rendered = render_conversations(assemble_conversations(turns), LLAMA)
    spans = response_spans(rendered, "conv_id", spec=LLAMA).where("conv_id = 0")
    row = spans.agg(
        F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("chars")
    ).first()
    # Each reply runs to the next user header, its end-of-turn mark included.
    want = sum(len(f"t{i}") + len(LLAMA.end_of_turn) for i in range(1, n, 2))
    assert (row.n, row.chars) == (n // 2, want)
    stats = mask_stats(rendered, "conv_id", spec=LLAMA).where("conv_id = 0").first()
    assert stats.trained_chars == want


def test_format_specs_are_an_error():
    for template in ("{a!r}", "{a:>10}"):
        with pytest.raises(ValueError):
            fill_template(template, a="a")


SYSTEM_PLACES = [
    ["system", "user", "assistant", "user"], ["user", "system", "assistant"], ["assistant", "assistant", "system", "user"],
    ["system", "system", "assistant"], ["system"], ["assistant"], ["user", "assistant", "system", "user", "system"],
]


@pytest.mark.parametrize("size", [1, 2, 3, 10])
def test_parts_join_to_the_whole_text(spark, size):
    from chatloom.operators.messages import assemble_conversations
    from chatloom.operators.rendering import render_conversation_parts, render_conversations

    rows = [(c, t + 3 * c, role, f"{role} {t}") for c, roles in enumerate(SYSTEM_PLACES) for t, role in enumerate(roles)]
    rows += [(None, 0, "user", "no id")]
    turns = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").repartition(5)
    dropping = TemplateSpec("x", "<", ">", "</>", bos="^", system_policy="drop")
    for spec in (LLAMA, GEMMA, CHATML, dropping):
        whole = render_conversations(assemble_conversations(turns), spec, add_generation_prompt=True)
        parts = assemble_conversations(turns, turns_per_row=size)
        rendered = render_conversation_parts(parts, spec, add_generation_prompt=True)
        assert rendered.columns == ["conv_id", "part", "conversations", "text"]
        joined = {}
        for r in rendered.orderBy("conv_id", "part").collect():
            joined[r.conv_id] = joined.get(r.conv_id, "") + r.text
        assert joined == {r.conv_id: r.text for r in whole.collect()}


def test_a_million_turns(spark):
    from chatloom.operators.messages import assemble_conversations
    from chatloom.operators.rendering import render_conversation_parts

    n = 1_000_000
    role = F.when(F.col("id") == 0, "system").when(F.col("id") % 2 == 1, "user").otherwise("assistant")
    turns = spark.range(0, n, 1, 8).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("hi").alias("text"))
    out = render_conversation_parts(assemble_conversations(turns, turns_per_row=20_000), GEMMA)
    got = {r.part: (r.n, r.begin) for r in out.select("part", F.length("text").alias("n"), F.col("text").startswith("<bos>").alias("begin")).collect()}
    user, model = len("<start_of_turn>user\nhi<end_of_turn>\n"), len("<start_of_turn>model\nhi<end_of_turn>\n")
    assert [p for p, (_, begin) in got.items() if begin] == [0] and len(got) == 50
    assert sum(size for size, _ in got.values()) == len("<bos>hi\n\n") + n // 2 * user + (n // 2 - 1) * model
