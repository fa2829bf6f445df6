"""Inputs derived from the given tables, row for row, over whole tables and texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.jsonfmt import json_list, json_string
from chatloom.functions.text import let
from chatloom.operators.messages import assemble_conversations
from chatloom.schemas import ENTITY_FIELDS
from chatloom.sources.readers import read_table

ENTITY_EVERY = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def hex_digit(c: Column, pos: int) -> Column:
    return F.instr(F.lit("0123456789abcdef"), F.substring(c, pos, 1)) - 1


def raw_entity(ws: Column, doc_id: Column, i: Column) -> Column:
    """Entity at word ``i``, damaged in one way or another by a hash."""
    word = F.get(ws, i)

    def words(first: int, last: int) -> Column:
        return F.array_join(F.array(*[F.get(ws, i + k) for k in range(first, last + 1)]), " ")

    def pick(h: Column, pos: int, *choices: str) -> Column:
        options = F.array(*[F.lit(c) for c in choices])
        return F.get(options, (hex_digit(h, pos) % len(choices)).cast("int"))

    def build(h: Column) -> Column:
        c = F.substring(h, 5, 1)
        return F.struct(
            F.when(c == "0", F.concat(word, F.lit("#"))).otherwise(word).alias("mention"),
            F.when(c == "1", "Other")
            .otherwise(pick(h, 1, "Symptom", "Diagnosis", "Treatment"))
            .alias("type"),
            F.when(c == "2", "Unknown")
            .otherwise(pick(h, 7, "Positive", "Negated", "Possible"))
            .alias("assertion"),
            F.when(c == "3", "")
            .when(c == "4", words(-2, 0))
            .when(c == "5", F.concat(F.lit("~"), words(-2, 4)))
            .otherwise(words(-2, 4))
            .alias("context_window"),
            c.alias("damage"),
            F.substring(h, 9, 1).alias("gap"),
        )

    return let(F.md5(F.concat(doc_id.cast("string"), F.lit(":"), i.cast("string"))), build)


def raw_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    d = d.withColumn("ws", F.split("text", " "))
    last = F.greatest(F.size("ws") - 1, F.lit(3))
    at = F.filter(F.sequence(F.lit(3), last, F.lit(ENTITY_EVERY)), lambda i: i < F.size("ws"))
    found = F.transform(at, lambda i: raw_entity(F.col("ws"), F.col("doc_id"), i))
    return d.withColumn("raw_entities", found).drop("ws")


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated notes: every document, an entity at word 3 and every 40 words."""
    clean = F.transform(
        "raw_entities", lambda e: F.struct(*[e[f].alias(f) for f in ENTITY_FIELDS])
    )
    return raw_notes(spark, sf_dir).select("doc_id", "source", "text", clean.alias("entities"))


def gappy_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated notes in which a hash takes away or empties some fields."""
    gaps = {"mention": ("0", "1"), "type": ("2", "3"), "assertion": ("4", "5"), "context_window": ("6", "3")}

    def field(e: Column, f: str) -> Column:
        null, empty = gaps[f]
        kept = F.when(e["gap"] == empty, "").otherwise(e[f])
        return F.when(e["gap"] != null, kept).alias(f)

    gappy = F.transform("raw_entities", lambda e: F.struct(*[field(e, f) for f in ENTITY_FIELDS]))
    return raw_notes(spark, sf_dir).select("doc_id", "source", "text", gappy.alias("entities"))


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One annotation line per document, in nine regular and irregular shapes."""
    d = table(spark, sf_dir, "documents")
    kind = hex_digit(F.md5(F.concat(F.lit("dirty:"), F.col("doc_id").cast("string"))), 1) % 9
    q, doc = json_string("text"), F.col("doc_id").cast("string")
    w = json_string(F.substring_index("text", " ", 1))
    cat = lambda *parts: F.concat(
        *[F.lit(p) if isinstance(p, str) else p for p in parts]
    )
    line = (
        F.when(
            kind == 0,
            cat('{"text": ', q, ', "entities": [{"mention": ', w, ', "type": "Symptom", ',
                '"assertion": "Positive", "context_window": ', json_string("lang"), ', "x": 1}]}'),
        )
        .when(
            kind == 1,
            cat('{"text": ', q, ', "entities": {"mention": ', w, ', "type": "Diagnosis"}}'),
        )
        .when(kind == 2, '{"text": null, "entities": null}')
        .when(kind == 3, '{"entities": []}')
        .when(kind == 4, F.replace("text", F.lit("\n"), F.lit(" ")))
        .when(kind == 5, cat("[1, ", q, "]"))
        .when(
            kind == 6,
            cat('{"text": ', doc, ', "entities": [{"mention": 7, "type": true, "assertion": null, ',
                '"context_window": ', q, "}]}"),
        )
        .when(kind == 7, "")
        .otherwise(cat('{"text": ', q, ', "entities": [1, 2]}'))
    )
    return d.select("doc_id", line.alias("value"))


def _entity_text(e: Column) -> Column:
    return F.concat(
        F.lit('{"mention": '), json_string(e["mention"]),
        F.lit(', "type": '), json_string(e["type"]),
        F.when(e["damage"] == "7", "").otherwise(
            F.concat(F.lit(', "assertion": '), json_string(e["assertion"]))
        ),
        F.lit(', "context_window": '), json_string(e["context_window"]),
        F.when(e["damage"] == "6", ', "span": 1').otherwise(""),
        F.lit("}"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten notes per response, some responses and items damaged.

    ``(resp_id, job_id, batch_id, attempt, expected, raw)``; at most ten rows of
    one id range meet in a group.
    """
    n = raw_notes(spark, sf_dir)
    item_kind = F.substring(F.md5(F.concat(F.lit("item:"), F.col("doc_id").cast("string"))), 1, 1)
    q = json_string("text")
    ents = json_list(F.transform("raw_entities", _entity_text))
    item = (
        F.when(
            item_kind == "0",
            F.concat(F.lit('{"text": '), F.col("doc_id").cast("string"), F.lit(', "entities": '),
                     ents, F.lit("}")),
        )
        .when(item_kind == "1", F.concat(F.lit('{"text": '), q, F.lit(', "entities": "none"}')))
        .when(item_kind == "2", q)
        .when(item_kind == "3", F.concat(F.lit('{"text": '), q, F.lit("}")))
        .when(
            item_kind == "4",
            F.concat(F.lit('{"note_id": 1, "text": '), q, F.lit(', "entities": '), ents, F.lit("}")),
        )
        .when(
            item_kind == "5",
            F.concat(F.lit('{"text": "first", "text": '), q, F.lit(', "entities": '), ents, F.lit("}")),
        )
        .when(item_kind == "6", F.concat(F.lit('{"text": NaN, "entities": '), ents, F.lit("}")))
        .otherwise(F.concat(F.lit('{"text": '), q, F.lit(', "entities": '), ents, F.lit("}")))
    )
    resp_id = F.floor(F.col("doc_id") / F.lit(10)).cast("bigint")
    kind = F.substring(F.md5(F.concat(F.lit("resp:"), F.col("resp_id").cast("string"))), 1, 1)
    items = n.select(resp_id.alias("resp_id"), "doc_id", item.alias("item"))
    kept = items.withColumn("kind", kind).where(
        (F.col("kind") != "6") | (F.col("doc_id") % 10 != 9)
    )
    joined = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.struct("doc_id", "item"))), lambda s: s["item"]
        ),
        ", ",
    )
    full = F.concat(F.lit('{"items": ['), F.col("joined"), F.lit("]}"))
    raw = (
        F.when(F.col("kind") == "0", F.expr("substr(full, 1, length(full) - 20)"))
        .when(F.col("kind") == "1", F.concat(F.col("full"), F.lit(" done")))
        .when(F.col("kind") == "2", F.concat(F.lit("["), F.col("joined"), F.lit("]")))
        .when(F.col("kind") == "3", '{"items": 3}')
        .when(F.col("kind") == "4", F.concat(F.lit('{"results": ['), F.col("joined"), F.lit("]}")))
        .when(
            F.col("kind") == "5",
            F.concat(F.lit('{"items": ['), F.col("joined"), F.lit(', {"entities": []}]}')),
        )
        .when(F.col("kind") == "7", '{"items": null}')
        .otherwise(F.col("full"))
    )
    grouped = kept.groupBy("resp_id", "kind").agg(joined.alias("joined"))
    return grouped.withColumn("full", full).select(
        "resp_id",
        F.floor(F.col("resp_id") / F.lit(10)).cast("bigint").alias("job_id"),
        (F.col("resp_id") % 10).alias("batch_id"),
        F.lit(1).cast("bigint").alias("attempt"),
        F.lit(10).cast("bigint").alias("expected"),
        raw.alias("raw"),
    )


def response_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with retries: an empty answer before every fourth, every fifth twice."""
    empty = F.struct(F.lit(1).cast("bigint").alias("attempt"), F.lit('{"items": []}').alias("raw"))
    given = lambda n: F.struct(F.lit(n).cast("bigint").alias("attempt"), "raw")
    sent = F.array_compact(
        F.array(
            F.when(F.col("resp_id") % 4 == 0, empty),
            given(2),
            F.when(F.col("resp_id") % 5 == 0, given(3)),
        )
    )
    rows = responses(spark, sf_dir).withColumn("sent", F.explode(sent)).drop("attempt", "raw")
    return rows.select("*", "sent.attempt", "sent.raw").drop("sent")


def generation_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job per hundred documents, in requests of ten."""
    job = F.floor(F.col("doc_id") / F.lit(100)).cast("bigint").alias("job_id")
    per_job = table(spark, sf_dir, "documents").groupBy(job).agg(F.count(F.lit(1)).alias("total"))
    return per_job.withColumn("batch_size", F.lit(10)).withColumn("tokens", F.lit(200))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generation job per customer, sizes taken from its numbers."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("job_id"),
        F.floor(F.col("c_acctbal") / F.lit(25)).cast("bigint").alias("total"),
        (F.col("c_nationkey") + 1).cast("bigint").alias("batch_size"),
        (F.col("c_custkey") * 37 % 2950).alias("tokens"),
    )


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_conversations(table(spark, sf_dir, "conversations"))


def sharegpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as ``{from, value}`` messages."""
    theirs = lambda m: (
        F.when(m["role"] == "user", "human").when(m["role"] == "assistant", "gpt").otherwise(m["role"])
    )
    return conversations(spark, sf_dir).withColumn(
        "conversations",
        F.transform(
            "conversations", lambda m: F.struct(theirs(m).alias("from"), m["content"].alias("value"))
        ),
    )


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn with the assistant turn that follows it, ``""`` where none does.

    ``(conv_id, turn, task, input, expected_output)``; the task is the text of the
    conversation's system turns.
    """

    def one(messages: Column) -> Column:
        def exchange(m: Column, i: Column) -> Column:
            reply = F.get(messages, i + 1)
            return F.struct(
                i.cast("bigint").alias("turn"),
                (m["role"] == "user").alias("asked"),
                m["content"].alias("input"),
                F.coalesce(F.when(reply["role"] == "assistant", reply["content"]), F.lit("")).alias(
                    "expected_output"
                ),
            )

        return F.filter(F.transform(messages, exchange), lambda e: e["asked"])

    system = F.filter("conversations", lambda m: m["role"] == "system")
    task = F.array_join(F.transform(system, lambda m: m["content"]), "\n\n")
    return (
        conversations(spark, sf_dir)
        .select(
            "conv_id",
            F.when(task == "", "Answer the user.").otherwise(task).alias("task"),
            F.explode(one(F.col("conversations"))).alias("e"),
        )
        .select("conv_id", "e.turn", "task", "e.input", "e.expected_output")
    )


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchanges(spark, sf_dir)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchanges(spark, sf_dir).select(
        "conv_id",
        "turn",
        F.col("input").alias("problem"),
        F.col("expected_output").alias("generated_solution"),
    )
