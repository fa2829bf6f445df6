"""One registered query per operator, flat columns, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.fixed_values import EXTRACTION_NOTE_TAG_PROMPT, EXTRACTION_SYSTEM_PROMPT
from chatloom.functions.batching import max_output_tokens, safe_batch
from chatloom.functions.jsonfmt import entities_json, json_string
from chatloom.functions.templates import CHATML, GEMMA, LLAMA, fill_template
from chatloom.functions.text import estimate_length, preview, word_count
from chatloom.operators import lengths, masking, messages, mixing, normalize, quality
from chatloom.operators import requests as req
from chatloom.operators import responses as resp
from chatloom.operators.rendering import (
    map_batches,
    render_conversation_parts,
    render_conversations,
)
from chatloom.operators.shaping import explode_rows
from chatloom.plans.generation import accepted_annotations, next_round, rejected_items, request_rows
from chatloom.plans.training_text import (
    annotation_training_splits,
    annotation_training_text,
    configured_training_rows,
    instruction_training_text,
    reasoning_chat_mix,
)
from chatloom.session import scratch_path
from chatloom.sources.readers import (
    read_annotations,
    read_lines,
    read_many,
    read_splits,
    read_table,
)
from chatloom.sources.shard_sets import append_shards, read_shard_set, versions
from chatloom.sources.writers import (
    annotation_line,
    assign_shards,
    shard_manifest,
    write_jsonl_sharded,
)
from checks import inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def named(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def big(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.table(spark, sf, "documents")


# Sources and sinks ---------------------------------------------------------


@query
def read_jsonl_roundtrip(spark, sf):
    path = scratch_path(spark, "annotations")
    inputs.notes(spark, sf).select(annotation_line().alias("value")).write.text(path)
    back = read_annotations(spark, f"{path}/*.txt")
    return back.select("text", entities_json("entities").alias("entities"))


@query
def read_clean_jsonl(spark, sf):
    path = scratch_path(spark, "annotations")
    inputs.notes(spark, sf).select(annotation_line().alias("value")).write.text(path)
    back = read_annotations(spark, path, clean=True)
    return back.select("text", entities_json("entities").alias("entities"))


@query
def named_splits(spark, sf):
    english = F.col("lang") == "en"
    line = F.concat(F.lit('{"text": '), json_string("text"), F.lit("}")).alias("value")
    files = {}
    for name, rows in (("train", english), ("eval", ~english)):
        files[name] = scratch_path(spark, name)
        documents(spark, sf).where(rows).select(line).write.text(files[name])
    splits = read_splits(spark, {**files, "test": None})
    return splits.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum(big(F.length("text"))).alias("n_chars")
    )


@query
def read_table_counts(spark, sf):
    frames = {}
    for name in ("documents", "conversations", "benchmark", "labels"):
        read_table(spark, f"{sf}/{name}.parquet").createOrReplaceTempView(f"chatloom_{name}")
        frames[name] = read_table(spark, f"chatloom_{name}")
    return normalize.row_counts(frames)


@query
def multi_dataset_load(spark, sf):
    names = {n: f"{sf}/{n}.parquet" for n in ("documents", "benchmark")}
    return read_many(spark, names, ["text"])


@query
def shard_roundtrip(spark, sf):
    path = scratch_path(spark, "shards")
    d = documents(spark, sf).select("doc_id", "lang", "source", "text")
    write_jsonl_sharded(d, path, 100, "doc_id")
    back = spark.read.schema(
        "doc_id BIGINT, lang STRING, source STRING, text STRING, shard STRING"
    ).json(path)
    return back.groupBy(big("shard").alias("shard")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("doc_id").alias("min_id"),
        F.max("doc_id").alias("max_id"),
        F.sum(big(F.length("text"))).alias("n_chars"),
    )


@query
def shard_append(spark, sf):
    path = scratch_path(spark, "shard_set")
    d = documents(spark, sf).select("doc_id", "lang", "source", "text")
    # Three writes of all documents; each fills the last shard of the one before.
    parts = [F.col("lang") == "en", F.col("lang").isin("de", "fr"), ~F.col("lang").isin("en", "de", "fr")]
    for part in parts:
        append_shards(d.where(part), path, 64, "doc_id")
    found = [read_shard_set(spark, path, v).withColumn("version", F.lit(v)) for v in versions(spark, path)]
    lines = found[0]
    for more in found[1:]:
        lines = lines.unionByName(more)
    row = F.from_json("value", "doc_id BIGINT, lang STRING, source STRING, text STRING")
    lines = lines.select("version", "shard", row.alias("r"))
    return lines.groupBy(big("version").alias("version"), "shard").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("r.doc_id").alias("min_id"),
        F.max("r.doc_id").alias("max_id"),
        F.sum(big(F.length("r.text"))).alias("n_chars"),
    )


@named("shard_manifest")
def shard_manifest_rows(spark, sf):
    return shard_manifest(documents(spark, sf), 100, "doc_id")


@query
def shard_rows(spark, sf):
    d = documents(spark, sf).select("source", "doc_id", "text")
    return assign_shards(d, 64, ["source", "doc_id"]).select("shard", "doc_id", "text")


# Projection and normalization ----------------------------------------------


def _normalized(spark, sf):
    return normalize.normalize_annotations(inputs.dirty_lines(spark, sf), bad_lines="skip")


@query
def normalize_text(spark, sf):
    return _normalized(spark, sf).select("doc_id", "text")


@query
def normalize_entities_null(spark, sf):
    n = _normalized(spark, sf)
    return n.select("doc_id", big(F.size("entities")).alias("n_entities"))


@query
def normalize_entities_dict(spark, sf):
    n = _normalized(spark, sf)
    return n.select("doc_id", entities_json("entities").alias("entities"))


@query
def normalize_entity_fields(spark, sf):
    rows = explode_rows(_normalized(spark, sf), "doc_id", array="entities", pos="seq", item="e")
    return rows.select("doc_id", "seq", "e.*")


@query
def malformed_annotation_lines(spark, sf):
    bad = normalize.malformed_lines(inputs.dirty_lines(spark, sf))
    return bad.select("doc_id", "defect", F.col("value").alias("line"))


@query
def project_text_only(spark, sf):
    return normalize.keep_only(documents(spark, sf), "text")


@query
def rename_text(spark, sf):
    d = documents(spark, sf).withColumnRenamed("text", "0")
    return normalize.as_text(d, "0", "doc_id")


@query
def strip_bos(spark, sf):
    rendered = render_conversations(inputs.conversations(spark, sf), GEMMA)
    bare = F.substring("text", len(GEMMA.bos) + 1, 2**31 - 1)
    some = rendered.withColumn(
        "text", F.when(F.col("conv_id") % 2 == 0, F.col("text")).otherwise(bare)
    )
    return normalize.strip_prefix(some, GEMMA.bos).select("conv_id", "text")


@query
def response_preview(spark, sf):
    return documents(spark, sf).select("doc_id", preview("text").alias("preview"))


@query
def row_counts(spark, sf):
    return normalize.row_counts({t: inputs.table(spark, sf, t) for t in ALL_TABLES})


# Conversation builders ------------------------------------------------------


@query
def annotation_messages(spark, sf):
    return messages.message_rows(messages.annotation_messages(inputs.notes(spark, sf)), "doc_id")


@query
def annotation_messages_note_tag(spark, sf):
    built = messages.annotation_messages(
        inputs.notes(spark, sf), user_template=EXTRACTION_NOTE_TAG_PROMPT
    )
    return messages.message_rows(built, "doc_id")


@query
def triple_messages(spark, sf):
    return messages.message_rows(
        messages.triple_messages(inputs.triples(spark, sf)), "conv_id", "turn"
    )


@query
def pair_messages(spark, sf):
    return messages.message_rows(
        messages.pair_messages(inputs.pairs(spark, sf)), "conv_id", "turn"
    )


@query
def standardize_sharegpt(spark, sf):
    aliases = {"human": "user", "gpt": "assistant"}
    done = messages.standardize_sharegpt(
        inputs.sharegpt(spark, sf), aliases=aliases, unknown="n_unknown"
    )
    return messages.message_rows(done, "conv_id", "n_unknown")


def _turn_json(m: Column) -> Column:
    return F.concat(
        F.lit('{"role": '), json_string(m["role"]),
        F.lit(', "content": '), json_string(m["content"]), F.lit("}"),
    )


@query
def assemble_conversations(spark, sf):
    turns = F.transform("conversations", _turn_json)
    return inputs.conversations(spark, sf).select(
        "conv_id",
        F.concat(F.lit("["), F.array_join(turns, ", "), F.lit("]")).alias("conversations"),
    )


@query
def assemble_conversation_parts(spark, sf):
    parts = messages.assemble_conversations(
        inputs.table(spark, sf, "conversations"), turns_per_row=2
    )
    return messages.message_rows(parts, "conv_id", "part")


@query
def prompt_messages(spark, sf):
    built = messages.prompt_messages(documents(spark, sf), system=EXTRACTION_SYSTEM_PROMPT)
    return messages.message_rows(built, "doc_id")


# Rendering ------------------------------------------------------------------


def _render(spark, sf, spec):
    return render_conversations(inputs.conversations(spark, sf), spec).select("conv_id", "text")


@query
def render_llama(spark, sf):
    return _render(spark, sf, LLAMA)


@query
def render_gemma(spark, sf):
    return _render(spark, sf, GEMMA)


@query
def render_chatml(spark, sf):
    return _render(spark, sf, CHATML)


@named("render_conversation_parts")
def rendered_parts_joined(spark, sf):
    parts = messages.assemble_conversations(
        inputs.table(spark, sf, "conversations"), turns_per_row=2
    )
    joined = lambda c: F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("part", c))), lambda p: p[c]), ""
    ).alias(c)
    rendered = render_conversation_parts(parts, LLAMA, out="llama")
    rendered = render_conversation_parts(rendered, GEMMA, out="gemma")
    return rendered.groupBy("conv_id").agg(joined("llama"), joined("gemma"))


@query
def render_generation_prompt(spark, sf):
    prompts = messages.prompt_messages(documents(spark, sf), user_template="{note}")
    rendered = render_conversations(prompts, CHATML, out="prompt", add_generation_prompt=True)
    return rendered.select("doc_id", "prompt")


@query
def render_open_conversations(spark, sf):
    last = F.element_at("conversations", -1)["role"]
    waiting = inputs.conversations(spark, sf).where(last == "user")
    return render_conversations(waiting, LLAMA, add_generation_prompt=True).select(
        "conv_id", "text"
    )


@named("fill_template")
def fill_template_rows(spark, sf):
    template = "Source {source} ({{verbatim}}):\n{text}\n-- {source}"
    filled = fill_template(template, source="source", text="text")
    return documents(spark, sf).select("doc_id", filled.alias("prompt"))


@named("entities_json")
def entities_json_target(spark, sf):
    return inputs.notes(spark, sf).select("doc_id", entities_json("entities").alias("target"))


@named("map_batches")
def map_batches_rows(spark, sf):
    def underline(pdf):
        return pdf.assign(text=pdf["text"].str.replace(" ", "_", regex=False))

    return map_batches(
        documents(spark, sf).select("doc_id", "text"), underline, "doc_id BIGINT, text STRING"
    )


# Response-only mask ---------------------------------------------------------


@query
def response_spans(spark, sf):
    return masking.response_spans(_render(spark, sf, LLAMA), "conv_id", spec=LLAMA)


@query
def response_spans_gemma(spark, sf):
    return masking.response_spans(_render(spark, sf, GEMMA), "conv_id", spec=GEMMA)


@query
def mask_stats(spark, sf):
    return masking.mask_stats(_render(spark, sf, LLAMA), "conv_id", spec=LLAMA)


# Sampling, slicing, mixing, splitting ----------------------------------------


@query
def head_slice(spark, sf):
    return mixing.head_slice(documents(spark, sf), 100, "doc_id").select("doc_id", "text")


@query
def cap_per_source(spark, sf):
    d = mixing.cap_per_source(documents(spark, sf), 20, "source", "doc_id")
    return d.select("source", "doc_id", "text")


def _base_and_pool(spark, sf):
    d = documents(spark, sf).select("doc_id", "lang", "text")
    return d.where(F.col("lang") == "en"), d.where(F.col("lang") != "en")


def _mixed(spark, sf):
    base, pool = _base_and_pool(spark, sf)
    chosen = mixing.sample_to_share(base, pool, 0.25, 2407, "doc_id")
    return mixing.mix({"base": base, "pool": chosen})


@query
def sample_to_share(spark, sf):
    base, pool = _base_and_pool(spark, sf)
    return mixing.sample_to_share(base, pool, 0.25, 2407, "doc_id")


@query
def mix_concat(spark, sf):
    return _mixed(spark, sf)


@query
def mix_whole_rows(spark, sf):
    d = documents(spark, sf)
    parts = {"english": "lang = 'en'", "french": "lang = 'fr'", "other": "lang not in ('en', 'fr')"}
    return mixing.mix({name: d.where(part) for name, part in parts.items()}, "part")


@query
def seeded_shuffle(spark, sf):
    return mixing.shuffle(_mixed(spark, sf), 3407, "doc_id", F.col("source"))


@query
def train_eval_split(spark, sf):
    return mixing.split_train_eval(documents(spark, sf), 0.1, 42, "doc_id").select(
        "doc_id", "split", "text"
    )


@query
def train_eval_split_by_hash(spark, sf):
    return mixing.split_by_hash(documents(spark, sf), 0.1, 42, "doc_id").select("doc_id", "split")


@query
def mix_report(spark, sf):
    report = mixing.mix_report(_mixed(spark, sf))
    return report.withColumn("share", F.round("share", 9))


# Length control --------------------------------------------------------------


@query
def length_stats(spark, sf):
    return lengths.length_stats(documents(spark, sf), "lang")


@query
def length_stats_chars4(spark, sf):
    return lengths.length_stats(documents(spark, sf), "lang", est="chars4")


@query
def length_quantiles(spark, sf):
    return lengths.length_quantiles(documents(spark, sf), "lang")


@query
def length_sketch_ranks(spark, sf):
    """Sketches per source, merged per language; whether each estimate's rank is in its bound."""
    k, docs = 800, documents(spark, sf)
    merged = lengths.merge_length_sketches(lengths.length_sketches(docs, "lang", "source", k=k), "lang", k=k)
    estimates = lengths.sketched_quantiles(merged, "lang").withColumnRenamed("len", "at")
    sizes = docs.select("lang", word_count("text").alias("len")).groupBy("lang", "len").agg(F.count(F.lit(1)).alias("c"))
    ranks = estimates.join(sizes, "lang").groupBy("lang", "share", "n").agg(
        F.coalesce(F.sum(F.when(F.col("len") < F.col("at"), F.col("c"))), F.lit(0)).alias("below"),
        F.coalesce(F.sum(F.when(F.col("len") <= F.col("at"), F.col("c"))), F.lit(0)).alias("upto"),
    )
    place, off = F.col("share") * F.col("n"), F.lit(lengths.sketch_rank_error(k)) * F.col("n") + 1
    within = (F.col("below") <= place + off) & (F.col("upto") >= place - off)
    return ranks.select("lang", "share", "n", within.alias("within"))


@query
def truncate_examples(spark, sf):
    cut = lengths.truncate(documents(spark, sf), limit=200)
    return cut.select("doc_id", "text", "was_truncated")


@query
def truncate_examples_chars4(spark, sf):
    cut = lengths.truncate(documents(spark, sf), est="chars4")
    return cut.select("doc_id", "text", "was_truncated")


@query
def pack_sequences(spark, sf):
    d = documents(spark, sf).select("doc_id", estimate_length("text", "chars4").alias("n"))
    return lengths.pack(d, "n", 2048, id="doc_id", seed=0, packs_per_bucket=16)


@query
def pack_within_budget(spark, sf):
    d = documents(spark, sf).select("doc_id", estimate_length("text", "chars4").alias("n"))
    return lengths.pack_within_budget(d, "n", 2048, id="doc_id", seed=0, packs_per_bucket=16)


@query
def configured_rows(spark, sf):
    rows = inputs.triples(spark, sf).withColumn("id", F.format_string("%08d.%06d", "conv_id", "turn"))
    brief = F.length("input") < 200
    datasets = {"brief": rows.where(brief), "detailed": rows.where(~brief)}
    made = configured_training_rows(datasets, cutoff=96, most_rows=400, packing=True)
    return made.select("dataset", "id", "split", "text", "was_truncated", "n_tokens", "bucket", "pack")


# Generation requests ---------------------------------------------------------


@named("safe_batch")
def safe_batch_grid(spark, sf):
    p = inputs.table(spark, sf, "part").select(
        big("p_partkey").alias("part"),
        big("p_size").alias("count"),
        big(F.col("p_partkey") % 3000).alias("tokens"),
    )
    sized = p.withColumn("batch", safe_batch("count", "tokens"))
    return sized.withColumn("max_output_tokens", max_output_tokens("batch", "tokens"))


@query
def plan_requests(spark, sf):
    return req.plan_requests(inputs.jobs(spark, sf))


@query
def render_requests(spark, sf):
    rendered = req.render_requests(req.plan_requests(inputs.jobs(spark, sf)), seed=11)
    return rendered.select("job_id", "batch_id", "system", "user")


@query
def request_payload(spark, sf):
    rendered = req.render_requests(req.plan_requests(inputs.jobs(spark, sf)))
    return req.request_payload(rendered, "small-model").select("job_id", "batch_id", "payload")


# Responses -------------------------------------------------------------------


def _parsed(spark, sf):
    return resp.parse_responses(inputs.responses(spark, sf))


def _validated(spark, sf):
    items = resp.explode_items(_parsed(spark, sf), "resp_id", "job_id", "batch_id")
    return resp.validate_annotations(items)


@query
def parse_status(spark, sf):
    ok = F.col("status") != "not_json"
    return _parsed(spark, sf).select("resp_id", ok.alias("is_json"))


@query
def contract_status(spark, sf):
    return _parsed(spark, sf).select("resp_id", "status")


@query
def item_count_mismatch(spark, sf):
    return _parsed(spark, sf).select("resp_id", "n_items", "expected", "count_mismatch")


@query
def explode_items(spark, sf):
    items = resp.explode_items(_parsed(spark, sf), "resp_id")
    text = F.try_variant_get("item", "$.text", "string")
    size = F.size(F.try_variant_get("item", "$.entities", "array<variant>"))
    return items.select(
        "resp_id", "item_pos", text.alias("text"), big(size).alias("n_entities")
    )


@query
def validate_annotations(spark, sf):
    return _validated(spark, sf).select(
        "resp_id",
        "item_pos",
        "valid",
        F.array_join("errors", ",").alias("errors"),
        "text",
        F.when(F.col("valid"), entities_json("entities")).alias("entities"),
    )


@query
def accepted_annotation_rows(spark, sf):
    rows = accepted_annotations(inputs.responses(spark, sf), "resp_id")
    return rows.select("resp_id", "item_pos", annotation_line().alias("line"))


@query
def rejected_item_rows(spark, sf):
    rows = rejected_items(inputs.responses(spark, sf), "resp_id")
    return rows.select("resp_id", "item_pos", F.array_join("errors", ",").alias("errors"))


def _accepted(spark, sf):
    counted = resp.count_accepted(resp.parse_responses(inputs.response_attempts(spark, sf)))
    return resp.first_usable(counted)


@query
def generation_progress(spark, sf):
    total = F.lit(100).cast("bigint")
    return resp.progress(_accepted(spark, sf).withColumn("total", total))


@query
def generation_followups(spark, sf):
    jobs = inputs.generation_jobs(spark, sf)
    return req.followup_requests(jobs, req.plan_requests(jobs), _accepted(spark, sf))


@query
def generation_round(spark, sf):
    jobs = inputs.generation_jobs(spark, sf)
    sent = request_rows(jobs, "small-model", 11)
    return next_round(jobs, sent, inputs.response_attempts(spark, sf), "small-model", 11).select(
        "kind", "job_id", "batch_id", "count", "remaining_before", "user", "payload"
    )


@query
def pending_requests(spark, sf):
    planned = req.plan_requests(inputs.generation_jobs(spark, sf))
    done = _parsed(spark, sf).where(F.col("status") == "ok")
    return resp.pending_requests(planned, done).select("job_id", "batch_id", "want", "count")


@query
def quarantine(spark, sf):
    return resp.quarantine(_parsed(spark, sf), "resp_id")


# Quality rules ---------------------------------------------------------------


@query
def check_enums(spark, sf):
    return quality.check_enums(inputs.gappy_notes(spark, sf)).drop("text", "entities")


@query
def check_extra_keys(spark, sf):
    checked = quality.check_extra_keys(_parsed(spark, sf))
    return checked.select(
        "resp_id",
        "n_items_extra",
        "n_entities_extra",
        F.array_join("extra_keys", ",").alias("extra_keys"),
    )


@query
def check_grounding(spark, sf):
    return quality.check_grounding(inputs.gappy_notes(spark, sf)).drop("text", "entities")


@query
def check_context_copied(spark, sf):
    return quality.check_context_copied(inputs.gappy_notes(spark, sf)).drop("text", "entities")


@query
def check_context_shape(spark, sf):
    return quality.check_context_shape(inputs.gappy_notes(spark, sf)).drop("text", "entities")


@query
def check_note_length(spark, sf):
    return quality.check_note_length(documents(spark, sf), 200).select(
        "doc_id", "n_words", "in_range"
    )


@query
def label_balance(spark, sf):
    report = quality.label_balance(inputs.notes(spark, sf))
    return report.withColumn("share", F.round("share", 9))


@query
def batch_label_coverage(spark, sf):
    batch = F.floor(F.col("doc_id") / F.lit(10)).cast("bigint")
    return quality.batch_label_coverage(
        inputs.notes(spark, sf).withColumn("batch_id", batch), "batch_id"
    )


# Whole runs ------------------------------------------------------------------


@query
def annotation_training_rows(spark, sf):
    return annotation_training_text(inputs.dirty_lines(spark, sf), "doc_id", bad_lines="skip")


@query
def archived_training_rows(spark, sf):
    lines = inputs.dirty_lines(spark, sf)
    held_out = F.col("doc_id") % 10 == 0
    splits = {"train": lines.where(~held_out), "eval": lines.where(held_out), "test": None}
    return annotation_training_splits(splits, "doc_id", bad_lines="skip")


@query
def instruction_training_rows(spark, sf):
    return instruction_training_text(inputs.triples(spark, sf), "conv_id", "turn")


@query
def reasoning_chat_rows(spark, sf):
    pairs = inputs.pairs(spark, sf)
    pairs = pairs.withColumn("id", F.concat_ws(".", "conv_id", "turn")).drop("conv_id", "turn")
    chats = inputs.sharegpt(spark, sf).select(F.col("conv_id").cast("string").alias("id"), "conversations")
    return reasoning_chat_mix(pairs, chats)
