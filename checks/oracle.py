"""SQL for each registered query, written for DuckDB on the same tables."""

from __future__ import annotations

from chatloom.fixed_values import (
    EXTRACTION_NOTE_TAG_PROMPT,
    EXTRACTION_SYSTEM_PROMPT,
    EXTRACTION_USER_PROMPT,
    GENERATION_SYSTEM_PROMPT,
    GENERATION_UNIT_SCHEMA,
    GENERATION_USER_PROMPT,
)

ORACLES: dict[str, str] = {}


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def js(expr: str) -> str:
    """A quoted JSON string."""
    return f"(to_json({expr})::VARCHAR)"


def filled(template: str, **values: str) -> str:
    """A prompt template as a SQL concatenation."""
    out, rest = [], template
    while rest:
        cut = min(((rest.find("{" + n + "}"), n) for n in values if "{" + n + "}" in rest), default=None)
        if cut is None:
            out.append(lit(rest))
            break
        at, name = cut
        if at:
            out.append(lit(rest[:at]))
        out.append(f"({values[name]})::VARCHAR")
        rest = rest[at + len(name) + 2 :]
    return "(" + " || ".join(out) + ")"


def digit(expr: str, pos: int) -> str:
    return f"(instr('0123456789abcdef', substr({expr}, {pos}, 1)) - 1)"


# Derived inputs ---------------------------------------------------------------

NOTES = f"""
words AS (
  SELECT doc_id, source, text, string_split(text, ' ') AS ws FROM documents
),
ents AS (
  SELECT doc_id, source, text, ws, i, md5(doc_id || ':' || i) AS h
  FROM (SELECT *, unnest(range(3, len(ws), 40)) AS i FROM words)
),
ent AS (
  SELECT doc_id, i, substr(h, 5, 1) AS damage, substr(h, 9, 1) AS gap,
    ws[i + 1] || CASE WHEN substr(h, 5, 1) = '0' THEN '#' ELSE '' END AS mention,
    CASE WHEN substr(h, 5, 1) = '1' THEN 'Other'
         ELSE ['Symptom', 'Diagnosis', 'Treatment'][{digit('h', 1)} % 3 + 1] END AS type,
    CASE WHEN substr(h, 5, 1) = '2' THEN 'Unknown'
         ELSE ['Positive', 'Negated', 'Possible'][{digit('h', 7)} % 3 + 1] END AS assertion,
    CASE substr(h, 5, 1)
      WHEN '3' THEN ''
      WHEN '4' THEN array_to_string(ws[i - 1 : i + 1], ' ')
      WHEN '5' THEN '~' || array_to_string(ws[i - 1 : i + 5], ' ')
      ELSE array_to_string(ws[i - 1 : i + 5], ' ') END AS context_window
  FROM ents
)
"""

ENTITY_JSON = (
    f"'{{\"mention\": ' || {js('mention')} || ', \"type\": ' || {js('type')} || "
    f"', \"assertion\": ' || {js('assertion')} || ', \"context_window\": ' || "
    f"{js('context_window')} || '}}'"
)

TARGETS = f"""
{NOTES},
target AS (
  SELECT d.doc_id, d.text,
    '{{"entities": [' || coalesce(e.list, '') || ']}}' AS target,
    '{{"text": ' || {js('d.text')} || ', "entities": [' || coalesce(e.list, '') || ']}}' AS line
  FROM documents d
  LEFT JOIN (
    SELECT doc_id, string_agg({ENTITY_JSON}, ', ' ORDER BY i) AS list FROM ent GROUP BY doc_id
  ) e USING (doc_id)
)
"""

DIRTY = f"""
kinds AS (
  SELECT doc_id, text, lang, {js('text')} AS q, {js("split_part(text, ' ', 1)")} AS w,
    {digit("md5('dirty:' || doc_id)", 1)} % 9 AS kind
  FROM documents
),
dirty AS (
  SELECT doc_id, CASE kind
    WHEN 0 THEN '{{"text": ' || q || ', "entities": [{{"mention": ' || w ||
      ', "type": "Symptom", "assertion": "Positive", "context_window": ' || {js('lang')} ||
      ', "x": 1}}]}}'
    WHEN 1 THEN '{{"text": ' || q || ', "entities": {{"mention": ' || w || ', "type": "Diagnosis"}}}}'
    WHEN 2 THEN '{{"text": null, "entities": null}}'
    WHEN 3 THEN '{{"entities": []}}'
    WHEN 4 THEN replace(text, chr(10), ' ')
    WHEN 5 THEN '[1, ' || q || ']'
    WHEN 6 THEN '{{"text": ' || doc_id ||
      ', "entities": [{{"mention": 7, "type": true, "assertion": null, "context_window": ' || q || '}}]}}'
    WHEN 7 THEN ''
    ELSE '{{"text": ' || q || ', "entities": [1, 2]}}' END AS line
  FROM kinds
),
doc AS (
  SELECT doc_id, line, CASE WHEN json_valid(line) THEN line::JSON END AS j FROM dirty
),
typed AS (
  SELECT doc_id, line, j, json_type(j) AS kind, json_type(j, '$.entities') AS ekind,
    CASE json_type(j, '$.entities')
      WHEN 'ARRAY' THEN json_extract(j, '$.entities[*]')
      WHEN 'OBJECT' THEN [json_extract(j, '$.entities')]
      ELSE [] END AS items
  FROM doc
),
judged AS (
  SELECT *, CASE
    WHEN j IS NULL THEN 'not_json'
    WHEN kind <> 'OBJECT' THEN 'not_object'
    WHEN len(list_filter(items, lambda x: json_type(x) <> 'OBJECT')) > 0 THEN 'bad_entities'
    END AS defect
  FROM typed
),
norm AS (
  SELECT doc_id, coalesce(json_extract_string(j, '$.text'), '') AS text,
    list_transform(items, lambda x: {{
      'mention': coalesce(json_extract_string(x, '$.mention'), ''),
      'type': coalesce(json_extract_string(x, '$.type'), ''),
      'assertion': coalesce(json_extract_string(x, '$.assertion'), ''),
      'context_window': coalesce(json_extract_string(x, '$.context_window'), '')
    }}) AS entities
  FROM judged WHERE defect IS NULL
)
"""


def struct_json(e: str) -> str:
    return (
        f"'{{\"mention\": ' || {js(e + '.mention')} || ', \"type\": ' || {js(e + '.type')} || "
        f"', \"assertion\": ' || {js(e + '.assertion')} || ', \"context_window\": ' || "
        f"{js(e + '.context_window')} || '}}'"
    )


NORM_TARGET = (
    "'{\"entities\": [' || array_to_string(list_transform(entities, lambda e: "
    + struct_json("e")
    + "), ', ') || ']}'"
)



def _raw(items: str) -> str:
    return f"""CASE kind
      WHEN '0' THEN substr('{{"items": [' || {items} || ']}}', 1, length({items}) - 7)
      WHEN '1' THEN '{{"items": [' || {items} || ']}} done'
      WHEN '2' THEN '[' || {items} || ']'
      WHEN '3' THEN '{{"items": 3}}'
      WHEN '4' THEN '{{"results": [' || {items} || ']}}'
      WHEN '5' THEN '{{"items": [' || {items} || ', {{"entities": []}}]}}'
      WHEN '7' THEN '{{"items": null}}'
      ELSE '{{"items": [' || {items} || ']}}' END"""


RESPONSES = f"""
{NOTES},
etext AS (
  SELECT doc_id, string_agg('{{"mention": ' || {js('mention')} || ', "type": ' || {js('type')} ||
      CASE damage WHEN '7' THEN '' ELSE ', "assertion": ' || {js('assertion')} END ||
      ', "context_window": ' || {js('context_window')} ||
      CASE damage WHEN '6' THEN ', "span": 1' ELSE '' END || '}}', ', ' ORDER BY i) AS list
  FROM ent GROUP BY doc_id
),
item AS (
  SELECT d.doc_id, CASE substr(md5('item:' || d.doc_id), 1, 1)
    WHEN '0' THEN '{{"text": ' || d.doc_id || ', "entities": [' || coalesce(list, '') || ']}}'
    WHEN '1' THEN '{{"text": ' || {js('d.text')} || ', "entities": "none"}}'
    WHEN '2' THEN {js('d.text')}
    WHEN '3' THEN '{{"text": ' || {js('d.text')} || '}}'
    WHEN '4' THEN '{{"note_id": 1, "text": ' || {js('d.text')} || ', "entities": [' ||
      coalesce(list, '') || ']}}'
    WHEN '5' THEN '{{"text": "first", "text": ' || {js('d.text')} || ', "entities": [' ||
      coalesce(list, '') || ']}}'
    WHEN '6' THEN '{{"text": NaN, "entities": [' || coalesce(list, '') || ']}}'
    ELSE '{{"text": ' || {js('d.text')} || ', "entities": [' || coalesce(list, '') || ']}}' END AS item,
    -- The same item as it is read: the last of repeated keys, any number for NaN.
    CASE substr(md5('item:' || d.doc_id), 1, 1)
    WHEN '5' THEN '{{"text": ' || {js('d.text')} || ', "entities": [' || coalesce(list, '') || ']}}'
    WHEN '6' THEN '{{"text": 0, "entities": [' || coalesce(list, '') || ']}}' END AS as_read
  FROM documents d LEFT JOIN etext USING (doc_id)
),
joined AS (
  SELECT doc_id // 10 AS resp_id, substr(md5('resp:' || (doc_id // 10)), 1, 1) AS kind,
    string_agg(item, ', ' ORDER BY doc_id) AS given,
    string_agg(coalesce(as_read, item), ', ' ORDER BY doc_id) AS read
  FROM item
  WHERE substr(md5('resp:' || (doc_id // 10)), 1, 1) <> '6' OR doc_id % 10 <> 9
  GROUP BY ALL
),
resp AS (
  SELECT resp_id, resp_id // 10 AS job_id, resp_id % 10 AS batch_id, 10::BIGINT AS expected,
    {_raw('given')} AS raw, {_raw('read')} AS read_raw
  FROM joined
),
rdoc AS (
  SELECT *, CASE WHEN json_valid(read_raw) THEN read_raw::JSON END AS j FROM resp
),
parsed AS (
  SELECT *, CASE
    WHEN j IS NULL THEN 'not_json'
    WHEN json_type(j) <> 'OBJECT' OR NOT list_contains(json_keys(j), 'items') THEN 'no_items'
    WHEN json_type(j, '$.items') <> 'ARRAY' THEN 'items_not_list'
    ELSE 'ok' END AS status
  FROM rdoc
),
ritem AS (
  SELECT resp_id, job_id, batch_id, unnest(range(len(list))) AS item_pos, unnest(list) AS it
  FROM (
    SELECT resp_id, job_id, batch_id, json_extract(j, '$.items[*]') AS list
    FROM parsed WHERE status = 'ok'
  )
),
ilist AS (
  SELECT *, CASE json_type(it, '$.entities') WHEN 'ARRAY' THEN json_extract(it, '$.entities[*]')
    ELSE [] END AS es
  FROM ritem
),
checked AS (
  SELECT *, CASE WHEN json_type(it) <> 'OBJECT' THEN 'item_not_object' ELSE
    array_to_string(list_filter([
      CASE WHEN coalesce(json_type(it, '$.text'), '') <> 'VARCHAR' THEN 'text_not_string' END,
      CASE WHEN json_type(it, '$.entities') <> 'ARRAY' THEN 'entities_not_list' END,
      CASE WHEN len(list_filter(es, lambda e: json_type(e) <> 'OBJECT')) > 0
        THEN 'entity_not_object' END,
      CASE WHEN len(list_filter(es, lambda e: coalesce(json_type(e, '$.mention'), '') <> 'VARCHAR')) > 0
        THEN 'mention_not_string' END,
      CASE WHEN len(list_filter(es, lambda e: coalesce(json_type(e, '$.type'), '') <> 'VARCHAR')) > 0
        THEN 'type_not_string' END,
      CASE WHEN len(list_filter(es, lambda e: coalesce(json_type(e, '$.assertion'), '') <> 'VARCHAR')) > 0
        THEN 'assertion_not_string' END,
      CASE WHEN len(list_filter(es, lambda e: coalesce(json_type(e, '$.context_window'), 'VARCHAR') <> 'VARCHAR')) > 0
        THEN 'context_window_not_string' END
    ], lambda x: x IS NOT NULL), ',') END AS errors
  FROM ilist
)
"""

VALID_LIST = (
    "array_to_string(list_transform(es, lambda e: "
    + "'{\"mention\": ' || to_json(json_extract_string(e, '$.mention'))::VARCHAR"
    + " || ', \"type\": ' || to_json(json_extract_string(e, '$.type'))::VARCHAR"
    + " || ', \"assertion\": ' || to_json(json_extract_string(e, '$.assertion'))::VARCHAR"
    + " || ', \"context_window\": ' || "
    + "to_json(coalesce(json_extract_string(e, '$.context_window'), ''))::VARCHAR || '}'), ', ')"
)

TRIPLES = """
triple AS (
  SELECT c.conv_id, row_number() OVER w - 1 AS turn, c.role, c.text AS input,
    coalesce(s.task, 'Answer the user.') AS task,
    CASE WHEN lead(c.role) OVER w = 'assistant' THEN lead(c.text) OVER w ELSE '' END AS output
  FROM conversations c LEFT JOIN (
    SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS task
    FROM conversations WHERE role = 'system' GROUP BY conv_id
  ) s USING (conv_id)
  WINDOW w AS (PARTITION BY c.conv_id ORDER BY c.turn)
  QUALIFY c.role = 'user'
)
"""

JOBS = """
job AS (
  SELECT c_custkey AS job_id, floor(c_acctbal / 25)::BIGINT AS total,
    (c_nationkey + 1)::BIGINT AS batch_size, c_custkey * 37 % 2950 AS tokens
  FROM customer
)
"""


def safe(count: str, tokens: str) -> str:
    return (
        f"(CASE WHEN ceil(({count}) * ({tokens}) * 1.2::DOUBLE) <= 16000 THEN ({count})::BIGINT "
        f"ELSE greatest(1, 16000 // greatest(1, trunc(({tokens}) * 1.2::DOUBLE)::BIGINT))::BIGINT END)"
    )


PLAN = f"""
{JOBS},
sized AS (
  SELECT *, {safe('batch_size', 'tokens')} AS step FROM job WHERE total > 0 AND batch_size > 0
),
slot AS (
  SELECT *, unnest(range((total + step - 1) // step)) AS batch_id FROM sized
),
wanted AS (
  SELECT job_id, batch_id, tokens, total - batch_id * step AS remaining_before,
    least(batch_size, total - batch_id * step) AS want
  FROM slot
),
plan AS (
  SELECT job_id, batch_id, tokens, want, {safe('want', 'tokens')} AS count, remaining_before
  FROM wanted
),
planned AS (
  SELECT *, count < want AS shrunk, least(20000, tokens * count * 2)::BIGINT AS max_output_tokens
  FROM plan
)
"""


# Chat formats -----------------------------------------------------------------

LLAMA_TURN = (
    "'<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) || text || '<|eot_id|>'"
)
CHATML_TURN = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"

LLAMA = f"""
llama AS (
  SELECT conv_id, '<|begin_of_text|>' || string_agg({LLAMA_TURN}, '' ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id
)
"""
GEMMA = """
sys AS (
  SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS sys
  FROM conversations WHERE role = 'system' GROUP BY conv_id
),
first_user AS (
  SELECT conv_id, min(turn) AS turn FROM conversations WHERE role = 'user' GROUP BY conv_id
),
folded AS (
  SELECT c.conv_id, c.turn, CASE c.role WHEN 'assistant' THEN 'model' ELSE c.role END AS role,
    CASE WHEN c.turn = f.turn AND s.sys IS NOT NULL
      THEN s.sys || chr(10) || chr(10) || c.text ELSE c.text END AS text
  FROM conversations c LEFT JOIN sys s USING (conv_id) LEFT JOIN first_user f USING (conv_id)
  WHERE c.role <> 'system'
),
gemma AS (
  SELECT conv_id, '<bos>' || string_agg(
    '<start_of_turn>' || role || chr(10) || text || '<end_of_turn>' || chr(10), '' ORDER BY turn
  ) AS text
  FROM folded GROUP BY conv_id
)
"""


def spans(source: str, instruction: str, response: str) -> str:
    return f"""
seg AS (
  SELECT conv_id, string_split(text, {instruction}) AS pieces FROM {source}
),
piece AS (
  SELECT conv_id, unnest(range(len(pieces))) AS i, unnest(pieces) AS p FROM seg
),
placed AS (
  SELECT conv_id, i, p, instr(p, {response}) AS hit,
    coalesce(sum(length(p) + length({instruction})) OVER (
      PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shift
  FROM piece
),
span AS (
  SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY i) - 1)::BIGINT AS seq,
    (shift + hit - 1 + length({response}))::BIGINT AS "start", (shift + length(p))::BIGINT AS "end",
    substr(p, hit + length({response})) AS text
  FROM placed WHERE hit > 0
)
"""


LLAMA_USER = "('<|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10))"
LLAMA_REPLY = "('<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10))"
GEMMA_USER = "('<start_of_turn>user' || chr(10))"
GEMMA_REPLY = "('<start_of_turn>model' || chr(10))"


# Samples and mixes ------------------------------------------------------------

MIX = """
base AS (SELECT doc_id, lang, text FROM documents WHERE lang = 'en'),
pool AS (SELECT doc_id, lang, text FROM documents WHERE lang <> 'en'),
chosen AS (
  SELECT doc_id, lang, text FROM (
    SELECT *, row_number() OVER (ORDER BY md5('2407::' || doc_id), doc_id) AS rn FROM pool
  ) WHERE rn <= (SELECT trunc(count(*) * (0.25::DOUBLE / 0.75::DOUBLE)) FROM base)
),
mixed AS (
  SELECT *, 'base' AS source FROM base UNION ALL SELECT *, 'pool' AS source FROM chosen
)
"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def counts(tables: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in tables)


# Sources and sinks
roundtrip = with_(TARGETS) + "SELECT text, target AS entities FROM target"
ORACLES["read_jsonl_roundtrip"] = roundtrip
ORACLES["read_clean_jsonl"] = roundtrip
ORACLES["named_splits"] = """
SELECT CASE WHEN lang = 'en' THEN 'train' ELSE 'eval' END AS split, count(*) AS n,
  sum(length(text))::BIGINT AS n_chars
FROM documents GROUP BY 1
"""
ORACLES["read_table_counts"] = counts(["documents", "conversations", "benchmark", "labels"])
ORACLES["multi_dataset_load"] = """
SELECT text, 'documents' AS source FROM documents
UNION ALL SELECT text, 'benchmark' AS source FROM benchmark
"""
SHARDS = """
numbered AS (
  SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS shard FROM documents
)
"""
ORACLES["shard_roundtrip"] = with_(SHARDS) + """
SELECT shard, count(*) AS n, min(doc_id) AS min_id, max(doc_id) AS max_id,
  sum(length(text))::BIGINT AS n_chars
FROM numbered GROUP BY shard
"""
ORACLES["shard_manifest"] = with_(SHARDS) + """
SELECT shard, count(*) AS n, min(doc_id) AS "first", max(doc_id) AS "last",
  printf('annotations.%04d.jsonl', shard) AS file_name
FROM numbered GROUP BY shard
"""

ORACLES["shard_append"] = """
WITH written AS (
  SELECT doc_id, text, CASE WHEN lang = 'en' THEN 1 WHEN lang IN ('de', 'fr') THEN 2 ELSE 3 END AS round
  FROM documents
),
placed AS (SELECT *, (row_number() OVER (ORDER BY round, doc_id) - 1) // 64 AS shard FROM written)
SELECT version, shard, count(*) AS n, min(doc_id) AS min_id, max(doc_id) AS max_id,
  sum(length(text))::BIGINT AS n_chars
FROM placed JOIN range(1, 4) v(version) ON round <= version
GROUP BY version, shard
"""

ORACLES["shard_rows"] = """
SELECT (row_number() OVER (ORDER BY source, doc_id) - 1) // 64 AS shard, doc_id, text FROM documents
"""

# Projection and normalization
ORACLES["normalize_text"] = with_(DIRTY) + "SELECT doc_id, text FROM norm"
ORACLES["normalize_entities_null"] = with_(DIRTY) + (
    "SELECT doc_id, len(entities)::BIGINT AS n_entities FROM norm"
)
ORACLES["normalize_entities_dict"] = with_(DIRTY) + (
    f"SELECT doc_id, {NORM_TARGET} AS entities FROM norm"
)
ORACLES["normalize_entity_fields"] = with_(DIRTY) + """
SELECT doc_id, seq, e.mention AS mention, e.type AS type, e.assertion AS assertion,
  e.context_window AS context_window
FROM (SELECT doc_id, unnest(range(len(entities))) AS seq, unnest(entities) AS e FROM norm)
"""
ORACLES["malformed_annotation_lines"] = with_(DIRTY) + (
    "SELECT doc_id, defect, line FROM judged WHERE defect IS NOT NULL"
)
ORACLES["project_text_only"] = "SELECT text FROM documents"
ORACLES["rename_text"] = "SELECT doc_id, text FROM documents"
ORACLES["strip_bos"] = with_(GEMMA) + (
    "SELECT conv_id, substr(text, 1 + length('<bos>')) AS text FROM gemma"
)
ORACLES["response_preview"] = "SELECT doc_id, substr(text, 1, 1000) AS preview FROM documents"
ORACLES["row_counts"] = counts(ALL_TABLES)


# Conversation builders
def three_turns(ids: str, turns: list[tuple[str, str]], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, {i}::BIGINT AS seq, '{role}' AS role, {content} AS content FROM {source}"
        for i, (role, content) in enumerate(turns)
    )


def annotated(user: str) -> list[tuple[str, str]]:
    return [
        ("system", lit(EXTRACTION_SYSTEM_PROMPT)),
        ("user", filled(user, note="text")),
        ("assistant", "target"),
    ]


ORACLES["annotation_messages"] = with_(TARGETS) + three_turns(
    "doc_id", annotated(EXTRACTION_USER_PROMPT), "target"
)
ORACLES["annotation_messages_note_tag"] = with_(TARGETS) + three_turns(
    "doc_id", annotated(EXTRACTION_NOTE_TAG_PROMPT), "target"
)
ORACLES["triple_messages"] = with_(TRIPLES) + three_turns(
    "conv_id, turn", [("system", "task"), ("user", "input"), ("assistant", "output")], "triple"
)
ORACLES["pair_messages"] = with_(TRIPLES) + three_turns(
    "conv_id, turn", [("user", "input"), ("assistant", "output")], "triple"
)
ORACLES["standardize_sharegpt"] = """
SELECT conv_id, (count(*) FILTER (WHERE role = 'system') OVER (PARTITION BY conv_id))::BIGINT
    AS n_unknown,
  (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::BIGINT AS seq,
  role, text AS content
FROM conversations
"""
ORACLES["assemble_conversations"] = f"""
SELECT conv_id, '[' || string_agg('{{"role": ' || {js('role')} || ', "content": ' || {js('text')} ||
  '}}', ', ' ORDER BY turn) || ']' AS conversations
FROM conversations GROUP BY conv_id
"""
ORACLES["assemble_conversation_parts"] = """
SELECT conv_id, turn // 2 AS part,
  (row_number() OVER (PARTITION BY conv_id, turn // 2 ORDER BY turn) - 1)::BIGINT AS seq,
  role, text AS content
FROM conversations
"""
ORACLES["prompt_messages"] = three_turns(
    "doc_id",
    [("system", lit(EXTRACTION_SYSTEM_PROMPT)), ("user", filled(EXTRACTION_USER_PROMPT, note="text"))],
    "documents",
)

# Rendering
ORACLES["render_llama"] = with_(LLAMA) + "SELECT * FROM llama"
ORACLES["render_gemma"] = with_(GEMMA) + "SELECT * FROM gemma"
ORACLES["render_chatml"] = f"""
SELECT conv_id, string_agg({CHATML_TURN}, '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id
"""
ORACLES["render_conversation_parts"] = with_(LLAMA, GEMMA) + """
SELECT conv_id, llama.text AS llama, gemma.text AS gemma FROM llama JOIN gemma USING (conv_id)
"""
ORACLES["render_generation_prompt"] = """
SELECT doc_id, '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) ||
  '<|im_start|>assistant' || chr(10) AS prompt
FROM documents
"""
ORACLES["render_open_conversations"] = with_(LLAMA) + f"""
SELECT conv_id, text || {LLAMA_REPLY} AS text FROM llama
WHERE conv_id IN (
  SELECT conv_id FROM conversations GROUP BY conv_id HAVING arg_max(role, turn) = 'user'
)
"""
ORACLES["fill_template"] = """
SELECT doc_id, 'Source ' || source || ' ({verbatim}):' || chr(10) || text || chr(10) || '-- ' || source
  AS prompt
FROM documents
"""
ORACLES["entities_json"] = with_(TARGETS) + "SELECT doc_id, target FROM target"
ORACLES["map_batches"] = "SELECT doc_id, replace(text, ' ', '_') AS text FROM documents"

# Response-only mask
ORACLES["response_spans"] = with_(LLAMA, spans("llama", LLAMA_USER, LLAMA_REPLY)) + (
    "SELECT * FROM span"
)
ORACLES["response_spans_gemma"] = with_(GEMMA, spans("gemma", GEMMA_USER, GEMMA_REPLY)) + (
    "SELECT * FROM span"
)
ORACLES["mask_stats"] = with_(LLAMA, spans("llama", LLAMA_USER, LLAMA_REPLY)) + """
SELECT l.conv_id, coalesce(s.n, 0)::BIGINT AS trained_chars, length(l.text)::BIGINT AS total_chars
FROM llama l LEFT JOIN (
  SELECT conv_id, sum("end" - "start") AS n FROM span GROUP BY conv_id
) s USING (conv_id)
"""

# Sampling, slicing, mixing, splitting
ORACLES["head_slice"] = "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100"
ORACLES["cap_per_source"] = """
SELECT source, doc_id, text FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 20
"""
ORACLES["sample_to_share"] = with_(MIX) + "SELECT doc_id, lang, text FROM chosen"
ORACLES["mix_concat"] = with_(MIX) + "SELECT * FROM mixed"
ORACLES["mix_whole_rows"] = """
SELECT *, CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' ELSE 'other' END AS part
FROM documents
"""
ORACLES["seeded_shuffle"] = with_(MIX) + """
SELECT *, row_number() OVER (
  ORDER BY md5('3407:' || source || ':' || doc_id), source, doc_id) - 1 AS pos
FROM mixed
"""
ORACLES["train_eval_split"] = """
SELECT doc_id, text, CASE
  WHEN row_number() OVER (ORDER BY md5('42::' || doc_id), doc_id)
    <= ceil((SELECT count(*) FROM documents) * 0.1::DOUBLE)
  THEN 'eval' ELSE 'train' END AS split
FROM documents
"""
ORACLES["train_eval_split_by_hash"] = """
SELECT doc_id, CASE
  WHEN ('0x' || substr(md5('42::' || doc_id), 1, 8))::UBIGINT / 4294967296.0::DOUBLE < 0.1::DOUBLE
  THEN 'eval' ELSE 'train' END AS split
FROM documents
"""
ORACLES["mix_report"] = with_(MIX) + """
SELECT source, count(*) AS n,
  round(count(*)::DOUBLE / (SELECT count(*) FROM mixed)::DOUBLE, 9) AS share
FROM mixed GROUP BY source
"""

# Length control
WORDS = "len(regexp_extract_all(text, '\\S+'))::BIGINT"


def stats(length: str) -> str:
    return f"""
SELECT lang, count(*) AS n, min(l) AS min_len, max(l) AS max_len, sum(l)::BIGINT AS sum_len,
  count(*) FILTER (WHERE l > 2048) AS n_over
FROM (SELECT lang, {length} AS l FROM documents) GROUP BY lang
"""


ORACLES["length_stats"] = stats(WORDS)
ORACLES["length_stats_chars4"] = stats("ceil(length(text) / 4.0)::BIGINT")
ORACLES["length_quantiles"] = f"""
SELECT lang, share, n, lens[greatest(ceil(share * n), 1)::INT] AS len
FROM (
  SELECT lang, count(*) AS n, list_sort(list({WORDS})) AS lens, unnest([0.5, 0.9, 0.99]::DOUBLE[]) AS share
  FROM documents GROUP BY lang
)
"""
ORACLES["length_sketch_ranks"] = """
SELECT lang, unnest([0.5, 0.9, 0.99]::DOUBLE[]) AS share, count(*) AS n, true AS within
FROM documents GROUP BY lang
"""
ORACLES["truncate_examples"] = f"""
SELECT doc_id, {WORDS} > 200 AS was_truncated,
  CASE WHEN {WORDS} > 200
    THEN array_to_string(regexp_extract_all(text, '\\s*\\S+')[1:200], '') ELSE text END AS text
FROM documents
"""
ORACLES["truncate_examples_chars4"] = """
SELECT doc_id, length(text) > 8192 AS was_truncated, substr(text, 1, 8192) AS text FROM documents
"""
ORACLES["pack_sequences"] = """
WITH sized AS (
  SELECT doc_id, ceil(length(text) / 4.0)::BIGINT AS n, md5('0::' || doc_id) AS k FROM documents
),
placed AS (
  SELECT *, ('0x' || substr(k, 1, 8))::UBIGINT::BIGINT
    % (SELECT greatest(1, ceil(sum(n) / 32768.0::DOUBLE))::BIGINT FROM sized) AS bucket
  FROM sized
)
SELECT doc_id, n, bucket, floor((sum(n) OVER (PARTITION BY bucket ORDER BY k, doc_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n) / 2048.0::DOUBLE)::BIGINT AS pack
FROM placed
"""



def packs(rows: str, group: str, key: str, budget: int) -> str:
    """CTEs that add ``pack`` to ``rows(n, bucket)`` one example after the other."""
    return f"""
lined AS (
  SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {key}) AS place FROM {rows}
),
walk AS (
  SELECT {group}, place, n AS fill, 0::BIGINT AS pack FROM lined WHERE place = 1
  UNION ALL
  SELECT {', '.join('l.' + c.strip() for c in group.split(','))}, l.place,
    CASE WHEN w.fill + l.n <= {budget} THEN w.fill + l.n ELSE l.n END,
    CASE WHEN w.fill + l.n <= {budget} THEN w.pack ELSE w.pack + 1 END
  FROM walk w JOIN lined l ON l.place = w.place + 1
    AND {' AND '.join(f'l.{c.strip()} = w.{c.strip()}' for c in group.split(','))}
)"""


def bucket_of(k: str, n: str, room: int, over: str = "") -> str:
    """The bucket of a hash key, of as many as the total length asks for."""
    return (
        f"('0x' || substr({k}, 1, 8))::UBIGINT::BIGINT"
        f" % greatest(1, ceil(sum(greatest({n}, 1)) OVER ({over}) / {room}.0::DOUBLE))::BIGINT"
    )


ORACLES["pack_within_budget"] = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, ceil(length(text) / 4.0)::BIGINT AS n, md5('0::' || doc_id) AS k FROM documents
),
placed AS (SELECT *, {bucket_of('k', 'n', 32768)} AS bucket FROM sized),
{packs('placed', 'bucket', 'k, doc_id', 2048)}
SELECT doc_id, n, bucket, pack FROM lined JOIN walk USING (bucket, place)
"""

ORACLES["configured_rows"] = with_(TRIPLES).replace("WITH", "WITH RECURSIVE", 1) + f"""
, listed AS (
  SELECT CASE WHEN length(input) < 200 THEN 'brief' ELSE 'detailed' END AS dataset,
    printf('%08d.%06d', conv_id, turn) AS id,
    '<start_of_turn>user' || chr(10) || task || chr(10) || chr(10) || input || '<end_of_turn>' ||
    chr(10) || '<start_of_turn>model' || chr(10) || output || '<end_of_turn>' || chr(10) AS whole
  FROM triple QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY id) <= 400
),
cut AS (
  SELECT dataset, id, md5('42::' || dataset || '/' || id) AS k, dataset || '/' || id AS name,
    len(regexp_extract_all(whole, '\\S+')) > 96 AS was_truncated,
    CASE WHEN was_truncated THEN array_to_string(regexp_extract_all(whole, '\\s*\\S+')[1:96], '') ELSE whole END AS text
  FROM listed
),
halves AS (
  SELECT *, len(regexp_extract_all(text, '\\S+'))::BIGINT AS n, CASE
    WHEN row_number() OVER (ORDER BY k, name) <= ceil(count(*) OVER () * 0.1::DOUBLE)
    THEN 'eval' ELSE 'train' END AS split
  FROM cut
),
placed AS (SELECT *, {bucket_of('k', 'n', 96 * 64, 'PARTITION BY split')} AS bucket FROM halves),
{packs('placed', 'split, bucket', 'k, name', 96)}
SELECT dataset, id, split, text, was_truncated, n AS n_tokens, bucket, pack
FROM lined JOIN walk USING (split, bucket, place)
"""

# Generation requests
ORACLES["safe_batch"] = f"""
SELECT part, count, tokens, batch, least(20000, tokens * batch * 2)::BIGINT AS max_output_tokens
FROM (
  SELECT part, count, tokens, {safe('count', 'tokens')} AS batch
  FROM (SELECT p_partkey AS part, p_size::BIGINT AS count, p_partkey % 3000 AS tokens FROM part)
)
"""
ORACLES["plan_requests"] = with_(PLAN) + "SELECT * FROM planned"
SYSTEM = filled(GENERATION_SYSTEM_PROMPT, target_tokens="tokens")
USER = filled(GENERATION_USER_PROMPT, count="count", unit_schema=lit(GENERATION_UNIT_SCHEMA))
ORACLES["render_requests"] = with_(PLAN) + f"""
SELECT job_id, batch_id, {SYSTEM} AS system,
  {USER} || chr(10) || 'SEED: ' || (11 + batch_id)::VARCHAR AS "user"
FROM planned
"""
ORACLES["request_payload"] = with_(PLAN) + f"""
SELECT job_id, batch_id,
  '{{"model":"small-model","input":[{{"role":"assistant","content":' || {js(SYSTEM)} ||
  '}},{{"role":"user","content":' || {js(USER)} || '}}],"max_output_tokens":' || max_output_tokens ||
  ',"reasoning":{{"effort":"low"}}}}' AS payload
FROM planned
"""

# Responses
R = with_(RESPONSES)
ORACLES["parse_status"] = R + "SELECT resp_id, json_valid(read_raw) AS is_json FROM resp"
ORACLES["contract_status"] = R + "SELECT resp_id, status FROM parsed"
ORACLES["item_count_mismatch"] = R + """
SELECT resp_id, expected, n_items, coalesce(n_items <> expected, false) AS count_mismatch
FROM (
  SELECT resp_id, expected,
    CASE WHEN status = 'ok' THEN json_array_length(j, '$.items')::BIGINT END AS n_items
  FROM parsed
)
"""
ORACLES["explode_items"] = R + """
SELECT resp_id, item_pos,
  CASE WHEN json_type(it) = 'OBJECT' THEN json_extract_string(it, '$.text') END AS text,
  CASE WHEN json_type(it, '$.entities') = 'ARRAY'
    THEN json_array_length(it, '$.entities')::BIGINT END AS n_entities
FROM ritem
"""
ORACLES["validate_annotations"] = R + f"""
SELECT resp_id, item_pos, errors = '' AS valid, errors,
  CASE WHEN errors = '' THEN json_extract_string(it, '$.text') END AS text,
  CASE WHEN errors = '' THEN '{{"entities": [' || {VALID_LIST} || ']}}' END AS entities
FROM checked
"""
ORACLES["accepted_annotation_rows"] = R + f"""
SELECT resp_id, item_pos, '{{"text": ' || to_json(json_extract_string(it, '$.text'))::VARCHAR ||
  ', "entities": [' || {VALID_LIST} || ']}}' AS line
FROM checked WHERE errors = ''
"""
ORACLES["rejected_item_rows"] = R + (
    "SELECT resp_id, item_pos, errors FROM checked WHERE errors <> ''"
)
USABLE = """
, good AS (
  SELECT resp_id, count(*) FILTER (WHERE errors = '') AS accepted FROM checked GROUP BY resp_id
),
usable AS (
  SELECT job_id, batch_id,
    CASE WHEN resp_id % 4 = 0 THEN 0 ELSE coalesce(accepted, 0) END::BIGINT AS accepted
  FROM parsed LEFT JOIN good USING (resp_id) WHERE resp_id % 4 = 0 OR status = 'ok'
)
"""
ORACLES["generation_progress"] = R + USABLE + """
, running AS (
  SELECT *, 100::BIGINT AS total, (sum(accepted) OVER (PARTITION BY job_id ORDER BY batch_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS accepted_so_far
  FROM usable
)
SELECT *, total - accepted_so_far AS remaining FROM running
"""
ORACLES["generation_followups"] = R + USABLE + """
, per_job AS (
  SELECT doc_id // 100 AS job_id, count(*) AS total FROM documents GROUP BY 1
),
asked AS (
  SELECT job_id, total, batch_id, least(10, total - batch_id * 10) AS count
  FROM (SELECT *, unnest(range((total + 9) // 10)) AS batch_id FROM per_job)
),
state AS (
  SELECT job_id, max(batch_id) + 1 AS next, (any_value(total) - sum(coalesce(accepted, count)))::BIGINT AS missing
  FROM asked LEFT JOIN usable USING (job_id, batch_id) GROUP BY job_id
),
slots AS (
  SELECT *, unnest(range((missing + 9) // 10)) AS i FROM state WHERE missing > 0
)
SELECT job_id, next + i AS batch_id, 200::BIGINT AS tokens, least(10, missing - 10 * i) AS want,
  least(10, missing - 10 * i) AS count, missing - 10 * i AS remaining_before, false AS shrunk,
  400 * least(10, missing - 10 * i) AS max_output_tokens
FROM slots
"""
ORACLES["generation_round"] = R + USABLE + f"""
, per_job AS (
  SELECT doc_id // 100 AS job_id, count(*) AS total FROM documents GROUP BY 1
),
asked AS (
  SELECT job_id, total, batch_id, least(10, total - batch_id * 10) AS count
  FROM (SELECT *, unnest(range((total + 9) // 10)) AS batch_id FROM per_job)
),
state AS (
  SELECT job_id, max(batch_id) + 1 AS next, (any_value(total) - sum(coalesce(accepted, count)))::BIGINT AS missing
  FROM asked LEFT JOIN usable USING (job_id, batch_id) GROUP BY job_id
),
sent AS (
  SELECT 'retry' AS kind, job_id, batch_id, count, total - batch_id * 10 AS remaining_before
  FROM asked ANTI JOIN usable USING (job_id, batch_id)
  UNION ALL
  SELECT 'followup', job_id, next + i, least(10, missing - 10 * i), missing - 10 * i
  FROM (SELECT *, unnest(range((missing + 9) // 10)) AS i FROM state WHERE missing > 0)
),
asking AS (
  SELECT *, 200 AS tokens, {USER} || chr(10) || 'SEED: ' || (11 + batch_id)::VARCHAR AS "user" FROM sent
)
SELECT kind, job_id, batch_id, count::BIGINT AS count, remaining_before::BIGINT AS remaining_before, "user",
  '{{"model":"small-model","input":[{{"role":"assistant","content":' || {js(SYSTEM)} ||
  '}},{{"role":"user","content":' || {js('"user"')} || '}}],"max_output_tokens":' || 400 * count ||
  ',"reasoning":{{"effort":"low"}}}}' AS payload
FROM asking
"""
ORACLES["pending_requests"] = R + """
, per_job AS (
  SELECT doc_id // 100 AS job_id, count(*) AS total FROM documents GROUP BY 1
),
slots AS (
  SELECT job_id, total, unnest(range((total + 9) // 10)) AS batch_id FROM per_job
)
SELECT job_id, batch_id, least(10, total - batch_id * 10)::BIGINT AS want,
  least(10, total - batch_id * 10)::BIGINT AS count
FROM slots s
WHERE NOT EXISTS (
  SELECT 1 FROM parsed p
  WHERE p.status = 'ok' AND p.job_id = s.job_id AND p.batch_id = s.batch_id
)
"""
ORACLES["quarantine"] = R + """
SELECT resp_id, status AS reason, length(raw)::BIGINT AS raw_chars, substr(raw, 1, 1000) AS raw_preview
FROM parsed WHERE status <> 'ok'
"""


# Quality rules
def per_note(**counts: str) -> str:
    cols = ", ".join(f"count(*) FILTER (WHERE {test}) AS {name}" for name, test in counts.items())
    outer = ", ".join(f"coalesce({name}, 0)::BIGINT AS {name}" for name in counts)
    return with_(NOTES) + f"""
SELECT d.doc_id, d.source, coalesce(n_entities, 0)::BIGINT AS n_entities, {outer}
FROM documents d LEFT JOIN (
  SELECT e.doc_id, count(*) AS n_entities, {cols}
  FROM (
    SELECT doc_id,
      CASE gap WHEN '0' THEN NULL WHEN '1' THEN '' ELSE mention END AS mention,
      CASE gap WHEN '2' THEN NULL WHEN '3' THEN '' ELSE type END AS type,
      CASE gap WHEN '4' THEN NULL WHEN '5' THEN '' ELSE assertion END AS assertion,
      CASE gap WHEN '6' THEN NULL WHEN '3' THEN '' ELSE context_window END AS context_window
    FROM ent
  ) e JOIN documents n USING (doc_id) GROUP BY e.doc_id
) c USING (doc_id)
"""


EMPTY = "coalesce({0}, '') = ''"
ORACLES["check_enums"] = per_note(
    n_bad_type="coalesce(type, '') NOT IN ('Symptom', 'Diagnosis', 'Treatment')",
    n_bad_assertion="coalesce(assertion, '') NOT IN ('Positive', 'Negated', 'Possible')",
    n_missing=EMPTY.format("type") + " OR " + EMPTY.format("assertion"),
)
ORACLES["check_grounding"] = per_note(
    n_ungrounded=EMPTY.format("mention") + " OR NOT contains(n.text, mention)",
    n_ungrounded_nocase=EMPTY.format("mention") + " OR NOT contains(lower(n.text), lower(mention))",
    n_missing=EMPTY.format("mention"),
)
ORACLES["check_context_copied"] = per_note(
    n_not_copied=EMPTY.format("context_window") + " OR NOT contains(n.text, context_window)",
    n_not_copied_nocase=EMPTY.format("context_window")
    + " OR NOT contains(lower(n.text), lower(context_window))",
    n_missing=EMPTY.format("context_window"),
)
ORACLES["check_context_shape"] = per_note(
    n_bad_size="context_window IS NULL OR "
    "len(regexp_extract_all(context_window, '\\S+')) NOT BETWEEN 5 AND 12",
    n_without_mention="context_window IS NULL OR " + EMPTY.format("mention")
    + " OR NOT contains(lower(context_window), lower(mention))",
)
ORACLES["check_note_length"] = f"""
SELECT doc_id, {WORDS} AS n_words, {WORDS} * 100 BETWEEN 16000 AND 24000 AS in_range FROM documents
"""
ORACLES["check_extra_keys"] = R + """
, ikeys AS (
  SELECT resp_id, item_pos,
    list_filter(CASE json_type(it) WHEN 'OBJECT' THEN json_keys(it) ELSE [] END,
      lambda k: k NOT IN ('text', 'entities')) AS ks, es
  FROM ilist
),
ekeys AS (
  SELECT resp_id, ks, list_transform(es, lambda e: list_filter(json_keys(e),
    lambda k: k NOT IN ('mention', 'type', 'assertion', 'context_window'))) AS eks
  FROM ikeys
),
tall AS (
  SELECT resp_id, sum((len(ks) > 0)::INT)::BIGINT AS n_items_extra,
    sum(len(list_filter(eks, lambda x: len(x) > 0)))::BIGINT AS n_entities_extra,
    list_sort(list_distinct(flatten(list(list_concat(ks, flatten(eks)))))) AS names
  FROM ekeys GROUP BY resp_id
)
SELECT p.resp_id, coalesce(n_items_extra, 0)::BIGINT AS n_items_extra,
  coalesce(n_entities_extra, 0)::BIGINT AS n_entities_extra,
  coalesce(array_to_string(names, ','), '') AS extra_keys
FROM parsed p LEFT JOIN tall USING (resp_id) WHERE p.status = 'ok'
"""
ORACLES["label_balance"] = with_(NOTES) + """
SELECT type, assertion, count(*) AS n, GROUPING(type, assertion)::BIGINT AS level,
  round(count(*)::DOUBLE / (SELECT count(*) FROM ent)::DOUBLE, 9) AS share
FROM ent GROUP BY ROLLUP (type, assertion)
"""
ORACLES["batch_label_coverage"] = with_(NOTES) + """
SELECT doc_id // 10 AS batch_id, count(DISTINCT doc_id) AS n_notes,
  coalesce(bool_or(assertion = 'Negated'), false) AS has_negated,
  coalesce(bool_or(assertion = 'Possible'), false) AS has_possible
FROM documents LEFT JOIN ent USING (doc_id) GROUP BY 1
"""

# Whole runs
def annotation_text(user: str) -> str:
    return f"""'<|begin_of_text|><|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) ||
  {lit(EXTRACTION_SYSTEM_PROMPT.strip())} || '<|eot_id|>' || {LLAMA_USER} ||
  trim({filled(user, note="text")}, ' ' || chr(10)) || '<|eot_id|>' ||
  {LLAMA_REPLY} || {NORM_TARGET} || '<|eot_id|>'"""


ORACLES["annotation_training_rows"] = with_(DIRTY) + f"""
SELECT doc_id, {annotation_text(EXTRACTION_USER_PROMPT)} AS text FROM norm
"""
ORACLES["archived_training_rows"] = with_(DIRTY) + f"""
SELECT CASE WHEN doc_id % 10 = 0 THEN 'eval' ELSE 'train' END AS split, doc_id,
  {annotation_text(EXTRACTION_NOTE_TAG_PROMPT)} AS text
FROM norm
"""
ORACLES["instruction_training_rows"] = with_(TRIPLES) + """
SELECT conv_id, turn, '<start_of_turn>user' || chr(10) || task || chr(10) || chr(10) || input ||
  '<end_of_turn>' || chr(10) || '<start_of_turn>model' || chr(10) || output || '<end_of_turn>' ||
  chr(10) AS text
FROM triple
"""
ORACLES["reasoning_chat_rows"] = with_(TRIPLES) + f"""
, chat AS (
  SELECT conv_id::VARCHAR AS id, string_agg({CHATML_TURN}, '' ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id
),
picked AS (
  SELECT * FROM chat
  QUALIFY row_number() OVER (ORDER BY md5('2407::' || id), id)
    <= (SELECT trunc(count(*) * (0.25::DOUBLE / 0.75::DOUBLE)) FROM triple)
),
both_parts AS (
  SELECT conv_id || '.' || turn AS id, 'reasoning' AS source, '<|im_start|>user' || chr(10) || input ||
    '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || output || '<|im_end|>' || chr(10) AS text
  FROM triple
  UNION ALL SELECT id, 'chat' AS source, text FROM picked
)
SELECT id, source, text, row_number() OVER (
  ORDER BY md5('3407:' || source || ':' || id), source, id) - 1 AS pos
FROM both_parts
"""
