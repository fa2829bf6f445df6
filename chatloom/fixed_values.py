"""Fixed values.

These texts, label sets and limits have to equal the ones existing data and
existing prompts were made with, so they are stated plainly and in one place.
"""

ENTITY_TYPES = ("Symptom", "Diagnosis", "Treatment")
ASSERTIONS = ("Positive", "Negated", "Possible")

# Extraction prompts (training and inference).
EXTRACTION_SYSTEM_PROMPT = """
You are an information extraction model for fictional, de-identified clinical notes.
Extract ONLY strict JSON conforming to this schema:

{
  "entities": [
    { 
      "mention": string, 
      "type":"Symptom|Diagnosis|Treatment", 
      "assertion":"Positive|Negated|Possible", 
      "context_window": string
    }
  ]
}

Rules:
 - Output JSON only, no extra keys or explanations.
 - Maintain medical plausibility; all content is fictional.
"""

EXTRACTION_USER_PROMPT = """
Extract entities with assertion from this note:

{note}
"""

EXTRACTION_NOTE_TAG_PROMPT = (
    "Extract entities with assertion from this note:\n\n<NOTE>\n{note}\n</NOTE>"
)

# Generation prompts.
GENERATION_SYSTEM_PROMPT = """\
You are a data generator for de-identified, fictional electronic health records.
TASK: Create realistic yet entirely fictional clinical notes and extract entities.
ENTITY TYPES: Symptom, Diagnosis, Treatment.
ASSERTION: Positive (present), Negated (explicitly absent), Possible (suspected/likely/RO).
RULES:
 - Notes must be medically plausible and fully fictional (no real PHI).
 - Aim ~{target_tokens} tokens per note (±20%). Use typical sections like HPI/ROS/Assessment/Plan where natural.
 - For each entity, provide a short context_window (5–12 words around the mention) copied from the note.
 - Balance assertion labels across the dataset over time; each batch should include some Negated/Possible.
OUTPUT: Return ONLY strict JSON that conforms to the provided json_schema, with an array field `items`.
"""

GENERATION_UNIT_SCHEMA = """\
{
  "text": "string",
  "entities": [
    {"mention":"string","type":"Symptom|Diagnosis|Treatment","assertion":"Positive|Negated|Possible","context_window":"string"}
  ]
}"""

GENERATION_USER_PROMPT = """\
Generate {count} clinical annotations. Each annotation must follow this JSON unit schema:
{unit_schema}
IMPORTANT:
 - Do NOT include spans or any extra keys.
 - Use natural clinical language; include common abbreviations where appropriate (e.g., SOB, CP) but keep them clear in context.
 - Vary conditions and treatments (e.g., infections, cardiology, neurology, endocrine; meds/procedures/therapies).
Return JSON with top-level key `items` (array of {count} objects)."""

# Limits.
BATCH_TOKEN_CAP = 16000
OUTPUT_TOKEN_LIMIT = 20000
TOKEN_MARGIN = 1.2
SHARD_ROWS = 1000
SHARD_NAME = "annotations.%04d.jsonl"
SEQUENCE_LIMIT = 2048
PREVIEW_CHARS = 1000
CONTEXT_WORDS = (5, 12)
NOTE_LENGTH_TOLERANCE_PERCENT = 20
ROWS_PER_SOURCE = 1000
