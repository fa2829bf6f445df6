"""Prompts have to stay byte for byte what existing data was made with."""

import hashlib

import pytest

from chatloom import fixed_values

HASHES = {
    "EXTRACTION_NOTE_TAG_PROMPT": "72b324aae21da6579388a3c813aaec49",
    "EXTRACTION_SYSTEM_PROMPT": "88032c765b12774aedeecfa2aebd2f80",
    "EXTRACTION_USER_PROMPT": "8ac18ff8cc8b735622f2c1633344e173",
    "GENERATION_SYSTEM_PROMPT": "6534a94f04a32749c1170991f628d0c6",
    "GENERATION_UNIT_SCHEMA": "a93a7f96c2a54f20c29a3f638655ddbc",
    "GENERATION_USER_PROMPT": "a41ddc5da5ebe55c6cec1a25e196d853",
}


@pytest.mark.parametrize("name", HASHES)
def test_prompt(name):
    text = getattr(fixed_values, name)
    assert hashlib.sha256(text.encode()).hexdigest()[:32] == HASHES[name]
