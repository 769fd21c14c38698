"""Record schema (taxonomy) handling.

The schema is declared by example: a program object whose keys are the
section names; nested objects are required objects.  A small sample schema
serves tests and the query registry (no schema file ships with the inputs).
"""

from __future__ import annotations

import json

SAMPLE_PROGRAM = {
    "title": "",
    "lang": "",
    "tags": [],
    "stats": {"anchors": 0, "words": 0},
    "admissions": {"deadline": "", "requirements": {"gpa": ""}},
    "contact": {"email": ""},
}

SAMPLE_TAXONOMY = {"institutions": [{"institution_name": "", "programs": [SAMPLE_PROGRAM]}]}


def program_json(program: dict | None = None) -> str:
    return json.dumps(SAMPLE_PROGRAM if program is None else program)


def top_keys(program: dict | None = None) -> list[str]:
    return list((SAMPLE_PROGRAM if program is None else program).keys())
