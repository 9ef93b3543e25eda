"""Turn plain-text corpora into typed, nested, sentence-level datasets on Spark."""

from glossmill.operators.annotate import annotate, annotate_with
from glossmill.operators.blocks import group_blocks
from glossmill.operators.distribute import distribute
from glossmill.operators.lexicon import build_lexicon
from glossmill.operators.nested import flatten_sentences, flatten_tokens, nest_children
from glossmill.operators.parse import parse_blocks
from glossmill.operators.typed import enforce_schema, fill_missing, schema_violations
from glossmill.plans.ingest import ingest
from glossmill.schemas import RECORD_SCHEMA, SENTENCE_SCHEMA, STORED_SCHEMA
from glossmill.session import get_session
from glossmill.sources.records import read_records, write_records
from glossmill.sources.text import scan_lines

__all__ = [
    "RECORD_SCHEMA",
    "SENTENCE_SCHEMA",
    "STORED_SCHEMA",
    "annotate",
    "annotate_with",
    "build_lexicon",
    "distribute",
    "enforce_schema",
    "fill_missing",
    "flatten_sentences",
    "flatten_tokens",
    "get_session",
    "group_blocks",
    "ingest",
    "nest_children",
    "parse_blocks",
    "read_records",
    "scan_lines",
    "schema_violations",
    "write_records",
]
