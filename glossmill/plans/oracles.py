"""The queries of `glossmill.plans.queries` as SQL over the same tables."""

from __future__ import annotations

from collections.abc import Sequence

# Fixed values, stated here as well so that the SQL does not depend on the engine: the characters
# that a Unicode-aware strip removes, and Penn Treebank tags of single-character tokens.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
PUNCTUATION_TAGS = {
    ".": ".?!",
    ",": ",",
    ":": ":;…–—",
    "HYPH": "-",
    "-LRB-": "([{",
    "-RRB-": ")]}",
    "``": "“‘«",
    "''": "\"'”’»",
    "$": "$€£¥",
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _lines(column: str) -> str:
    stripped = (
        f"list_transform(regexp_split_to_array({column}, '\\r\\n|\\r|\\n'), "
        f"lambda x: trim(x, {_quoted(WHITESPACE)}))"
    )
    return f"list_filter({stripped}, lambda x: x <> '')"


# The token rule, written out for a matcher without possessive repeats.
_RULE = _quoted(
    r"[\p{L}\p{M}]+(?:['’][\p{L}]+)*|\p{N}+(?:[.,]\p{N}+)*"
    "|[^\\s\x0b\x1c-\x1f\x85\\p{Z}\\p{L}\\p{M}\\p{N}]"
)

_DOCS = f"""docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, [lang, source] AS tags, {_lines('text')} AS texts
  FROM documents)"""
_SENTS = """sents AS (
  SELECT id, CAST(generate_subscripts(texts, 1) - 1 AS BIGINT) AS sent_pos, unnest(texts) AS text
  FROM docs)"""


def _tokens_of(source: str, keys: str) -> str:
    return f"""
  SELECT {keys}, sent_pos, CAST(generate_subscripts(ts, 1) - 1 AS BIGINT) AS tok_pos, unnest(ts) AS token
  FROM (SELECT {keys}, sent_pos, regexp_extract_all(text, {_RULE}) AS ts FROM {source})"""


_TOKS = f"toks AS ({_tokens_of('sents', 'id')})"

_POS1 = r"""CASE WHEN regexp_matches(token, '^[\p{L}\p{M}]') THEN 'X'
    WHEN regexp_matches(token, '^\p{N}') THEN 'NUM'
    WHEN regexp_matches(token, '^\p{P}') THEN 'PUNCT'
    WHEN regexp_matches(token, '^\p{S}') THEN 'SYM' ELSE 'X' END"""
_POS2 = (
    r"CASE WHEN regexp_matches(token, '^[\p{L}\p{M}]') THEN 'XX' WHEN regexp_matches(token, '^\p{N}') THEN 'CD' "
    + " ".join(
        f"WHEN token IN ({', '.join(_quoted(c) for c in characters)}) THEN {_quoted(name)}"
        for name, characters in PUNCTUATION_TAGS.items()
    )
    + r" WHEN regexp_matches(token, '^[\p{P}\p{S}]') THEN 'SYM' ELSE 'XX' END"
)

# The plug-in annotator over conversations, and the lexicon counted from it.
_PROPER = r"tok_pos > 0 AND regexp_matches(token, '^\p{Lu}')"
_PLUGGED = f"""plugged AS (
  SELECT *, lower(token) AS lemma, CASE WHEN {_PROPER} THEN 'NNP' ELSE 'XX' END AS pos2,
    CASE WHEN tok_pos = 0 THEN 'ROOT' ELSE 'dep' END AS dep FROM toks)"""
_TURNS = f"""turns AS (
  SELECT conv_id, turn, CAST(generate_subscripts(ls, 1) - 1 AS BIGINT) AS sent_pos, unnest(ls) AS text
  FROM (SELECT conv_id, turn, {_lines('text')} AS ls FROM conversations)),
turn_toks AS (
  SELECT *, CASE WHEN {_PROPER} THEN token ELSE lower(token) END AS lemma,
    CASE WHEN {_PROPER} THEN 'PROPN' ELSE 'X' END AS pos1,
    CASE WHEN {_PROPER} THEN 'NNP' ELSE 'XX' END AS pos2,
    CASE WHEN tok_pos = 0 THEN 'ROOT' ELSE 'dep' END AS dep
  FROM ({_tokens_of('turns', 'conv_id, turn')}))"""
_LEXICON = f"""{_TURNS},
readings AS (
  SELECT lower(token) AS form, lemma, pos1, pos2, count(*) AS n FROM turn_toks GROUP BY ALL),
lexicon AS (
  SELECT form, lemma, pos1, pos2, n FROM readings
  QUALIFY row_number() OVER (PARTITION BY form ORDER BY n DESC, lemma, pos1, pos2) = 1)"""
_TAGGED = f"""tagged AS (
  SELECT id, sent_pos, tok_pos, token, coalesce(lemma, lower(token)) AS lemma,
    coalesce(pos1, {_POS1}) AS pos1, coalesce(pos2, {_POS2}) AS pos2
  FROM toks LEFT JOIN lexicon ON lower(token) = form)"""
_SHAPED = f"""shaped AS (
  SELECT *, lower(token) AS lemma, {_POS1} AS pos1, {_POS2} AS pos2 FROM toks)"""


def _annotation(tokens: str, sentences: str, keys: str, dep: str) -> str:
    arrays = ("token", "lemma", "pos1", "pos2")
    counts = ", ".join(f"count({a}) AS n_{a}" for a in arrays)
    joined = ", ".join(f"string_agg({a}, chr(1) ORDER BY tok_pos) AS {a}" for a in arrays)
    return f"""SELECT {keys}, sent_pos, text, {counts}, {joined}, {dep} AS dep
FROM {tokens} JOIN {sentences} USING ({keys}, sent_pos) GROUP BY {keys}, sent_pos, text"""


def _records(tokens: str, arrays: Sequence[tuple[str, str]] = ()) -> str:
    """Records of all documents, with arrays given as (result column, token column)."""
    extra = "".join(f", {name}" for name, _ in arrays)
    joined = "".join(
        f", string_agg({source}, chr(1) ORDER BY sent_pos, tok_pos) AS {name}"
        for name, source in [("tokens", "token"), *arrays]
    )
    return f"""SELECT id, array_to_string(tags, chr(1)) AS tags, CAST(len(texts) AS BIGINT) AS n_sentences,
  coalesce(n_tokens, 0) AS n_tokens, array_to_string(texts, chr(1)) AS texts, coalesce(tokens, '') AS tokens {extra}
FROM docs LEFT JOIN (
  SELECT id, count(*) AS n_tokens{joined} FROM {tokens} GROUP BY id) USING (id)"""


_BASE = f"WITH {_DOCS}, {_SENTS}, {_TOKS}"
_ROUND_TRIP = f"{_BASE}, {_SHAPED} {_records('shaped')}"
_RAGGED_STATUS = "CASE WHEN len(texts) > 1 THEN 'ok' ELSE 'missing_tags' END"

ORACLES: dict[str, str] = {
    "scan_lines": f"""WITH {_DOCS}
SELECT line, true AS valid, count(*) AS n FROM (
  SELECT unnest([id, array_to_string(tags, ' '), ''] || texts) AS line FROM docs) GROUP BY line""",
    "line_numbers": f"""WITH {_DOCS}, rows AS (
  SELECT tags[2] AS source, CAST(id AS BIGINT) AS doc_id,
    unnest([id, array_to_string(tags, ' ')] || texts || ['']) AS line,
    generate_subscripts([id, array_to_string(tags, ' ')] || texts || [''], 1) AS pos FROM docs)
SELECT source, doc_id // 1000 AS bucket,
  row_number() OVER (PARTITION BY source, doc_id // 1000 ORDER BY doc_id, pos) AS number, line FROM rows""",
    "scoped_settings": "SELECT lang, count(*) AS n, true AS held, true AS restored FROM documents GROUP BY lang",
    "split_lines": f"WITH {_DOCS}, {_SENTS} SELECT id, sent_pos AS pos, text FROM sents",
    "distribute": "SELECT o_orderkey, o_orderpriority FROM orders",
    "group_blocks": f"""WITH {_DOCS}, blocks AS (
  SELECT id, [id, array_to_string(tags, ' ')] || texts AS lines FROM docs)
SELECT id, CAST(len(lines) AS BIGINT) AS n_lines, array_to_string(lines, chr(1)) AS block FROM blocks""",
    "group_blocks_parts": f"""WITH {_DOCS}, blocks AS (
  SELECT id, [id, array_to_string(tags, ' ')] || texts AS lines FROM docs)
SELECT id, list_sum(list_transform(lines, lambda x: strlen(x) + 48)) <= 600 AS whole,
  CAST(len(lines) AS BIGINT) AS n_lines, array_to_string(lines, chr(1)) AS block FROM blocks""",
    "group_blocks_edges": f"""WITH {_DOCS}
SELECT id, array_to_string(tags, chr(1)) AS tags, array_to_string(texts, chr(1)) AS texts,
  CASE WHEN tags[2] = 'src0' THEN 'invalid_utf8' ELSE 'ok' END AS status,
  CASE WHEN tags[2] = 'src0' THEN hex(id) || 'FFC328' ELSE '' END AS raw FROM docs""",
    "parse_blocks": f"""WITH {_DOCS}
SELECT id, CAST(len(tags) AS BIGINT) AS n_tags, CAST(len(texts) AS BIGINT) AS n_sentences,
  texts[1] AS first_sentence, CAST(NULL AS VARCHAR) AS reason FROM docs""",
    "quarantine": f"""WITH {_DOCS}
SELECT id, CAST(CASE WHEN len(texts) > 1 THEN len(texts) + 2 ELSE 1 END AS BIGINT) AS n_lines,
  {_RAGGED_STATUS} AS status FROM docs""",
    "split_tags": f"""WITH {_DOCS}
SELECT id, CAST(generate_subscripts(tags, 1) - 1 AS BIGINT) AS pos, unnest(tags) AS tag FROM docs""",
    "tokens": f"{_BASE} SELECT id, sent_pos, tok_pos, token FROM toks",
    "build_lexicon": f"WITH {_LEXICON} SELECT form, lemma, pos1, pos2, n FROM lexicon",
    "lemmas": f"{_BASE}, {_LEXICON}, {_TAGGED} SELECT id, sent_pos, tok_pos, token, lemma FROM tagged",
    "pos_tags": f"{_BASE}, {_LEXICON}, {_TAGGED} SELECT id, sent_pos, tok_pos, token, pos1, pos2 FROM tagged",
    "annotate": f"{_BASE}, {_LEXICON}, {_TAGGED} {_annotation('tagged', 'sents', 'id', 'CAST(NULL AS VARCHAR)')}",
    "annotate_shape": f"{_BASE}, {_SHAPED} {_annotation('shaped', 'sents', 'id', 'CAST(NULL AS VARCHAR)')}",
    "annotate_plugin": f"WITH {_TURNS} "
    + _annotation("turn_toks", "turns", "conv_id, turn", "string_agg(dep, chr(1) ORDER BY tok_pos)"),
    "flatten_sentences": f"""WITH {_DOCS}, {_SENTS} SELECT id, sent_pos, text FROM sents
UNION ALL SELECT id, NULL, NULL FROM docs WHERE coalesce(len(texts), 0) = 0""",
    "flatten_tokens": f"""{_BASE}, {_SHAPED}
SELECT id, sent_pos, tok_pos, token, lemma, pos1, pos2, CAST(NULL AS VARCHAR) AS dep FROM shaped""",
    "nest_sentences": """SELECT conv_id, count(*) AS n, string_agg(role, chr(1) ORDER BY turn) AS roles,
  string_agg(text, chr(1) ORDER BY turn) AS texts FROM conversations GROUP BY conv_id""",
    "nest_under_parents": """SELECT c_custkey, c_name, count(o_orderkey) AS n,
  coalesce(string_agg(o_orderpriority, chr(1) ORDER BY o_orderkey), '') AS priorities
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name""",
    "nest_parts": "SELECT conv_id, turn, role, text FROM conversations",
    "enforce_schema": """SELECT doc_id, CASE WHEN lang <> 'es' THEN CAST(doc_id AS VARCHAR) END AS id,
  CASE WHEN lang <> 'es' THEN 'ok' ELSE 'null_id' END AS status FROM documents""",
    "enforce_nested": f"""WITH {_DOCS}
SELECT CAST(id AS BIGINT) AS doc_id, CAST(len(texts) AS BIGINT) AS n_lines,
  CASE WHEN tags[1] NOT IN ('es', 'de') THEN tags[2] END AS source,
  CASE WHEN tags[1] = 'fr' AND len(texts) > 0 THEN 'null_lines.text'
    WHEN tags[1] = 'de' THEN 'null_origin.source' ELSE 'ok' END AS status FROM docs""",
    "default_missing": """SELECT doc_id AS id, text, lang FROM documents
UNION ALL BY NAME SELECT item_id AS id, text FROM benchmark""",
    "safe_parse": """WITH cut AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN left(props, length(props) - 1) ELSE props END AS props
  FROM events)
SELECT event_id,
  CASE WHEN json_valid(props) THEN CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) END AS k,
  CASE WHEN props IS NULL THEN 'null_input' WHEN NOT json_valid(props) THEN 'invalid_json' END AS error FROM cut""",
    "safe_parse_fields": r"""WITH p AS (
  SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS n FROM events)
SELECT event_id, CASE WHEN event_type NOT IN ('error', 'purchase', 'click') THEN n END AS k_value,
  CASE event_type WHEN 'error' THEN 'invalid_json' WHEN 'purchase' THEN 'absent'
    WHEN 'click' THEN 'wrong_type' END AS k_reason,
  CASE WHEN event_type = 'purchase' THEN n END AS other_value,
  CASE event_type WHEN 'error' THEN 'invalid_json' WHEN 'purchase' THEN NULL ELSE 'absent' END AS other_reason FROM p""",
    "json_round_trip": _ROUND_TRIP,
    "parquet_round_trip": _ROUND_TRIP,
    "read_back": f"""{_BASE}, {_SHAPED}
SELECT id, sent_pos, string_agg(lemma, chr(1) ORDER BY tok_pos) AS lemma, true AS dep_is_null
FROM shaped GROUP BY id, sent_pos""",
    "read_back_corrupt": """SELECT doc_id, CASE WHEN lang = 'fr' THEN 'malformed'
  WHEN lang = 'de' THEN 'unknown_fields: color' WHEN lang = 'es' THEN 'null_id' ELSE 'ok' END AS status
FROM documents""",
    "read_back_unknown": f"""WITH {_DOCS}
SELECT CAST(id AS BIGINT) AS doc_id, CAST(len(texts) AS BIGINT) AS n_sentences,
  CASE WHEN tags[1] = 'de' THEN 'unknown_fields: color' || CASE WHEN len(texts) > 0 THEN ', sentences.zzz' ELSE '' END
    WHEN tags[1] = 'fr' AND len(texts) > 0 THEN 'unknown_fields: sentences.zzz' ELSE 'ok' END AS status FROM docs""",
    "ingest_parts_bad": f"""WITH {_DOCS}
SELECT id, CASE WHEN tags[2] = 'src0' THEN 'invalid_utf8' ELSE 'ok' END AS status,
  CAST(len(texts) AS BIGINT) AS n_sentences, array_to_string(texts, chr(1)) AS texts FROM docs""",
    "ingest": _ROUND_TRIP,
    "ingest_parts": f"""WITH {_DOCS}
SELECT id, array_to_string(tags, chr(1)) AS tags, CAST(len(texts) AS BIGINT) AS n_sentences,
  array_to_string(texts, chr(1)) AS texts, list_sum(list_transform(
    [id, array_to_string(tags, ' ')] || texts, lambda x: strlen(x) + 48)) <= 600 AS whole FROM docs""",
    "ingest_lexicon": f"{_BASE}, {_LEXICON}, {_TAGGED} {_records('tagged', [('lemmas', 'lemma')])}",
    "ingest_plugin": f"{_BASE}, {_PLUGGED} {_records('plugged', [('pos2', 'pos2'), ('deps', 'dep')])}",
    "ingest_ragged": f"WITH {_DOCS} SELECT id, {_RAGGED_STATUS} AS status FROM docs",
}
